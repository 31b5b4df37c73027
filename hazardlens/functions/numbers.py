"""Numeric expressions that never fail on dirty input."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.functions.text import _col, blank_to_null, strip


def _stripped_cast(c, dtype: str) -> Column:
    # a cast trims plain spaces by itself; rarer ones are worth a second try only
    return F.coalesce(_col(c).try_cast(dtype), strip(c).try_cast(dtype))


def parse_float(c) -> Column:
    """Text to double; blank and unreadable text is null, ``nan`` and ``inf`` are read.

    Spark would also read Java's ``1d`` and ``1f``; those are not numbers here.
    """
    java_suffix = _col(c).rlike(r"[0-9.][dDfF]\s*$")
    return F.when(~java_suffix, _stripped_cast(c, "double"))


def parse_int(c) -> Column:
    """Text to int: ``2025`` is read, ``2025.0`` and ``Historical`` are not."""
    return _stripped_cast(c, "int")


def float_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as double, whatever its type; a null when the table lacks it."""
    if name not in df.columns:
        return F.lit(None).cast("double")
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.DoubleType):
        return F.col(name)
    if isinstance(dtype, T.NumericType):
        return F.col(name).cast("double")
    return parse_float(name)


def int_column(df: DataFrame, name: str) -> Column:
    """Column ``name`` as int; numbers are cut towards zero, text must be whole."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.IntegerType):
        return F.col(name)
    if isinstance(dtype, T.NumericType):
        return F.col(name).try_cast("int")
    return parse_int(name)


def is_valid(c) -> Column:
    """Neither null nor NaN, as a plain true or false."""
    return _col(c).isNotNull() & ~F.isnan(_col(c))


def comparable(c) -> Column:
    """The value where a maximum may use it: NaN and minus infinity never win."""
    value = _col(c)
    return F.when(~F.isnan(value) & (value > float("-inf")), value)


def as_decimal(c, dtype: str = "decimal(18,6)") -> Column:
    """Money and coordinates from text; thousands commas go, unreadable text is null."""
    text = F.replace(strip(c), F.lit(","), F.lit(""))
    return blank_to_null(text).try_cast(dtype)


def beyond_decimal(c, dtype: str = "decimal(18,6)") -> Column:
    """True where text holds a number that ``as_decimal`` cannot hold, never null."""
    text = F.replace(strip(c), F.lit(","), F.lit(""))
    # NaN is above all numbers, and no number
    found = text.try_cast("double") < float("nan")
    return F.coalesce(found, F.lit(False)) & as_decimal(c, dtype).isNull()


def decimal_text(c) -> Column:
    """Plain digits without trailing zeros or exponent; null gives blank text."""
    text = _col(c).cast("string")
    plain = F.when(text.contains("."), F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))).otherwise(text)
    zero = _col(c) == 0
    return F.when(_col(c).isNull(), "").when(zero, "0").otherwise(plain)


def share_in_range(c) -> Column:
    """True or false for a quoted share in 0..1, null when none is quoted."""
    text = blank_to_null(strip(c))
    value = text.try_cast("double")
    return F.when(text.isNotNull(), F.coalesce(value.between(0, 1), F.lit(False)))



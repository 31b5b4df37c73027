"""Order-dependent picks as mergeable aggregates.

Rows carry their place in the source file, so "first" and "last" are a minimum
or maximum over that place and partial results merge in any order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ROW_ORDER = ("seq",)


def file_order(df) -> list[str]:
    """The columns that give a row's place, of one file or of several."""
    return [c for c in ("source_file", "seq") if c in df.columns]


def order_key(order: Sequence[str]) -> Column:
    """One comparable value for a row's place; a plain column stays a plain column."""
    cols = [F.col(c) for c in order]
    return cols[0] if len(cols) == 1 else F.struct(*cols)


def last_non_null(value: Column, order: Sequence[str] = ROW_ORDER) -> Column:
    return F.max_by(value, F.when(value.isNotNull(), order_key(order)))


def first_row(payload: Column, order: Sequence[str] = ROW_ORDER, where: Column | None = None) -> Column:
    place = order_key(order)
    return F.min_by(payload, place if where is None else F.when(where, place))


def last_row(payload: Column, order: Sequence[str] = ROW_ORDER) -> Column:
    return F.max_by(payload, order_key(order))


def first_of_largest(payload: Column, value: Column, where: Column, order: Sequence[Column]) -> Column:
    """The payload at the largest value; equal values go to the earliest row."""
    return F.min_by(payload, F.when(where, F.struct((-value).alias("rank"), *order)))

"""Labels and display values; stored values are never converted."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hazardlens.functions.numbers import is_valid
from hazardlens.functions.text import _col, blank_to_null, is_blank

# fixed values: labels of the transition drivers
DRIVER_LABELS = {
    "all": "All drivers",
    "Direct_carbon_cost": "Direct carbon cost",
    "Market_demand_shifts": "Market demand shifts",
}

# fixed values: factor and label of each display unit
DISPLAY_FACTORS = {"raw": 1.0, "percent": 100.0, "basis_points": 10000.0}
DISPLAY_LABELS = {
    "raw": "raw value",
    "percent": "percent-style display",
    "basis_points": "basis-point display",
}


def driver_label(c) -> Column:
    raw = _col(c)
    label = F.lit(None).cast("string")
    for key, text in DRIVER_LABELS.items():
        label = F.coalesce(label, F.when(raw == key, F.lit(text)))
    return F.coalesce(label, blank_to_null(raw), F.lit("n/a"))


def display_value(c, unit: str = "percent") -> Column:
    factor = DISPLAY_FACTORS.get(unit, 1.0)
    return F.when(is_valid(c), _col(c) * F.lit(factor))


def impact_label(c, unit: str = "percent", include_raw: bool = False) -> Column:
    value = _col(c)
    raw = F.format_string("%.9f", value)
    if unit == "percent":
        shown = F.format_string("%.4f%%", value * 100)
    elif unit == "basis_points":
        shown = F.format_string("%.2f bps", value * 10000)
    else:
        return F.when(is_valid(c), F.concat(raw, F.lit(" raw"))).otherwise("not quantified")
    if include_raw:
        shown = F.concat(shown, F.lit(" (raw "), raw, F.lit(")"))
    return F.when(is_valid(c), shown).otherwise("not quantified")


def number_text(c) -> Column:
    """Nine decimals for tiny values, else up to three without trailing zeros."""
    value = _col(c)
    three = F.rtrim(F.rtrim(F.format_string("%.3f", value), F.lit("0")), F.lit("."))
    tiny = (F.abs(value) > 0) & (F.abs(value) < 0.01)
    return F.when(~is_valid(c), "n/a").when(tiny, F.format_string("%.9f", value)).otherwise(three)


def value_with_unit(value, unit) -> Column:
    text = number_text(value)
    suffix = F.when(is_blank(unit), F.lit("")).otherwise(F.concat(F.lit(" "), _col(unit)))
    return F.when(is_valid(value), F.concat(text, suffix)).otherwise(text)


def magnitude_label(value, unit) -> Column:
    """An indicator's size, or a note that only its rating came back."""
    return F.when(_col(value).isNull(), "rating only").otherwise(value_with_unit(value, unit))


def peak_label(value, year) -> Column:
    text = F.concat(number_text(value), F.lit(" @ "), _col(year).cast("string"))
    return F.when(_col(value).isNull(), "n/a").otherwise(F.coalesce(text, F.lit("n/a")))

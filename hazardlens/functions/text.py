"""Text expressions: blanks, keys, generated names, addresses, coordinates."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# every character str.strip() would remove
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())
SPACE_CLASS = f"[{WHITESPACE}]"
# what a header key replaces by one underscore
_NOT_IN_KEYS = "[^a-z0-9]+"

# fixed value: listing text that carries an uploaded asset's name
LISTING_NAME = r"(?i)Asset name\s*:\s*(.*?)\s*(?=Asset type|Value|Revenues|Resilience|$)"

# fixed values: name suffixes for plant and generator grain
PLANT_PREFIX, GENERATOR_PREFIX = "is_p_", "is_g_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c) -> Column:
    """Empty text counts as missing; text of spaces does not."""
    return F.nullif(_col(c), F.lit(""))


def first_non_blank(*cols) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def is_blank(c) -> Column:
    return _col(c).isNull() | (_col(c) == "")


def strip(c) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def normalize_key(c) -> Column:
    """Header spelling to snake_case: ``" Asset Value (USD)"`` to ``asset_value_usd``."""
    words = F.regexp_replace(F.lower(strip(c)), _NOT_IN_KEYS, "_")
    return F.btrim(words, F.lit("_"))


def normalize_header(name: str) -> str:
    """The same rule for one header on the driver, where column names live."""
    return re.sub(_NOT_IN_KEYS, "_", name.lower()).strip("_")


def slug(c, fallback: str = "asset") -> Column:
    text = F.coalesce(blank_to_null(c), F.lit(fallback))
    return F.coalesce(blank_to_null(F.replace(normalize_key(text), F.lit("_"), F.lit("-"))), F.lit(fallback))


def asset_name(plant_uuid, plant_slug, plant_name=None, max_length: int = 40) -> Column:
    """``<slug>__is_p_<32 hex digits>``, or only the suffix when that is too long."""
    suffix = F.concat(F.lit(PLANT_PREFIX), F.replace(_col(plant_uuid), F.lit("-"), F.lit("")))
    label = first_non_blank(plant_slug, plant_name) if plant_name is not None else blank_to_null(plant_slug)
    name = F.concat(slug(label), F.lit("__"), suffix)
    return F.when(F.length(name) <= max_length, name).otherwise(suffix)


def uuid_from_asset_name(c, prefix: str = PLANT_PREFIX) -> Column:
    """The dashed uuid at the end of a generated name, null when there is none."""
    digits = F.regexp_extract(_col(c), prefix + "([0-9a-f]{32})$", 1)
    dashed = F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    return blank_to_null(dashed)


def clean_array(c) -> Column:
    return F.array_compact(F.coalesce(_col(c), F.array().cast("array<string>")))


def pipe_join(c) -> Column:
    return F.concat_ws("|", _col(c))


def year_value(c) -> Column:
    """All-digit years lose leading zeros, anything else stays as typed."""
    text = _col(c)
    return F.when(text.rlike(r"^\d+$"), F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(text)


def url_host(c) -> Column:
    return F.coalesce(F.lower(F.try_parse_url(_col(c), F.lit("HOST"))), F.lit(""))


def safe_file_name(c) -> Column:
    """A label as a file or partition name."""
    text = _col(c)
    single = F.regexp_replace(strip(text), SPACE_CLASS + "+", " ")
    kept = F.regexp_replace(single, r'[\\/*?:"<>|]', "")
    named = F.regexp_replace(kept, f"[-{WHITESPACE}]+", "_")
    return F.when(is_blank(text), F.lit("asset_export")).otherwise(named)


def listing_asset_name(c) -> Column:
    """The asset name inside a listing label, or the whole label when it has none."""
    text = strip(c)
    return F.when(text.rlike(LISTING_NAME), strip(F.regexp_extract(text, LISTING_NAME, 1))).otherwise(text)


def parse_point(c) -> Column:
    """``"(lat,lon)"`` as a struct of two decimals; other shapes give nulls."""
    text = strip(c)
    pattern = r"^\(\s*([+-]?[0-9.]+)\s*,\s*([+-]?[0-9.]+)\s*\)$"
    return F.struct(
        F.regexp_extract(text, pattern, 1).try_cast("decimal(18,6)").alias("lat"),
        F.regexp_extract(text, pattern, 2).try_cast("decimal(18,6)").alias("lon"),
    )


def compose_address(sidecar, raw, city, county, state, postal) -> Column:
    """The best address there is, with the source it came from."""

    def listed(*parts):
        return F.concat_ws(", ", *[F.when(~is_blank(p), strip(p)) for p in parts], F.lit("USA"))

    def present(*parts):
        found = F.lit(True)
        for part in parts:
            found = found & ~is_blank(part)
        return found

    county, state = _col(county), _col(state)
    county_name = F.when(F.lower(county).contains("county"), county).otherwise(F.concat(county, F.lit(" County")))

    def source(address, label):
        return F.struct(address.alias("address"), F.lit(label).alias("source"))

    return (
        F.when(present(sidecar), source(_col(sidecar), "sidecar"))
        .when(present(raw), source(listed(raw, city, state, postal), "plants.data.address"))
        .when(present(city, state), source(listed(city, state, postal), "city_state_fallback"))
        .when(
            present(county, state),
            source(F.concat_ws(", ", county_name, state, F.lit("USA")), "county_state_fallback"),
        )
        .when(present(state), source(F.concat(state, F.lit(", USA")), "state_fallback"))
        .otherwise(source(F.lit(""), "missing"))
    )

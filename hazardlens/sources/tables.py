"""Long results, manifest, sidecar, registry, lookups and result sets as DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.functions.numbers import parse_float
from hazardlens.functions.ordering import last_row
from hazardlens.functions.text import blank_to_null, is_blank, normalize_header, normalize_key, strip
from hazardlens.operators.assets import dedupe_manifest
from hazardlens.operators.quality import detect_kind, require_columns
from hazardlens.operators.registry import Registry
from hazardlens.plans.reports import Results
from hazardlens.schemas import KINDS, SIDECAR_ALIASES, SIDECAR_FIELDS
from hazardlens.sinks import clustered
from hazardlens.sources import quoted
from hazardlens.sources.workbooks import read_sheet

REGISTRY_TABLES = (
    "plants",
    "plant_index",
    "financial_plant",
    "workspace",
    "workspace_asset",
    "portfolio",
    "portfolio_asset",
)
_PLACE_BITS = (1 << 33) - 1


def _with_place(df: DataFrame, parquet: bool) -> DataFrame:
    """Adds ``source_file`` and ``seq``, the row's place in its file, at the scan itself.

    Text files have no row index. A row's block start plus its place in the task
    grows along the file: a full block fills its task alone, and a task never reads
    more rows than its blocks have bytes.
    """
    if parquet:
        place = F.col("_metadata.row_index")
    else:
        inside = F.monotonically_increasing_id().bitwiseAND(_PLACE_BITS)
        place = F.col("_metadata.file_block_start") + inside
    return df.select(F.col("_metadata.file_path").alias("source_file"), place.alias("seq"), "*")


def conform_long(rows: DataFrame, kind: str | None = None) -> DataFrame:
    """Result rows in the fixed schema: required names checked, absent ones null, numbers read.

    Columns the schema does not know are kept at the end.
    """
    kind = kind or detect_kind(rows.columns)
    texts, numbers, required = KINDS[kind]
    require_columns({kind: (rows.columns, required)})
    present = dict(rows.dtypes)

    def text(name):
        return (F.col(name).cast("string") if name in present else F.lit(None).cast("string")).alias(name)

    def number(name):
        if name not in present:
            return F.lit(None).cast("double").alias(name)
        value = parse_float(name) if present[name] == "string" else F.col(name).cast("double")
        return value.alias(name)

    known = {*texts, *numbers, "source_file", "seq"}
    return rows.select(
        "source_file",
        "seq",
        *[text(name) for name in texts],
        *[number(name) for name in numbers],
        *[c for c in rows.columns if c not in known],
    )


def read_long(
    spark: SparkSession, path: str, kind: str | None = None, fmt: str = "parquet", multi_line: bool = False
) -> DataFrame:
    """Long results that are already CSV or Parquet.

    Files of one call share one header: a CSV file with another one is an error and
    not a silent shift of columns. Large CSV files are split over tasks, which
    values with line breaks do not rule out, but make dearer; ``multi_line`` reads those.
    """
    if fmt == "csv" and multi_line:
        raw = quoted.read_csv(spark, path)
    elif fmt == "csv":
        raw = spark.read.csv(path, header=True, enforceSchema=False, **quoted.OPTIONS)
    else:
        raw = spark.read.parquet(path)
    placed = raw if {"source_file", "seq"} <= set(raw.columns) else _with_place(raw, fmt == "parquet")
    return conform_long(placed, kind)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per asset name with its context as a struct; the last row of a name counts."""
    return dedupe_manifest(quoted.read_csv(spark, path), ["source_file", "seq"])


def sidecar_columns(header: Sequence[str]) -> list[str]:
    """Internal names of a sidecar header, by position."""
    keys = [normalize_header(name) for name in header]
    return [SIDECAR_ALIASES.get(key, key) for key in keys]


def read_sidecar(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Sidecar rows under internal names, trimmed, blanks as empty text.

    Every file has its own header, which may order and spell its columns as it likes.
    Where two headers mean the same field the later column counts, even when blank.
    Columns that no file knows are absent, those that one file lacks are blank. Files
    are split over tasks; without line breaks inside values ``multi_line=False`` is cheaper.
    """
    # no line has more columns than commas, whatever is quoted
    commas = F.length("value") - F.length(F.replace("value", F.lit(","), F.lit("")))
    width = (spark.read.text(path).agg(F.max(commas)).first()[0] or 0) + 1
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    if multi_line:
        lines = quoted.cells(quoted.records(spark, path), schema.names)
    else:
        lines = _with_place(spark.read.csv(path, header=False, schema=schema, **quoted.OPTIONS), parquet=False)
    cells = lines.select("source_file", "seq", F.array(*[f"c{i}" for i in range(width)]).alias("cells"))
    first = cells.groupBy("source_file").agg(F.min_by("cells", "seq").alias("header"), F.min("seq").alias("head"))
    spelled = first.select(F.explode("header").alias("h")).where("h is not null").distinct()
    names = sidecar_columns([r["h"] for r in spelled.collect()])  # the few spellings of the files' headers
    others = sorted({name for name in names if name and name not in SIDECAR_FIELDS})
    named = F.create_map(*[x for key, name in SIDECAR_ALIASES.items() for x in (F.lit(key), F.lit(name))])
    keys = F.transform("header", lambda h: normalize_key(F.coalesce(h, F.lit(""))))
    keys = F.transform(keys, lambda k: F.coalesce(F.element_at(named, k), k))
    joined = cells.join(first.withColumn("keys", keys), "source_file").where(F.col("seq") > F.col("head"))
    # of two columns with one name the last
    turned = joined.withColumns({"keys": F.reverse("keys"), "cells": F.reverse("cells")})

    def value(name):
        place = F.array_position("keys", name).cast("int")
        return F.coalesce(strip(F.get("cells", place - 1)), F.lit("")).alias(name)

    return turned.select("source_file", "seq", *map(value, [*SIDECAR_FIELDS, *others]))


def read_registry(spark: SparkSession, folder: str) -> Registry:
    """The seven registry tables from Parquet."""
    return Registry(*[spark.read.parquet(f"{folder}/{name}") for name in REGISTRY_TABLES])


def uuid_ranges(column: str, parts: int = 16) -> list[str]:
    """Predicates that cut a uuid column into even ranges, one per reading task."""
    bounds = [f"{i * 256 // parts:02x}000000-0000-0000-0000-000000000000" for i in range(parts)]
    ranges = [f"{column} >= '{low}' AND {column} < '{high}'" for low, high in zip(bounds, bounds[1:])]
    whole = [*ranges, f"{column} >= '{bounds[-1]}'"]
    # rows without an id, where a table allows them, belong to the first range
    return [f"({whole[0]}) OR {column} IS NULL", *whole[1:]]


def read_registry_jdbc(
    spark: SparkSession, url: str, properties: dict[str, str], parts: int = 16
) -> Registry:
    """The registry from a database, every table that grows with the plants in ``parts`` tasks.

    Choose ``parts`` so that one task's share of the plants fits it. Filters and column
    choice reach the database; uuids and JSON travel as text.
    """
    queries = {
        "plants": "SELECT id::text AS id, eia_plant_id, slug, source_type, workspace_id::text AS workspace_id,"
        " data::text AS data FROM plants",
        "plant_index": "SELECT * FROM plant_index",
        "financial_plant": "SELECT plant_id::text AS plant_id, latest_capex_per_kw FROM financial_plant",
        "workspace": "SELECT id::text AS id, slug, deleted_at FROM workspace",
        "workspace_asset": "SELECT workspace_id::text AS workspace_id, plant_id::text AS plant_id, state"
        " FROM workspace_asset",
        "portfolio": "SELECT id::text AS id, workspace_id::text AS workspace_id, name, kind, created_at,"
        " deleted_at FROM portfolio",
        "portfolio_asset": "SELECT id::text AS id, workspace_id::text AS workspace_id,"
        " reference_plant_id::text AS reference_plant_id, portfolio_id::text AS portfolio_id, is_baseline,"
        " deleted_at FROM portfolio_asset",
    }

    def load(name):
        table = f"({queries[name]}) AS {name}"
        uuid = {"plants": "id", "portfolio_asset": "id", "financial_plant": "plant_id", "workspace_asset": "plant_id"}
        if name in uuid:
            return spark.read.jdbc(url, table, predicates=uuid_ranges(uuid[name], parts), properties=properties)
        if name == "plant_index":
            shares = [f"mod(plant_id, {parts}) = {i}" for i in range(parts)]
            return spark.read.jdbc(url, table, predicates=shares, properties=properties)
        return spark.read.jdbc(url, table, properties=properties)

    return Registry(*[load(name) for name in REGISTRY_TABLES])


def read_asset_types(spark: SparkSession, path: str, sheet: str = "Asset types") -> DataFrame:
    """Asset-type lookup from the template: data from row 5, the last row of a type counts."""
    cells = F.col("cells")

    def cell(i):
        return F.coalesce(F.get(cells, i), F.lit(""))

    rows = (
        read_sheet(spark, path, sheet)
        .where((F.col("row_no") >= 5) & ~is_blank(F.get(cells, 0)))
        .select(
            "row_no",
            F.get(cells, 0).alias("asset_type"),
            cell(3).alias("nace_code"),
            cell(4).alias("sector"),
            cell(8).alias("ticcs_class"),
            cell(9).alias("ticcs_class_name"),
        )
    )
    return _last_per_key(rows, "asset_type", "row_no")


def read_country_codes(spark: SparkSession, path: str, sheet: str = "Country code") -> DataFrame:
    """Country lookup from the template: data from row 2, both cells filled."""
    cells = F.col("cells")
    rows = (
        read_sheet(spark, path, sheet)
        .where((F.col("row_no") >= 2) & ~is_blank(F.get(cells, 0)) & ~is_blank(F.get(cells, 1)))
        .select("row_no", F.get(cells, 0).alias("country"), F.get(cells, 1).alias("iso3"))
    )
    return _last_per_key(rows, "country", "row_no")


def read_lookup_csv(spark: SparkSession, path: str, key: str) -> DataFrame:
    """Either lookup from a CSV with its columns already named."""
    rows = quoted.read_csv(spark, path).where(~is_blank(key)).drop("source_file")
    return _last_per_key(rows.fillna(""), key, "seq")


def _last_per_key(rows: DataFrame, key: str, place: str) -> DataFrame:
    payload = F.struct(*[c for c in rows.columns if c not in (key, place)])
    return rows.groupBy(key).agg(last_row(payload, [place]).alias("_last")).select(key, "_last.*")


def read_vocabulary(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One column of a vocabulary CSV as distinct terms."""
    raw = quoted.read_csv(spark, path)
    return raw.select(blank_to_null(column).alias("term")).where(F.col("term").isNotNull()).distinct()


def read_results(spark: SparkSession, folder: str) -> Results:
    """A built result set, ready for the reports."""

    def load(name):
        return spark.read.parquet(f"{folder}/{name}")

    return Results(
        load("assets"),
        load("physical_trends"),
        load("physical_hazards"),
        load("physical_indicators"),
        load("transition_scenario_rankings"),
        load("transition_trends"),
        load("transition_subrisks"),
    )


def read_results_slice(
    spark: SparkSession,
    folder: str,
    scenario: str | None = None,
    horizon: int | tuple[int | None, int | None] | None = None,
    asset_name: str | None = None,
) -> Results:
    """A clustered result set cut to a scenario, horizon or range of them, and asset.

    Each table reads only the files that the slice needs; a condition on a column that a
    table lacks is left out there.
    """
    asked = {"scenario": scenario, "horizon": horizon, "asset_name": asset_name}

    def load(name):
        path = f"{folder}/{name}"
        known = clustered.indexed_columns(spark, path)
        wanted = {c: value for c, value in asked.items() if value is not None and c in known}
        return clustered.read_slice(spark, path, wanted)

    return Results(
        load("assets"),
        load("physical_trends"),
        load("physical_hazards"),
        load("physical_indicators"),
        load("transition_scenario_rankings"),
        load("transition_trends"),
        load("transition_subrisks"),
    )


def read_page(spark: SparkSession, path: str, first: int = 1, rows: int | None = None) -> DataFrame:
    """Rows of an ordered table from position ``first`` on; what lies outside is not read.

    The order is that of ``position``. Without ``rows`` everything from there on comes.
    """
    table = spark.read.parquet(path).where(F.col("position") >= first)
    return table if rows is None else table.where(F.col("position") < first + rows)

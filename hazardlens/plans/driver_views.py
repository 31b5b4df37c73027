"""The check tables in the shapes the operators read.

``events`` stands in for physical results, ``orders`` for transition results,
memberships and sidecar rows, ``customer`` for plants and the manifest, ``nation``
and ``region`` for portfolios and workspaces, ``part`` for lookups. Every view is a
plain projection, so its size follows the table behind it.
"""

from __future__ import annotations

import io
import sys
import zipfile
from functools import reduce
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.operators.export import FUEL_ASSET_TYPES, HYDRO_TYPES, SOLAR_TYPES, WIND_TYPES
from hazardlens.operators.registry import Registry
from hazardlens.schemas import PHYSICAL_REQUIRED

# tasks get this module's code along, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HAZARDS = ["Flood", "Heat", "Wind", "Drought", "Wildfire", ""]
TRANSITION_SCENARIOS = [
    "Below 2C",
    "Current Policies",
    "Delayed Transition",
    "Low Demand",
    "NDCs",
    "Net Zero 2050",
]
TRANSITION_INDICATORS = ["Carbon price", "scope12_intensity", "Revenue growth", "Inflation", "scope3_intensity"]
FUELS = ["SUN", "WND", "WAT", "NG", "NUC", "BIT", "DFO", "MWH", "GEO", "OBG", "MSW", "XX"]
TECHNOLOGIES = ["Solar Thermal", "Offshore Wind Turbine", "Hydroelectric Pumped Storage", "Conventional", "Batteries"]
ASSET_TYPES = sorted({*FUEL_ASSET_TYPES.values(), *SOLAR_TYPES, *WIND_TYPES, *HYDRO_TYPES})
COUNTRIES = ["United States", "Canada", "Mexico", "Chile", "Peru"]


# the columns in use; a stated schema spares the job that reads every file's footer
SCHEMAS = {
    "events": "event_id bigint, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_totalprice double",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string",
    "supplier": "s_suppkey bigint, s_name string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_quantity double",
    "pages": "page_id bigint, url string",
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def pick(values: list, index: Column) -> Column:
    """The list entry at a computed index."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def div(c: str, n: int) -> Column:
    """Whole division, exact for any id."""
    return F.expr(f"{c} div {n}")


def hex_id(number: Column) -> Column:
    return F.md5(number.cast("string"))


def dashed(digits: Column) -> Column:
    return F.regexp_replace(digits, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def plant_uuid(number: Column) -> Column:
    return dashed(hex_id(number))


def returned_name(number: Column) -> Column:
    """A generated asset name; every seventh asset was never uploaded by us."""
    return F.when(number % 7 == 6, F.concat(F.lit("ext_"), number.cast("string"))).otherwise(
        F.concat(F.lit("is_p_"), hex_id(number))
    )


def unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def _letter(index: Column) -> Column:
    return F.substring(F.lit("ABCDEFG"), index.cast("int") + 1, F.lit(1))


# -- results -----------------------------------------------------------------------


def physical(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").withColumns(
        {"a": div("user_id", 10), "k": F.get_json_object("props", "$.k").cast("int"), "i": F.col("event_id")}
    )
    a, k, i, v = F.col("a"), F.col("k"), F.col("i"), F.col("value")
    hazard = k % 6
    ten = F.floor(v / 10) * 0.5
    damage = F.floor(v / 20) * 0.25
    return e.select(
        i.alias("seq"),
        F.concat(F.lit("physical_"), (i % 3).cast("string")).alias("source_file"),
        F.when(i % 97 == 0, "").otherwise(returned_name(a)).alias("assetName"),
        F.concat(F.lit("ID_"), a.cast("string"), F.when((i % 50 == 0) & (a % 3 == 0), "b").otherwise("")).alias(
            "assetId"
        ),
        F.concat(
            F.lit("("), (a % 90).cast("string"), F.lit(".5,-"), (a % 180).cast("string"), F.lit(".25)")
        ).alias("geolocationCoordinates"),
        F.when(a % 8 == 1, "CAN").otherwise("USA").alias("countryCode"),
        pick(["Temperate", "Arid", "Tropical"], a % 3).alias("climateZone"),
        F.concat(F.lit("IC"), ((a % 5) * 1000 + 1010).cast("string"), F.lit("20")).alias("ticcsSubClass"),
        F.concat(F.lit("Class "), (a % 5).cast("string")).alias("ticcsSubClassName"),
        F.when(F.col("event_type").isin("view", "click", "signup"), "ssp2-4.5").otherwise("ssp5-8.5").alias(
            "scenario"
        ),
        F.when(i % 17 == 0, "Historical")
        .when(i % 101 == 1, "2025.0")
        .otherwise((2025 + 25 * (i % 4)).cast("string"))
        .alias("timeHorizon"),
        F.concat(F.lit("ind_"), (i % 3).cast("string")).alias("indicator"),
        unless(i % 7 == 0, F.floor(v / 10).cast("double")).alias("indicatorValue"),
        pick(["m", "days", ""], i % 3).alias("indicatorUnit"),
        F.when(i % 23 == 5, " a")
        .when((k + i) % 9 == 7, "NA")
        .when((k + i) % 9 == 8, "")
        .otherwise(_letter((k + i) % 9))
        .alias("indicatorRating"),
        pick(HAZARDS, hazard).alias("hazard"),
        _letter(i % 5).alias("HazardRating"),
        unless(k % 4 == 3, _letter(k % 4)).alias("hazardExposureRating"),
        F.when(i % 6 == 0, "NA").when(i % 6 == 1, "").otherwise("C").alias("adjustedHazardExposureRating"),
        unless(i % 11 == 0, F.when(hazard == 0, F.lit(0.25)).otherwise(ten)).alias("adjustedHazardValueImpact"),
        F.when((hazard != 1) & (hazard != 3), damage).alias("adjustedHazardDamage"),
        F.when(i % 31 == 0, F.lit(float("nan")))
        .when(i % 37 == 0, F.lit(float("-inf")))
        .when(hazard != 3, F.floor(v / 5) * 0.125)
        .alias("adjustedHazardDisruption"),
        (ten - damage + F.when(i % 29 == 0, 1.0).otherwise(0.0)).alias("adjustedHazardDisruptionDamageEquivalent"),
        unless(i % 5 == 0, ten).alias("adjustedTotalDamage"),
        unless(i % 9 == 0, F.floor(v / 15) * 0.25).alias("adjustedTotalDisruption"),
        F.floor(v / 30).cast("double").alias("adjustedTotalDisruptionDamageEquivalent"),
        unless(i % 13 == 0, ten + (i % 3) * 0.5).alias("adjustedTotalValueImpact"),
        _letter(i % 7).alias("physicalExposureRating"),
        pick(["B", "NA", "", None], i % 4).alias("adjustedPhysicalExposureRating"),
    )


def transition(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumns({"a": div("o_custkey", 100), "i": F.col("o_orderkey")})
    a, i, p = F.col("a"), F.col("i"), F.col("o_totalprice")
    return o.select(
        i.alias("seq"),
        F.concat(F.lit("transition_"), (i % 3).cast("string")).alias("source_file"),
        returned_name(a).alias("assetName"),
        F.concat(F.lit("ID_"), a.cast("string")).alias("assetId"),
        F.concat(
            F.lit("("), (a % 90).cast("string"), F.lit(".5,-"), (a % 180).cast("string"), F.lit(".25)")
        ).alias("geolocationCoordinates"),
        F.lit("USA").alias("countryCode"),
        pick(["Temperate", "Arid", "Tropical"], a % 3).alias("climateZone"),
        F.concat(F.lit("IC"), ((a % 5) * 1000 + 1010).cast("string"), F.lit("20")).alias("ticcsSubClass"),
        F.concat(F.lit("Class "), (a % 5).cast("string")).alias("ticcsSubClassName"),
        pick(TRANSITION_SCENARIOS, div("i", 40) % 6).alias("scenario"),
        F.when(i % 19 == 0, "Historical").otherwise((2025 + 5 * (i % 8)).cast("string")).alias("timeHorizon"),
        pick(TRANSITION_INDICATORS, i % 5).alias("indicator"),
        F.floor(p / 1000).cast("double").alias("indicatorValue"),
        F.when(i % 5 < 2, "USD").otherwise("").alias("indicatorUnit"),
        F.when(i % 25 == 4, "")
        .when(i % 5 < 2, "Direct_carbon_cost")
        .otherwise("Market_demand_shifts")
        .alias("subrisk"),
        unless(i % 11 == 0, F.floor(p / 20000) * 0.5).alias("adjustedSubriskRevenueImpact"),
        _letter(i % 7).alias("subriskExposureRating"),
        F.when(i % 3 == 0, "").when(i % 3 == 1, "C").alias("adjustedSubriskExposureRating"),
        _letter(div("i", 3) % 7).alias("transitionExposureRating"),
        F.when(i % 4 == 0, "").when(i % 4 == 1, "NA").otherwise("B").alias("adjustedTransitionExposureRating"),
    )


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Physical rows of several imports of the same assets."""
    rows = physical(spark, sf)
    number = div("seq", 50) % 4
    return rows.withColumns(
        {
            "import_id": F.concat(F.lit("import_"), number.cast("string")),
            "imported_at": F.concat(F.lit("2026-07-0"), (number % 3 + 1).cast("string")),
        }
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest rows; every tenth asset occurs twice and the second row counts."""
    c = table(spark, sf, "customer").withColumn("n", F.col("c_custkey"))
    n = F.col("n")

    def rows(source, offset, portfolio):
        return source.select(
            (n + offset).alias("seq"),
            F.concat(F.lit("is_p_"), hex_id(n)).alias("scr_asset_name"),
            F.concat(F.lit("run_"), (n % 3).cast("string")).alias("scr_run_id"),
            F.lit("plant").alias("scr_grain"),
            F.when(n % 17 == 5, plant_uuid(n + 1)).otherwise(plant_uuid(n)).alias("plant_uuid"),
            F.concat(F.lit("plant-"), n.cast("string")).alias("plant_slug"),
            portfolio.alias("portfolio_id"),
            F.concat(F.lit("pa_"), n.cast("string")).alias("portfolio_asset_id"),
            F.col("c_name").alias("plant_name"),
            F.when(n % 4 == 0, "").otherwise(F.col("c_mktsegment")).alias("asset_type"),
            F.when(n % 13 == 0, "")
            .when(n % 11 == 3, F.concat((n % 90).cast("string"), F.lit(".75")))
            .otherwise(F.concat((n % 90).cast("string"), F.lit(".5")))
            .alias("latitude"),
            F.when(n % 13 == 0, "")
            .otherwise(F.concat(F.lit("-"), (n % 180).cast("string"), F.lit(".25")))
            .alias("longitude"),
        )

    first = rows(c, 0, F.concat(F.lit("pf_"), (n % 25).cast("string")))
    second = rows(c.where(n % 10 == 0), 1_000_000_000, F.lit("pf_again"))
    return first.unionByName(second)


def workbook_files(spark: SparkSession, sf: str) -> DataFrame:
    """Physical rows packed into workbooks of a bounded number of rows, as ``path, content``."""
    return pack_workbooks(physical(spark, sf))


def pack_workbooks(rows: DataFrame, rows_per_file: int = 1000, blank_every: int = 0) -> DataFrame:
    """Rows packed into workbooks by ``seq``; with ``blank_every`` a blank row follows every so many.

    Packing and reading a workbook costs far more than its bytes tell, so the blocks are
    dealt over all shuffle partitions; the engine would merge them by size.
    """
    names = PHYSICAL_REQUIRED
    rows = rows.select("seq", div("seq", rows_per_file).alias("block"), *names)
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def pack(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        lines = _sheet_lines(table.sort_by("seq").select(["seq", *names]), blank_every)
        header = _line_of(1, ["seq", *names])
        return pa.table({"path": [f"block_{block:06d}"], "content": [_book(header + "".join(lines), "Output")]})

    return rows.repartition(parts, "block").groupBy("block").applyInArrow(pack, "path string, content binary")


def _sheet_lines(table: pa.Table, blank_every: int) -> list[str]:
    """The rows of a table as lines 2, 3, ... of a sheet, column by column."""
    gaps = [2 * (n // blank_every) if blank_every else 0 for n in range(table.num_rows)]
    places = [n + 2 + gap for n, gap in enumerate(gaps)]
    line = pa.array(map(str, places), pa.string())
    parts = []
    for column, values in enumerate(table.columns):
        values, name = values.combine_chunks(), f'<c r="{chr(65 + column)}'
        if pa.types.is_string(values.type):
            for plain, escaped in (("&", "&amp;"), (">", "&gt;"), ("<", "&lt;")):
                values = pc.replace_substring(values, plain, escaped)
            cells = pc.binary_join_element_wise(name, line, '" t="inlineStr"><is><t>', values, "</t></is></c>", "")
        else:
            texts = pa.array([value if value is None else str(value) for value in values.to_pylist()], pa.string())
            cells = pc.binary_join_element_wise(name, line, '"><v>', texts, "</v></c>", "")
        parts.append(pc.fill_null(cells, ""))
    lines = pc.binary_join_element_wise('<row r="', line, '">', *parts, "</row>", "").to_pylist()
    if blank_every:
        for n in range(blank_every - 1, len(lines), blank_every):
            lines[n] += _line_of(places[n] + 1, []) + _line_of(places[n] + 2, ["", ""])
    return lines


def _line_of(n: int, values: list) -> str:
    """One line of a sheet."""

    def cell(column: int, value) -> str:
        place = f'r="{chr(65 + column)}{n}"'
        if isinstance(value, str):
            return f'<c {place} t="inlineStr"><is><t>{escape(value)}</t></is></c>'
        return f"<c {place}><v>{value}</v></c>"

    return f'<row r="{n}">' + "".join(cell(c, v) for c, v in enumerate(values) if v is not None) + "</row>"


def broken_workbooks(spark: SparkSession, sf: str) -> DataFrame:
    """One workbook per supplier: good, without two columns, of the other kind, without the sheet, no workbook."""
    full = [*PHYSICAL_REQUIRED]
    lacking = [c for c in full if c not in ("climateZone", "countryCode")]
    returned = ["assetName", "scenario", "timeHorizon", "subrisk"]
    kinds = [_workbook([full]), _workbook([lacking]), _workbook([returned]), _workbook([full], "Input"), b"no workbook"]

    def pack(batches):
        for batch in batches:
            keys = batch.column("s_suppkey").to_pylist()
            yield pa.RecordBatch.from_pydict(
                {"path": [f"supplier_{k}" for k in keys], "content": [kinds[k % len(kinds)] for k in keys]}
            )

    return table(spark, sf, "supplier").select("s_suppkey").mapInArrow(pack, "path string, content binary")


def _workbook(lines: list[list], sheet: str = "Output") -> bytes:
    """The smallest workbook that holds the lines on one sheet."""
    return _book("".join(_line_of(n, line) for n, line in enumerate(lines, 1)), sheet)


def _book(rows: str, sheet: str) -> bytes:
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    links = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as book:
        sheets = '<sheets><sheet name="' + sheet + '" sheetId="1" r:id="s"/></sheets>'
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{links}">{sheets}</workbook>')
        book.writestr("xl/_rels/workbook.xml.rels", '<R><Relationship Id="s" Target="worksheets/o.xml"/></R>')
        book.writestr("xl/worksheets/o.xml", f'<worksheet xmlns="{main}"><sheetData>{rows}</sheetData></worksheet>')
    return out.getvalue()


# -- registry ------------------------------------------------------------------------


def registry(spark: SparkSession, sf: str) -> Registry:
    customer = table(spark, sf, "customer").withColumn("n", F.col("c_custkey"))
    orders = table(spark, sf, "orders").withColumn("i", F.col("o_orderkey"))
    n, i = F.col("n"), F.col("i")
    label = n.cast("string")
    data = F.to_json(
        F.struct(
            F.when(n % 3 == 0, F.concat(F.lit("Plant "), label)).when(n % 3 == 1, "").alias("plant_name"),
            F.when(n % 4 == 0, F.concat(F.lit("Site "), label)).alias("name"),
            F.when(n % 5 == 0, F.concat(F.lit("Utility "), (n % 50).cast("string"))).alias("utility_eia_name"),
            F.when(n % 6 != 0, F.concat(F.lit("S"), F.col("c_nationkey").cast("string"))).alias("state"),
            F.when(n % 7 == 0, F.concat(F.lit("Lake County "), label)).alias("county"),
            F.when(n % 8 == 0, F.concat(F.lit(" City "), label)).alias("city"),
            F.when(n % 8 == 1, F.concat(F.lit("Town "), label)).alias("municipality"),
            F.when(n % 2 == 0, F.concat(F.lit("9"), label)).alias("zip_code"),
            F.when(n % 16 == 0, F.concat(label, F.lit(" Main St"))).alias("address"),
            F.when(n % 16 == 1, F.concat(label, F.lit(" Side St"))).alias("location"),
            F.when(n % 13 == 0, "")
            .when(n % 13 == 1, "n/a")
            .otherwise(F.concat((n % 90).cast("string"), F.lit(".50")))
            .alias("lat"),
            F.when(n % 3 == 0, F.concat(F.lit("-"), (n % 180).cast("string"), F.lit(".25"))).alias("longitude"),
            F.when(n % 9 == 0, "NG").alias("primary_fuel"),
            F.when(n % 10 == 0, F.concat((n % 500).cast("string"), F.lit(".5"))).alias("total_capacity_mw"),
        )
    )
    plants = customer.select(
        plant_uuid(n).alias("id"),
        unless(n % 10 == 9, n.cast("int")).alias("eia_plant_id"),
        F.concat(F.lit("plant-"), label).alias("slug"),
        F.when(n % 20 == 0, "user_added").otherwise("eia").alias("source_type"),
        F.when(n % 6 == 0, F.concat(F.lit("ws_"), (n % 5).cast("string"))).alias("workspace_id"),
        data.alias("data"),
    )
    # every customer has its row; a fifth of them are found under no plant's id
    plant_index = customer.select(
        F.when(n % 5 == 0, -1 - n).otherwise(n).cast("int").alias("plant_id"),
        F.concat(F.lit("Index "), label).alias("plant_name"),
        F.when(n % 3 == 0, F.lit(None)).otherwise(F.lit("Index Utility")).alias("utility_eia_name"),
        F.lit("Owner").alias("canonical_owner"),
        F.lit("Parent").alias("gem_parent_name"),
        F.lit("TX").alias("state"),
        F.when(n % 2 == 0, F.lit("Travis")).alias("county"),
        ((n % 90).cast("decimal(10,4)")).alias("lat"),
        ((-(n % 180)).cast("decimal(10,4)")).alias("lon"),
        pick(FUELS, n % 12).alias("primary_fuel"),
        F.array(pick(FUELS, n % 12), pick(FUELS, (n + 5) % 12)).alias("fuel_types"),
        F.array(pick(TECHNOLOGIES, n % 5)).alias("technologies"),
        ((n % 700).cast("decimal(12,3)")).alias("total_capacity_mw"),
    )
    financial = customer.select(
        F.when(n % 4 == 0, F.concat(F.lit("old-"), label)).otherwise(plant_uuid(n)).alias("plant_id"),
        F.col("c_acctbal").cast("decimal(12,2)").alias("latest_capex_per_kw"),
    )
    workspace = table(spark, sf, "region").select(
        F.concat(F.lit("ws_"), F.col("r_regionkey").cast("string")).alias("id"),
        F.lower("r_name").alias("slug"),
        F.when(F.col("r_regionkey") == 4, F.lit("2026-01-01")).alias("deleted_at"),
    )
    workspace_asset = customer.select(
        F.concat(F.lit("ws_"), (n % 5).cast("string")).alias("workspace_id"),
        plant_uuid(n).alias("plant_id"),
        F.when(n % 3 == 0, "prospect").otherwise("portfolio").alias("state"),
    )
    nation_key = F.col("n_nationkey")
    portfolio = table(spark, sf, "nation").select(
        F.concat(F.lit("pf_"), nation_key.cast("string")).alias("id"),
        F.concat(F.lit("ws_"), (nation_key % 5).cast("string")).alias("workspace_id"),
        F.col("n_name").alias("name"),
        F.when(nation_key % 2 == 0, "model").otherwise("client").alias("kind"),
        F.concat(F.lit("2026-01-"), F.format_string("%02d", nation_key + 1)).alias("created_at"),
        F.when(nation_key % 11 == 10, F.lit("2026-02-01")).alias("deleted_at"),
    )
    portfolio_asset = orders.select(
        F.concat(F.lit("pa_"), i.cast("string")).alias("id"),
        F.concat(F.lit("ws_"), (i % 5).cast("string")).alias("workspace_id"),
        F.concat(F.lit("pf_"), (i % 25).cast("string")).alias("portfolio_id"),
        plant_uuid(F.col("o_custkey")).alias("reference_plant_id"),
        (i % 2 == 0).alias("is_baseline"),
        F.when(i % 9 == 0, F.lit("2026-03-01")).alias("deleted_at"),
    )
    return Registry(plants, plant_index, financial, workspace, workspace_asset, portfolio, portfolio_asset)


def sidecar(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("i", F.col("o_orderkey"))
    i, n = F.col("i"), F.col("o_custkey")
    kind = div("i", 5) % 4
    return o.select(
        i.alias("seq"),
        F.when(kind == 0, plant_uuid(n)).otherwise("").alias("plant_uuid"),
        F.when(kind == 1, F.concat(F.lit("is_p_"), hex_id(n))).otherwise("").alias("scr_asset_name"),
        F.when(kind == 2, F.concat(F.lit("pa_"), i.cast("string"))).otherwise("").alias("portfolio_asset_id"),
        F.when(kind == 3, n.cast("string")).otherwise("").alias("eia_plant_id"),
        F.when(i % 3 == 0, "").otherwise(F.concat(F.floor(F.col("o_totalprice")).cast("string"), F.lit(".50"))).alias(
            "asset_value"
        ),
        F.when(i % 2 == 0, F.concat((i % 9).cast("string"), F.lit(",500"))).otherwise("").alias("revenues"),
        F.when(i % 15 == 0, "2024").otherwise("").alias("year"),
        F.when(i % 20 == 0, "0.25").otherwise("").alias("detention_rate"),
        F.when(i % 4 == 0, F.concat(F.lit("Operator "), (i % 30).cast("string"))).otherwise("").alias(
            "operating_entity_name"
        ),
        F.when(i % 35 == 0, F.concat(F.lit("Street "), i.cast("string"))).otherwise("").alias("address"),
        F.when(i % 55 == 0, "Unheard-of plant").otherwise("").alias("asset_type"),
        F.when(i % 45 == 0, "Canada").when(i % 65 == 0, "Atlantis").otherwise("").alias("country"),
        F.when(i % 25 == 0, "12.5").otherwise("").alias("scope_1"),
        F.when(i % 10 == 0, "0.5").otherwise("1.5").alias("flood_barriers"),
    )


# -- lookups -------------------------------------------------------------------------


def asset_types(spark: SparkSession, sf: str) -> DataFrame:
    """Asset-type lookup, one row per type; the geothermal type is left out on purpose."""
    p = table(spark, sf, "part").withColumn("j", F.col("p_partkey") % len(ASSET_TYPES))
    named = p.select(pick(ASSET_TYPES, F.col("j")).alias("asset_type"), "j", "p_partkey")
    return (
        named.where(F.col("asset_type") != "Geothermal power plant")
        .groupBy("asset_type", "j")
        .agg(F.max("p_partkey").alias("_last"))
        .select(
            "asset_type",
            F.concat(F.lit("D35."), (F.col("j") + 10).cast("string")).alias("nace_code"),
            F.concat(F.lit("Sector "), (F.col("j") % 3).cast("string")).alias("sector"),
            F.concat(F.lit("IC"), (F.col("j") * 10 + 1000).cast("string")).alias("ticcs_class"),
            F.concat(F.lit("Class "), F.col("j").cast("string")).alias("ticcs_class_name"),
        )
    )


def country_codes(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part").select(pick(COUNTRIES, F.col("p_partkey") % 5).alias("country")).distinct()
    iso = reduce(
        lambda chain, pair: chain.when(F.col("country") == pair[0], pair[1]),
        zip(COUNTRIES[1:], ["CAN", "MEX", "CHL", "PER"], strict=True),
        F.when(F.col("country") == COUNTRIES[0], "USA"),
    )
    return p.withColumn("iso3", iso)


def vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """Known terms, spelled in upper case; Wildfire is not among them, Hail never comes back."""
    p = table(spark, sf, "part").select(
        F.upper(pick(["Flood", "Heat", "Wind", "Drought", "Hail"], F.col("p_partkey") % 5)).alias("term")
    )
    return p.distinct()

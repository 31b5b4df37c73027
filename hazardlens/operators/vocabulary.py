"""Vocabulary: display labels, scenario categories, coverage of returned terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardlens.functions.text import is_blank, strip
from hazardlens.operators.joins import lookup_join

# fixed values: transition scenario, category, physical scenario
SCENARIOS = [
    ("Net Zero 2050", "Orderly", "SSP2-4.5"),
    ("Below 2C", "Orderly", "SSP2-4.5"),
    ("Delayed Transition", "Disorderly", "SSP2-4.5"),
    ("Fragmented World", "Too Little, Too Late", "SSP2-4.5"),
    ("Nationally Determined Contributions (NDCs)", "Hot House World", "SSP2-4.5"),
    ("Current Policies", "Hot House World", "SSP2-4.5"),
    ("Climate Destabilisation", "ECI", "SSP5-8.5"),
    ("Climate Breakdown", "ECI", "SSP5-8.5"),
]
# fixed values: returned spelling, vocabulary spelling
SCENARIO_ALIASES = [
    ("ndcs", "nationally determined contributions (ndcs)"),
    ("below 2°c", "below 2c"),
]
# fixed values: returned driver, display label
DRIVERS = [
    ("Direct_carbon_cost", "Direct carbon cost"),
    ("Market_demand_shifts", "Market demand shifts"),
]


def scenario_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SCENARIOS, "scenario string, category string, physical_scenario string")


def _lookup(key: Column, pairs: list[tuple[str, str]]) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for pair in pairs for x in pair]), key)


def canonical(c) -> Column:
    """A scenario name for matching: outer space, case and known spellings do not matter."""
    key = F.lower(strip(c))
    return F.coalesce(_lookup(key, SCENARIO_ALIASES), key)


def with_scenario_category(df: DataFrame, col: str = "scenario") -> DataFrame:
    """Adds category and physical scenario; eight fixed entries, so no join is needed."""
    key = canonical(col)
    rows = [(name.lower(), category, physical) for name, category, physical in SCENARIOS]
    return df.withColumns(
        {
            "scenario_category": _lookup(key, [(n, c) for n, c, _ in rows]),
            "physical_scenario": _lookup(key, [(n, p) for n, _, p in rows]),
        }
    )


def display_label(df: DataFrame, col: str, labels: DataFrame, out: str = "label") -> DataFrame:
    """A label from a table ``raw, label`` unique on ``raw``; raw text where it has none."""
    named = labels.select(F.col("raw").alias(col), F.col("label").alias("_label"))
    return (
        lookup_join(df, named, [col])
        .withColumn(out, F.coalesce("_label", F.nullif(F.col(col), F.lit("")), F.lit("n/a")))
        .drop("_label")
    )


def vocabulary_status(results: DataFrame, col: str, vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """Returned terms with ``mapped`` or ``missing``; rows of a missing term stay."""
    known = vocabulary.select(canonical(term).alias("_key")).distinct().withColumn("_known", F.lit(True))
    return (
        results.where(~is_blank(col))
        .groupBy(F.col(col).alias("term"))
        .agg(F.count("*").alias("row_count"))
        .withColumn("_key", canonical("term"))
        .join(known, "_key", "left")
        .select(
            "term",
            "row_count",
            F.when(F.col("_known"), "mapped").otherwise("missing").alias("metadata_mapping_status"),
        )
    )


def unused_terms(results: DataFrame, col: str, vocabulary: DataFrame, term: str = "term") -> DataFrame:
    """Vocabulary terms that did not come back; not an error, a return may be a subset."""
    returned = results.where(~is_blank(col)).select(canonical(col).alias("_key")).distinct()
    return vocabulary.withColumn("_key", canonical(term)).join(returned, "_key", "left_anti").drop("_key")


def _deletions(text: Column) -> Column:
    """The text with any one of its characters left out."""
    places = F.sequence(F.lit(1), F.length(text))
    cut = F.transform(places, lambda i: F.concat(F.substring(text, F.lit(1), i - 1), F.substring(text, i + 1, F.length(text))))
    return F.when(F.length(text) > 0, cut).otherwise(F.array().cast("array<string>"))


def _neighbourhood(text: Column) -> Column:
    """The text, and it without any one or two characters; any two texts within two edits share an entry."""
    one = F.array_distinct(_deletions(text))
    return F.array_distinct(F.concat(F.array(text), one, F.flatten(F.transform(one, _deletions))))


def with_suggestions(terms: DataFrame, vocabulary: DataFrame, col: str = "term", term: str = "term") -> DataFrame:
    """Adds ``suggestion``, the nearest known term within two edits, and ``distance``; null where there is none.

    Terms are compared as ``canonical`` reads them; of equally near ones the first by
    name counts. Either side is indexed by the hashes of what is left when up to two
    characters go, so only terms that share such a rest are compared. The index of a
    term grows with the square of its length; terms are names of some words.
    """

    def indexed(rows, key):
        return rows.withColumn("_rest", F.explode(F.transform(_neighbourhood(F.col(key)), lambda t: F.xxhash64(t))))

    known = vocabulary.select(canonical(term).alias("_known"), F.col(term).alias("_term")).where("_known <> ''").distinct()
    asked = terms.select(canonical(col).alias("_asked")).where("_asked <> ''").distinct()
    pairs = indexed(asked, "_asked").join(indexed(known, "_known"), "_rest").select("_asked", "_known", "_term").distinct()
    near = pairs.withColumn("_distance", F.levenshtein("_asked", "_known")).where("_distance <= 2")
    best = near.groupBy("_asked").agg(F.min(F.struct("_distance", "_term")).alias("_best"))
    joined = terms.withColumn("_asked", canonical(col)).join(best, "_asked", "left")
    return joined.select(*terms.columns, F.col("_best._term").alias("suggestion"), F.col("_best._distance").alias("distance"))

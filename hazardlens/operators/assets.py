"""Asset identity and join-back of results to the private manifest.

Results join to the manifest by the generated asset name and by nothing else:
not by display name, address, coordinates, class or the vendor's own id.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.ordering import ROW_ORDER, first_row, last_row
from hazardlens.functions.text import (
    GENERATOR_PREFIX,
    PLANT_PREFIX,
    blank_to_null,
    is_blank,
    uuid_from_asset_name,
)
from hazardlens.operators.axes import asset_context
from hazardlens.operators.joins import lookup_join
from hazardlens.schemas import MANIFEST_CONTEXT


def _union_context(physical: DataFrame, transition: DataFrame, order: Sequence[str]) -> DataFrame:
    def part(rows, source):
        return rows.where(~is_blank("assetName")).select(
            F.lit(source).alias("_source"), *order, *asset_context(rows)
        )

    return part(physical, 0).unionByName(part(transition, 1))


def assets(physical: DataFrame, transition: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """One row per asset: its first row over the physical and then the transition rows."""
    rows = _union_context(physical, transition, order)
    payload = F.struct(*[c for c in rows.columns if c not in ("_source", "asset_name", *order)])
    return (
        rows.groupBy("asset_name")
        .agg(first_row(payload, ["_source", *order]).alias("_first"))
        .select("asset_name", "_first.*")
    )


def dedupe_manifest(manifest: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The last row of every asset name; rows without a name go."""
    kept = [c for c in MANIFEST_CONTEXT if c in manifest.columns]
    payload = F.struct(*[blank_to_null(c).alias(c) for c in kept])
    return (
        manifest.where(~is_blank("scr_asset_name"))
        .groupBy("scr_asset_name")
        .agg(last_row(payload, order).alias("manifest"))
    )


def join_back(results: DataFrame, manifest: DataFrame, name: str = "asset_name") -> DataFrame:
    """Any result table with its manifest row as a struct, null where none matches.

    ``manifest`` is the output of :func:`dedupe_manifest`.
    """
    right = manifest.withColumnRenamed("scr_asset_name", name)
    return lookup_join(results, right, [name], "left")


def unmatched_assets(results: DataFrame, manifest: DataFrame, name: str = "assetName") -> DataFrame:
    """Names that came back but are not in the manifest: a hard failure of an import."""
    names = results.where(~is_blank(name)).groupBy(name).agg(F.count("*").alias("row_count"))
    return names.join(manifest.select(F.col("scr_asset_name").alias(name)), name, "left_anti")


def uuid_mismatches(results: DataFrame, manifest: DataFrame, name: str = "assetName") -> DataFrame:
    """Names whose uuid suffix differs from the manifest's plant: a hard failure as well."""
    names = results.where(~is_blank(name)).select(name).distinct()
    plants = manifest.select(F.col("scr_asset_name").alias(name), F.col("manifest.plant_uuid").alias("plant_uuid"))
    return (
        names.join(plants, name)
        .withColumn("name_uuid", uuid_from_asset_name(name))
        .where(~F.col("name_uuid").eqNullSafe(F.col("plant_uuid")))
    )


def recover_plants(results: DataFrame, plants: DataFrame, name: str = "assetName") -> DataFrame:
    """Assets tied to the registry by the uuid in their name, for when the manifest is lost.

    Run, portfolio and valuation context cannot be recovered this way.
    """
    names = results.where(~is_blank(name)).select(name).distinct()
    parsed = names.withColumns(
        {
            "plant_uuid": uuid_from_asset_name(name, PLANT_PREFIX),
            "generator_uuid": uuid_from_asset_name(name, GENERATOR_PREFIX),
        }
    )
    known = plants.select(F.col("id").alias("plant_uuid"), F.col("slug").alias("plant_slug"))
    # names without a uuid are dealt by name
    return lookup_join(parsed, known, ["plant_uuid"], spread=name).select(
        name, "plant_uuid", "generator_uuid", "plant_slug", F.col("plant_slug").isNotNull().alias("recovered")
    )

"""Sidecar overrides: one asset may be named by any of four keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazardlens.functions.ordering import ROW_ORDER, last_row
from hazardlens.functions.text import is_blank
from hazardlens.operators.joins import lookup_join
from hazardlens.schemas import SIDECAR_KEYS

# the keys that all assets of a plant share; the membership comes before the last one
PLANT_KEYS = ("plant_uuid", "scr_asset_name", "eia_plant_id")
AFTER_MEMBERSHIP = 3


def index_sidecar(sidecar: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Every non-blank key with the last row that carries it.

    The four kinds of key share one namespace, so a later row replaces an earlier
    one even when it uses the value as another kind of key.
    """
    keyed = sidecar.withColumn("_key", F.explode(F.array_distinct(F.array(*SIDECAR_KEYS))))
    fields = [c for c in sidecar.columns if c not in order]
    return (
        keyed.where(~is_blank("_key"))
        .groupBy("_key")
        .agg(last_row(F.struct(*fields), order).alias("side"))
    )


def resolve_sidecar(assets: DataFrame, sidecar_index: DataFrame, plants: DataFrame | None = None) -> DataFrame:
    """Assets with the sidecar row of the first of their keys that has one.

    An asset tries its plant uuid, its generated name, its portfolio membership and
    its index id, in that order. ``side`` is null where nothing matches. All keys but
    the membership are the plant's, so they are tried once per plant: stacked, with their
    priority, in one join. ``plants`` is a table that holds the plants of all assets under
    the same columns; without it they are taken from the assets, which are then read twice.
    """
    plants = (assets if plants is None else plants).select(*PLANT_KEYS).distinct()
    tried = F.array(
        *(
            F.struct(F.col(c).cast("string").alias("_key"), F.lit(p).alias("_priority"))
            for c, p in zip(PLANT_KEYS, (0, 1, AFTER_MEMBERSHIP), strict=True)
        )
    )
    stacked = plants.select(*PLANT_KEYS, F.explode(F.filter(tried, lambda t: t["_key"].isNotNull())).alias("_try"))
    found = stacked.select(*PLANT_KEYS, "_try.*").join(sidecar_index, "_key")
    best = found.groupBy(*(F.col(c).alias(f"_{c}") for c in PLANT_KEYS)).agg(
        F.min_by("side", "_priority").alias("_plant_side"), F.min("_priority").alias("_priority")
    )
    own = sidecar_index.select(F.col("_key").alias("portfolio_asset_id"), F.col("side").alias("_own_side"))
    # a key that is missing matches a missing one
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLANT_KEYS))
    named = lookup_join(assets, own, ["portfolio_asset_id"], spread="plant_uuid").join(best, same, "left")
    side = F.when(F.col("_priority") < AFTER_MEMBERSHIP, F.col("_plant_side")).otherwise(
        F.coalesce("_own_side", "_plant_side")
    )
    return named.select(*assets.columns, side.alias("side"))

"""Asset registry: live rows, scopes and the projected plant record."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardlens.functions.numbers import as_decimal
from hazardlens.functions.text import clean_array, first_non_blank
from hazardlens.operators.joins import left_join_many, lookup_join

# lookup order inside a plant's JSON record, as "column = keys"
JSON_CHAINS = {
    "plant_name": ["plant_name", "name"],
    "operating_entity_name": ["utility_eia_name"],
    "state": ["state"],
    "county": ["county"],
    "city": ["city", "municipality"],
    "postal_code": ["zip_code", "postal_code"],
    "address_raw": ["address", "street_address", "location"],
    "latitude": ["lat", "latitude"],
    "longitude": ["lon", "longitude"],
    "primary_fuel": ["primary_fuel"],
    "total_capacity_mw": ["total_capacity_mw"],
}
# columns of the plant index that stand in after the JSON record, in order
INDEX_CHAINS = {
    "plant_name": ["plant_name"],
    "operating_entity_name": ["utility_eia_name", "canonical_owner", "gem_parent_name"],
    "state": ["state"],
    "county": ["county"],
    "city": [],
    "postal_code": [],
    "address_raw": [],
    "latitude": ["lat"],
    "longitude": ["lon"],
    "primary_fuel": ["primary_fuel"],
    "total_capacity_mw": ["total_capacity_mw"],
}
SCOPE_COLUMNS = [
    "workspace_id",
    "workspace_slug",
    "portfolio_id",
    "portfolio_name",
    "portfolio_kind",
    "portfolio_asset_id",
    "workspace_asset_state",
]
# coordinates keep every digit they came with; nothing is computed from them
COORDINATE = "decimal(38,18)"
# chosen so that capacity in kW times capital cost fits a decimal of 38 digits exactly
CAPACITY = "decimal(19,9)"
CAPEX = "decimal(18,9)"
_JSON_SCHEMA = T.StructType(
    [T.StructField(key, T.StringType()) for key in dict.fromkeys(k for c in JSON_CHAINS.values() for k in c)]
)


@dataclass(frozen=True)
class Registry:
    plants: DataFrame
    plant_index: DataFrame
    financial_plant: DataFrame
    workspace: DataFrame
    workspace_asset: DataFrame
    portfolio: DataFrame
    portfolio_asset: DataFrame


def live(df: DataFrame) -> DataFrame:
    """Rows that are not soft-deleted. Filter a right side with this before a left join."""
    return df.where(F.col("deleted_at").isNull())


# -- plant record ------------------------------------------------------------------


def plant_records(reg: Registry, plants: DataFrame | None = None) -> DataFrame:
    """Plants with index and finance columns; the JSON record wins over the index.

    Index and finance have one row per plant; plants without an index id match none.
    """
    plants = reg.plants if plants is None else plants
    index = reg.plant_index.select(
        F.col("plant_id").alias("eia_plant_id"),
        F.struct(*[c for c in reg.plant_index.columns if c != "plant_id"]).alias("_index"),
    )
    finance = reg.financial_plant.select(F.col("plant_id").alias("id"), "latest_capex_per_kw")
    # many plants have no index id, and those must not meet in one task
    indexed = lookup_join(plants, index, ["eia_plant_id"], spread="id")
    joined = indexed.join(finance, "id", "left")
    parsed = joined.withColumn("_json", F.from_json("data", _JSON_SCHEMA))

    def resolved(name):
        from_json = [first_non_blank(f"_json.{key}") for key in JSON_CHAINS[name]]
        from_index = [F.col(f"_index.{key}").cast("string") for key in INDEX_CHAINS[name]]
        return F.coalesce(*from_json, *from_index)

    decimals = {"latitude": COORDINATE, "longitude": COORDINATE, "total_capacity_mw": CAPACITY}
    return parsed.select(
        F.col("id").alias("plant_uuid"),
        "eia_plant_id",
        F.col("slug").alias("plant_slug"),
        "source_type",
        F.col("workspace_id").alias("_home_workspace"),
        *[
            (as_decimal(resolved(name), decimals[name]) if name in decimals else resolved(name)).alias(name)
            for name in JSON_CHAINS
        ],
        clean_array("_index.fuel_types").alias("fuel_types"),
        clean_array("_index.technologies").alias("technologies"),
        as_decimal(F.col("latest_capex_per_kw").cast("string"), CAPEX).alias("latest_capex_per_kw"),
    )


def _workspaces(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("id").alias("workspace_id"), F.col("slug").alias("workspace_slug"), F.lit(True).alias("_is_workspace")
    )


def _portfolios(df: DataFrame) -> DataFrame:
    return live(df).select(
        F.col("id").alias("portfolio_id"),
        F.col("name").alias("portfolio_name"),
        F.col("kind").alias("portfolio_kind"),
        F.lit(True).alias("_is_portfolio"),
    )


def _states(df: DataFrame) -> DataFrame:
    return df.select(
        "workspace_id", F.col("plant_id").alias("plant_uuid"), F.col("state").alias("workspace_asset_state")
    )


def _finish(df: DataFrame) -> DataFrame:
    return df.select(*SCOPE_COLUMNS, *[c for c in df.columns if c not in SCOPE_COLUMNS and c[0] != "_"])


# -- scopes ------------------------------------------------------------------------


def scope_reference(reg: Registry) -> DataFrame:
    """Every reference plant, that is one no workspace owns. Scope columns are null."""
    records = plant_records(reg, reg.plants.where(F.col("workspace_id").isNull()))
    return _finish(records.withColumns({c: F.lit(None).cast("string") for c in SCOPE_COLUMNS}))


def scope_plants(reg: Registry, ids: Sequence[str] | DataFrame) -> DataFrame:
    """Chosen plants, with each live portfolio they sit in.

    A plant in several live portfolios gives one row for each. ``ids`` is a short
    list, or a DataFrame with a column ``id`` for a long one.
    """
    if isinstance(ids, DataFrame):
        chosen = reg.plants.join(ids.select("id").distinct(), "id", "left_semi")
    else:
        chosen = reg.plants.where(F.col("id").isin(*ids))
    records = plant_records(reg, chosen).withColumn("workspace_id", F.col("_home_workspace"))
    memberships = live(reg.portfolio_asset).select(
        F.col("id").alias("portfolio_asset_id"), F.col("reference_plant_id").alias("plant_uuid"), "portfolio_id"
    )
    owned = lookup_join(records, _workspaces(reg.workspace), ["workspace_id"], spread="plant_uuid")
    # a workspace that is not in the table leaves its id null, as the joined id would be
    owned = owned.withColumn(
        "workspace_id", F.when(F.col("_is_workspace"), F.col("workspace_id"))
    )
    placed = lookup_join(owned, _states(reg.workspace_asset), ["workspace_id", "plant_uuid"])
    return _finish(_with_live_portfolio(left_join_many(placed, memberships, ["plant_uuid"]), reg))


def _with_live_portfolio(df: DataFrame, reg: Registry) -> DataFrame:
    """Adds the portfolio; a membership of a deleted portfolio keeps its row without one."""
    named = lookup_join(df, _portfolios(reg.portfolio), ["portfolio_id"], spread="plant_uuid")
    return named.withColumn(
        "portfolio_id", F.when(F.col("_is_portfolio"), F.col("portfolio_id"))
    )


def scope_portfolio(reg: Registry, portfolio_id: str | None = None) -> DataFrame:
    """Plants of one live portfolio, or of every live portfolio when none is named."""
    memberships = live(reg.portfolio_asset)
    portfolios = _portfolios(reg.portfolio)
    if portfolio_id is not None:
        memberships = memberships.where(F.col("portfolio_id") == portfolio_id)
        portfolios = portfolios.where(F.col("portfolio_id") == portfolio_id)
    facts = memberships.select(
        F.col("id").alias("portfolio_asset_id"),
        F.col("reference_plant_id").alias("plant_uuid"),
        "portfolio_id",
        "workspace_id",
    )
    facts = lookup_join(facts, plant_records(reg), ["plant_uuid"], "inner")
    facts = lookup_join(facts, portfolios, ["portfolio_id"], "inner")
    facts = lookup_join(facts, _workspaces(live(reg.workspace)), ["workspace_id"], "inner")
    return _finish(lookup_join(facts, _states(reg.workspace_asset), ["workspace_id", "plant_uuid"]))


def scope_workspace(reg: Registry, workspace_id: str | None = None, state: str = "portfolio") -> DataFrame:
    """Plants of one workspace (or of all) in a state, with their baseline portfolio.

    ``state`` is ``portfolio``, ``prospect`` or ``all``.
    """
    facts = _states(reg.workspace_asset)
    if workspace_id is not None:
        facts = facts.where(F.col("workspace_id") == workspace_id)
    if state != "all":
        facts = facts.where(F.col("workspace_asset_state") == state)
    baseline = live(reg.portfolio_asset).where(F.col("is_baseline")).select(
        "workspace_id",
        F.col("reference_plant_id").alias("plant_uuid"),
        F.col("id").alias("portfolio_asset_id"),
        "portfolio_id",
    )
    facts = lookup_join(facts, plant_records(reg), ["plant_uuid"], "inner")
    facts = lookup_join(facts, _workspaces(live(reg.workspace)), ["workspace_id"], "inner")
    facts = left_join_many(facts, baseline, ["workspace_id", "plant_uuid"])
    return _finish(_with_live_portfolio(facts, reg))


# -- names to ids --------------------------------------------------------------------


def resolve_workspace(workspace: DataFrame, slug: str) -> str:
    """The id of the live workspace with this slug."""
    found = live(workspace).where(F.col("slug") == slug).select("id").limit(1).collect()
    if not found:
        raise LookupError(f"no live workspace has the slug {slug!r}")
    return found[0]["id"]


def list_portfolios(portfolio: DataFrame, workspace_id: str) -> DataFrame:
    """Live portfolios of a workspace, newest first."""
    return live(portfolio).where(F.col("workspace_id") == workspace_id).orderBy(*portfolio_order())


def portfolio_order() -> list[Column]:
    """Newest first; portfolios of one moment by id."""
    return [F.col("created_at").desc(), F.col("id")]


def resolve_portfolio(portfolio: DataFrame, workspace_id: str, name: str) -> str:
    """The id of the one live portfolio with this name; none or several is an error."""
    found = (
        live(portfolio)
        .where((F.col("workspace_id") == workspace_id) & (F.col("name") == name))
        .select("id")
        .limit(2)
        .collect()
    )
    if len(found) != 1:
        problem = "several live portfolios have" if found else "no live portfolio has"
        raise LookupError(f"{problem} the name {name!r} in workspace {workspace_id!r}")
    return found[0]["id"]


def in_export_order(scope: DataFrame, limit: int | None = None) -> DataFrame:
    """Workspace, portfolio, plant; ties by membership so that the order is total."""
    ordered = scope.orderBy(*export_order())
    return ordered if limit is None else ordered.limit(limit)


def export_order():
    blank = F.lit("")
    return [
        F.coalesce("workspace_slug", blank),
        F.coalesce("portfolio_name", blank),
        F.col("plant_slug"),
        F.col("plant_uuid"),
        F.coalesce("portfolio_asset_id", blank),
    ]

"""The same questions in plain SQL over the check tables, written for DuckDB.

The SQL is written from the rules, not generated from the Spark code. Only the
input views and a few repeated expressions are shared between the statements.
"""

from __future__ import annotations

import re

from hazardlens.schemas import UPLOAD_LAYOUT

ORACLE: dict[str, str] = {}


# -- repeated expressions -----------------------------------------------------------


def score(c: str) -> str:
    return (
        f"coalesce(CASE WHEN length(trim({c})) = 1 THEN strpos('ABCDEFG', upper(trim({c}))) ELSE 0 END, 0)"
    )


def letter(s: str) -> str:
    return f"CASE WHEN {s} BETWEEN 1 AND 7 THEN substr('ABCDEFG', {s}::INTEGER, 1) END"


def pick(values: list, index: str) -> str:
    listed = ", ".join("NULL" if x is None else "'" + x.replace("'", "''") + "'" for x in values)
    return f"([{listed}])[(({index}) + 1)::INTEGER]"


def uuid(number: str) -> str:
    h = f"md5(({number})::VARCHAR)"
    parts = [f"substr({h}, {start}, {size})" for start, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return " || '-' || ".join(parts)


def returned_name(a: str) -> str:
    return f"CASE WHEN {a} % 7 = 6 THEN 'ext_' || {a} ELSE 'is_p_' || md5({a}::VARCHAR) END"


def dec(c: str) -> str:
    """Decimal text without trailing zeros, blank for null."""
    return f"""CASE WHEN {c} IS NULL THEN '' WHEN {c} = 0 THEN '0' WHEN strpos(({c})::VARCHAR, '.') > 0
      THEN rtrim(rtrim(({c})::VARCHAR, '0'), '.') ELSE ({c})::VARCHAR END"""


HAZARDS = ["Flood", "Heat", "Wind", "Drought", "Wildfire", ""]
T_SCENARIOS = ["Below 2C", "Current Policies", "Delayed Transition", "Low Demand", "NDCs", "Net Zero 2050"]
T_INDICATORS = ["Carbon price", "scope12_intensity", "Revenue growth", "Inflation", "scope3_intensity"]
FUELS = ["SUN", "WND", "WAT", "NG", "NUC", "BIT", "DFO", "MWH", "GEO", "OBG", "MSW", "XX"]
TECHNOLOGIES = [
    "Solar Thermal",
    "Offshore Wind Turbine",
    "Hydroelectric Pumped Storage",
    "Conventional",
    "Batteries",
]
TYPES = [
    "Battery storage unit",
    "Biomass power plant",
    "Coal power Plant",
    "Gas power Plant",
    "Geothermal power plant",
    "Hydroelectric dam",
    "Nuclear power plant",
    "Off-shore wind power generation facility",
    "On-shore wind power generation facility",
    "Other power plant",
    "Photovoltaic power generation facility",
    "Pumped hydroelectric storage facility",
    "Thermal solar power facility",
    "Waste to power facility",
]

# -- input views ----------------------------------------------------------------------

VIEWS = {
    "phys": f"""
    SELECT event_id AS seq, 'physical_' || (event_id % 3) AS source_file,
      CASE WHEN event_id % 97 = 0 THEN '' ELSE {returned_name('a')} END AS "assetName",
      'ID_' || a || CASE WHEN event_id % 50 = 0 AND a % 3 = 0 THEN 'b' ELSE '' END AS "assetId",
      '(' || (a % 90) || '.5,-' || (a % 180) || '.25)' AS "geolocationCoordinates",
      CASE WHEN a % 8 = 1 THEN 'CAN' ELSE 'USA' END AS "countryCode",
      {pick(['Temperate', 'Arid', 'Tropical'], 'a % 3')} AS "climateZone",
      'IC' || ((a % 5) * 1000 + 1010) || '20' AS "ticcsSubClass",
      'Class ' || (a % 5) AS "ticcsSubClassName",
      CASE WHEN event_type IN ('view', 'click', 'signup') THEN 'ssp2-4.5' ELSE 'ssp5-8.5' END AS scenario,
      CASE WHEN event_id % 17 = 0 THEN 'Historical' WHEN event_id % 101 = 1 THEN '2025.0'
        ELSE (2025 + 25 * (event_id % 4))::VARCHAR END AS "timeHorizon",
      'ind_' || (event_id % 3) AS indicator,
      CASE WHEN event_id % 7 <> 0 THEN floor(value / 10) END AS "indicatorValue",
      {pick(['m', 'days', ''], 'event_id % 3')} AS "indicatorUnit",
      CASE WHEN event_id % 23 = 5 THEN ' a' WHEN (k + event_id) % 9 = 7 THEN 'NA'
        WHEN (k + event_id) % 9 = 8 THEN '' ELSE substr('ABCDEFG', ((k + event_id) % 9 + 1)::INTEGER, 1)
        END AS "indicatorRating",
      {pick(HAZARDS, 'k % 6')} AS hazard,
      substr('ABCDEFG', (event_id % 5 + 1)::INTEGER, 1) AS "HazardRating",
      CASE WHEN k % 4 <> 3 THEN substr('ABCDEFG', k % 4 + 1, 1) END AS "hazardExposureRating",
      CASE event_id % 6 WHEN 0 THEN 'NA' WHEN 1 THEN '' ELSE 'C' END AS "adjustedHazardExposureRating",
      CASE WHEN event_id % 11 = 0 THEN NULL WHEN k % 6 = 0 THEN 0.25::DOUBLE
        ELSE floor(value / 10) * 0.5::DOUBLE END AS "adjustedHazardValueImpact",
      CASE WHEN k % 6 NOT IN (1, 3) THEN floor(value / 20) * 0.25::DOUBLE END AS "adjustedHazardDamage",
      CASE WHEN event_id % 31 = 0 THEN 'nan'::DOUBLE WHEN event_id % 37 = 0 THEN '-inf'::DOUBLE
        WHEN k % 6 <> 3 THEN floor(value / 5) * 0.125::DOUBLE END AS "adjustedHazardDisruption",
      floor(value / 10) * 0.5::DOUBLE - floor(value / 20) * 0.25::DOUBLE
        + CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END AS "adjustedHazardDisruptionDamageEquivalent",
      CASE WHEN event_id % 5 <> 0 THEN floor(value / 10) * 0.5::DOUBLE END AS "adjustedTotalDamage",
      CASE WHEN event_id % 9 <> 0 THEN floor(value / 15) * 0.25::DOUBLE END AS "adjustedTotalDisruption",
      floor(value / 30) AS "adjustedTotalDisruptionDamageEquivalent",
      CASE WHEN event_id % 13 <> 0 THEN floor(value / 10) * 0.5::DOUBLE + (event_id % 3) * 0.5::DOUBLE END
        AS "adjustedTotalValueImpact",
      substr('ABCDEFG', (event_id % 7 + 1)::INTEGER, 1) AS "physicalExposureRating",
      {pick(['B', 'NA', '', None], 'event_id % 4')} AS "adjustedPhysicalExposureRating"
    FROM (SELECT *, user_id // 10 AS a, (props::JSON->>'$.k')::INTEGER AS k FROM events)""",
    "trans": f"""
    SELECT i AS seq, 'transition_' || (i % 3) AS source_file, {returned_name('a')} AS "assetName",
      'ID_' || a AS "assetId", '(' || (a % 90) || '.5,-' || (a % 180) || '.25)' AS "geolocationCoordinates",
      'USA' AS "countryCode", {pick(['Temperate', 'Arid', 'Tropical'], 'a % 3')} AS "climateZone",
      'IC' || ((a % 5) * 1000 + 1010) || '20' AS "ticcsSubClass", 'Class ' || (a % 5) AS "ticcsSubClassName",
      {pick(T_SCENARIOS, '(i // 40) % 6')} AS scenario,
      CASE WHEN i % 19 = 0 THEN 'Historical' ELSE (2025 + 5 * (i % 8))::VARCHAR END AS "timeHorizon",
      {pick(T_INDICATORS, 'i % 5')} AS indicator,
      floor(o_totalprice / 1000) AS "indicatorValue",
      CASE WHEN i % 5 < 2 THEN 'USD' ELSE '' END AS "indicatorUnit",
      CASE WHEN i % 25 = 4 THEN '' WHEN i % 5 < 2 THEN 'Direct_carbon_cost' ELSE 'Market_demand_shifts' END
        AS subrisk,
      CASE WHEN i % 11 <> 0 THEN floor(o_totalprice / 20000) * 0.5::DOUBLE END AS "adjustedSubriskRevenueImpact",
      substr('ABCDEFG', (i % 7 + 1)::INTEGER, 1) AS "subriskExposureRating",
      CASE i % 3 WHEN 0 THEN '' WHEN 1 THEN 'C' END AS "adjustedSubriskExposureRating",
      substr('ABCDEFG', ((i // 3) % 7 + 1)::INTEGER, 1) AS "transitionExposureRating",
      CASE i % 4 WHEN 0 THEN '' WHEN 1 THEN 'NA' ELSE 'B' END AS "adjustedTransitionExposureRating"
    FROM (SELECT *, o_orderkey AS i, o_custkey // 100 AS a FROM orders)""",
    "hist": """
    SELECT *, 'import_' || ((seq // 50) % 4) AS import_id,
      '2026-07-0' || (((seq // 50) % 4) % 3 + 1) AS imported_at FROM phys""",
    "mani_all": f"""
    SELECT n AS seq, 'pf_' || (n % 25) AS portfolio_id, * FROM (SELECT c_custkey AS n, * FROM customer)
    UNION ALL
    SELECT n + 1000000000, 'pf_again', * FROM (SELECT c_custkey AS n, * FROM customer WHERE c_custkey % 10 = 0)""",
    "mani": f"""
    SELECT 'is_p_' || md5(n::VARCHAR) AS scr_asset_name, 'run_' || (n % 3) AS scr_run_id, 'plant' AS scr_grain,
      CASE WHEN n % 17 = 5 THEN {uuid('n + 1')} ELSE {uuid('n')} END AS plant_uuid,
      'plant-' || n AS plant_slug, arg_max(portfolio_id, seq) AS portfolio_id,
      'pa_' || n AS portfolio_asset_id, any_value(c_name) AS plant_name,
      CASE WHEN n % 4 <> 0 THEN any_value(c_mktsegment) END AS asset_type,
      CASE WHEN n % 13 = 0 THEN NULL WHEN n % 11 = 3 THEN (n % 90) || '.75' ELSE (n % 90) || '.5' END AS latitude,
      CASE WHEN n % 13 = 0 THEN NULL ELSE '-' || (n % 180) || '.25' END AS longitude
    FROM mani_all GROUP BY n""",
    "pvalid": """
    SELECT *, "assetName" AS asset_name, "timeHorizon"::INTEGER AS horizon FROM phys
    WHERE "assetName" <> '' AND regexp_full_match("timeHorizon", '[0-9]+')""",
    "tvalid": """
    SELECT *, "assetName" AS asset_name, "timeHorizon"::INTEGER AS horizon FROM trans
    WHERE "assetName" <> '' AND regexp_full_match("timeHorizon", '[0-9]+')""",
    "inds": """
    SELECT asset_name, scenario, horizon, hazard, indicator, "indicatorValue" AS value,
      nullif("indicatorUnit", '') AS unit, nullif("indicatorRating", '') AS rating, seq FROM pvalid""",
    "subs": """
    SELECT asset_name, scenario, horizon, indicator, "indicatorValue" AS indicator_value,
      nullif("indicatorUnit", '') AS indicator_unit, subrisk,
      "adjustedSubriskRevenueImpact" AS adjusted_revenue_impact,
      coalesce(nullif("adjustedSubriskExposureRating", ''), "subriskExposureRating") AS rating, seq
    FROM tvalid""",
    "ptrends": f"""
    SELECT asset_name, scenario, horizon,
      arg_max("adjustedTotalDamage", seq) FILTER ("adjustedTotalDamage" IS NOT NULL) AS adjusted_total_damage,
      arg_max("adjustedTotalDisruption", seq) FILTER ("adjustedTotalDisruption" IS NOT NULL)
        AS adjusted_total_disruption,
      arg_max("adjustedTotalDisruptionDamageEquivalent", seq) AS adjusted_total_disruption_damage_equivalent,
      arg_max("adjustedTotalValueImpact", seq) FILTER ("adjustedTotalValueImpact" IS NOT NULL)
        AS adjusted_total_value_impact,
      {letter("max(" + score("coalesce(nullif(\"adjustedPhysicalExposureRating\", ''), \"physicalExposureRating\")") + ")")}
        AS adjusted_physical_exposure_rating
    FROM pvalid GROUP BY ALL""",
    "haz": f"""
    SELECT asset_name, scenario, horizon, hazard,
      max("adjustedHazardDamage") AS adjusted_hazard_damage,
      max("adjustedHazardDisruption") FILTER (NOT isnan("adjustedHazardDisruption")
        AND "adjustedHazardDisruption" > '-inf'::DOUBLE) AS adjusted_hazard_disruption,
      max("adjustedHazardDisruptionDamageEquivalent") AS adjusted_hazard_disruption_damage_equivalent,
      max("adjustedHazardValueImpact") AS adjusted_hazard_value_impact,
      {letter('max(greatest(' + ', '.join(score(c) for c in ('"adjustedHazardExposureRating"', '"hazardExposureRating"', '"HazardRating"')) + '))')}
        AS hazard_rating,
      {', '.join(f'''count(*) FILTER ("indicatorRating" = '{x}') AS "rating_{x}"''' for x in 'ABCDEFG')}
    FROM pvalid WHERE hazard <> '' GROUP BY ALL""",
    "ttrends": f"""
    SELECT t.asset_name, t.scenario, t.horizon, max(top.v) AS max_adjusted_subrisk_revenue_impact,
      any_value(top.subrisk) AS top_subrisk,
      {letter('max(' + score("coalesce(nullif(\"adjustedTransitionExposureRating\", ''), \"transitionExposureRating\")") + ')')}
        AS transition_rating
    FROM tvalid t LEFT JOIN (
      SELECT asset_name, scenario, horizon, "adjustedSubriskRevenueImpact" AS v, subrisk,
        row_number() OVER (PARTITION BY asset_name, scenario, horizon
          ORDER BY "adjustedSubriskRevenueImpact" DESC, seq) AS r
      FROM tvalid WHERE "adjustedSubriskRevenueImpact" IS NOT NULL) top
    ON t.asset_name = top.asset_name AND t.scenario = top.scenario AND t.horizon = top.horizon AND top.r = 1
    GROUP BY ALL""",
    "peaks": """
    SELECT asset_name, scenario, subrisk, value, year, rating, first_seen FROM (
      SELECT asset_name, scenario, subrisk, adjusted_revenue_impact AS value, horizon AS year, rating,
        min(seq) OVER (PARTITION BY asset_name, scenario, subrisk) AS first_seen,
        row_number() OVER (PARTITION BY asset_name, scenario, subrisk
          ORDER BY adjusted_revenue_impact DESC, seq) AS r
      FROM subs WHERE subrisk <> '' AND adjusted_revenue_impact IS NOT NULL) WHERE r = 1""",
    "ranks": """
    SELECT b.asset_name, b.scenario, b.value AS peak_impact, b.year AS peak_year, b.subrisk AS peak_subrisk,
      d.value AS direct_carbon_value, d.year AS direct_carbon_year, d.rating AS direct_carbon_rating,
      m.value AS market_demand_value, m.year AS market_demand_year, m.rating AS market_demand_rating
    FROM (SELECT *, row_number() OVER (PARTITION BY asset_name, scenario ORDER BY value DESC, first_seen) AS r
          FROM peaks) b
    LEFT JOIN peaks d ON d.asset_name = b.asset_name AND d.scenario = b.scenario
      AND d.subrisk = 'Direct_carbon_cost'
    LEFT JOIN peaks m ON m.asset_name = b.asset_name AND m.scenario = b.scenario
      AND m.subrisk = 'Market_demand_shifts'
    WHERE b.r = 1""",
    "firsts": """
    SELECT asset_name, scr_asset_id, coordinates, country_code, climate_zone, ticcs_sub_class,
      ticcs_sub_class_name FROM (
      SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY src, seq) AS r FROM (
        SELECT 0 AS src, seq, "assetName" AS asset_name, "assetId" AS scr_asset_id,
          "geolocationCoordinates" AS coordinates, "countryCode" AS country_code,
          "climateZone" AS climate_zone, "ticcsSubClass" AS ticcs_sub_class,
          "ticcsSubClassName" AS ticcs_sub_class_name FROM phys
        UNION ALL
        SELECT 1, seq, "assetName", "assetId", "geolocationCoordinates", "countryCode", "climateZone",
          "ticcsSubClass", "ticcsSubClassName" FROM trans)
      WHERE asset_name <> '') WHERE r = 1""",
    "vocab": f"""
    SELECT DISTINCT upper({pick(['Flood', 'Heat', 'Wind', 'Drought', 'Hail'], 'p_partkey % 5')}) AS term
    FROM part""",
    # registry
    "plants": f"""
    SELECT n, {uuid('n')} AS id, CASE WHEN n % 10 <> 9 THEN n::INTEGER END AS eia_plant_id,
      'plant-' || n AS slug, CASE WHEN n % 20 = 0 THEN 'user_added' ELSE 'eia' END AS source_type,
      CASE WHEN n % 6 = 0 THEN 'ws_' || (n % 5) END AS workspace_id,
      c_nationkey, c_acctbal FROM (SELECT c_custkey AS n, * FROM customer)""",
    "rec": f"""
    SELECT id AS plant_uuid, eia_plant_id, slug AS plant_slug, source_type, workspace_id AS home,
      CASE WHEN n % 3 = 0 THEN 'Plant ' || n WHEN n % 4 = 0 THEN 'Site ' || n
        WHEN idx THEN 'Index ' || n END AS plant_name,
      CASE WHEN n % 5 = 0 THEN 'Utility ' || (n % 50)
        WHEN idx THEN CASE WHEN n % 3 = 0 THEN 'Owner' ELSE 'Index Utility' END END AS operating_entity_name,
      CASE WHEN n % 6 <> 0 THEN 'S' || c_nationkey WHEN idx THEN 'TX' END AS state,
      CASE WHEN n % 7 = 0 THEN 'Lake County ' || n WHEN idx AND n % 2 = 0 THEN 'Travis' END AS county,
      CASE WHEN n % 8 = 0 THEN ' City ' || n WHEN n % 8 = 1 THEN 'Town ' || n END AS city,
      CASE WHEN n % 2 = 0 THEN '9' || n END AS postal_code,
      CASE WHEN n % 16 = 0 THEN n || ' Main St' WHEN n % 16 = 1 THEN n || ' Side St' END AS address_raw,
      CASE WHEN n % 13 = 0 THEN CASE WHEN idx THEN (n % 90)::DECIMAL(38, 9) END WHEN n % 13 = 1 THEN NULL
        ELSE ((n % 90) || '.50')::DECIMAL(38, 9) END AS latitude,
      CASE WHEN n % 3 = 0 THEN ('-' || (n % 180) || '.25')::DECIMAL(38, 9)
        WHEN idx THEN (-(n % 180))::DECIMAL(38, 9) END AS longitude,
      CASE WHEN n % 9 = 0 THEN 'NG' WHEN idx THEN {pick(FUELS, 'n % 12')} END AS primary_fuel,
      CASE WHEN n % 10 = 0 THEN ((n % 500) || '.5')::DECIMAL(18, 6)
        WHEN idx THEN (n % 700)::DECIMAL(18, 6) END AS total_capacity_mw,
      CASE WHEN idx THEN [{pick(FUELS, 'n % 12')}, {pick(FUELS, '(n + 5) % 12')}] ELSE [] END AS fuels,
      CASE WHEN idx THEN {pick(TECHNOLOGIES, 'n % 5')} ELSE '' END AS technologies,
      CASE WHEN n % 4 <> 0 THEN c_acctbal::DECIMAL(12, 2)::DECIMAL(18, 6) END AS latest_capex_per_kw
    FROM (SELECT *, n % 5 <> 0 AND n % 10 <> 9 AS idx FROM plants)""",
    "ws": """
    SELECT 'ws_' || r_regionkey AS id, lower(r_name) AS slug, r_regionkey <> 4 AS is_live FROM region""",
    "wsa": f"""
    SELECT 'ws_' || (c_custkey % 5) AS workspace_id, {uuid('c_custkey')} AS plant_uuid,
      CASE WHEN c_custkey % 3 = 0 THEN 'prospect' ELSE 'portfolio' END AS state FROM customer""",
    "pf": """
    SELECT 'pf_' || n_nationkey AS id, 'ws_' || (n_nationkey % 5) AS workspace_id, n_name AS name,
      CASE WHEN n_nationkey % 2 = 0 THEN 'model' ELSE 'client' END AS kind,
      '2026-01-' || lpad((n_nationkey + 1)::VARCHAR, 2, '0') AS created_at
    FROM nation WHERE n_nationkey % 11 <> 10""",
    "pfa": f"""
    SELECT 'pa_' || i AS id, 'ws_' || (i % 5) AS workspace_id, 'pf_' || (i % 25) AS portfolio_id,
      {uuid('o_custkey')} AS plant_uuid, i % 2 = 0 AS is_baseline
    FROM (SELECT o_orderkey AS i, * FROM orders) WHERE i % 9 <> 0""",
    "scope": """
    SELECT w.id AS workspace_id, w.slug AS workspace_slug, f.id AS portfolio_id, f.name AS portfolio_name,
      f.kind AS portfolio_kind, pa.id AS portfolio_asset_id, wa.state AS workspace_asset_state, r.* EXCLUDE (home)
    FROM rec r JOIN pfa pa ON pa.plant_uuid = r.plant_uuid JOIN pf f ON f.id = pa.portfolio_id
    JOIN ws w ON w.id = pa.workspace_id AND w.is_live
    LEFT JOIN wsa wa ON wa.workspace_id = pa.workspace_id AND wa.plant_uuid = r.plant_uuid""",
    "wscope": """
    SELECT w.id AS workspace_id, w.slug AS workspace_slug, f.id AS portfolio_id, f.name AS portfolio_name,
      f.kind AS portfolio_kind, pa.id AS portfolio_asset_id, wa.state AS workspace_asset_state, r.* EXCLUDE (home)
    FROM rec r JOIN wsa wa ON wa.plant_uuid = r.plant_uuid JOIN ws w ON w.id = wa.workspace_id AND w.is_live
    LEFT JOIN pfa pa ON pa.workspace_id = wa.workspace_id AND pa.plant_uuid = r.plant_uuid AND pa.is_baseline
    LEFT JOIN pf f ON f.id = pa.portfolio_id""",
    "side": f"""
    SELECT i AS seq,
      CASE kind WHEN 0 THEN {uuid('o_custkey')} WHEN 1 THEN 'is_p_' || md5(o_custkey::VARCHAR)
        WHEN 2 THEN 'pa_' || i ELSE o_custkey::VARCHAR END AS k,
      CASE WHEN kind = 3 THEN o_custkey::VARCHAR ELSE '' END AS eia_plant_id,
      CASE WHEN i % 3 <> 0 THEN floor(o_totalprice)::BIGINT || '.50' ELSE '' END AS asset_value,
      CASE WHEN i % 2 = 0 THEN (i % 9) || ',500' ELSE '' END AS revenues,
      CASE WHEN i % 15 = 0 THEN '2024' ELSE '' END AS year,
      CASE WHEN i % 20 = 0 THEN '0.25' ELSE '' END AS detention_rate,
      CASE WHEN i % 4 = 0 THEN 'Operator ' || (i % 30) ELSE '' END AS operating_entity_name,
      CASE WHEN i % 35 = 0 THEN 'Street ' || i ELSE '' END AS address,
      CASE WHEN i % 55 = 0 THEN 'Unheard-of plant' ELSE '' END AS asset_type,
      CASE WHEN i % 45 = 0 THEN 'Canada' WHEN i % 65 = 0 THEN 'Atlantis' ELSE '' END AS country,
      CASE WHEN i % 25 = 0 THEN '12.5' ELSE '' END AS scope_1,
      CASE WHEN i % 10 = 0 THEN '0.5' ELSE '1.5' END AS flood_barriers
    FROM (SELECT o_orderkey AS i, (o_orderkey // 5) % 4 AS kind, * FROM orders)""",
    "sidx": """
    SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS r FROM side)
    WHERE r = 1""",
    "types": f"""
    SELECT DISTINCT {pick(TYPES, 'p_partkey % 14')} AS asset_type, 'D35.' || (p_partkey % 14 + 10) AS nace_code,
      'Sector ' || ((p_partkey % 14) % 3) AS sector, 'IC' || ((p_partkey % 14) * 10 + 1000) AS ticcs_class,
      'Class ' || (p_partkey % 14) AS ticcs_class_name FROM part WHERE p_partkey % 14 <> 4""",
    "countries": """
    SELECT * FROM (VALUES ('United States', 'USA'), ('Canada', 'CAN'), ('Mexico', 'MEX'), ('Chile', 'CHL'),
      ('Peru', 'PER')) t(country, iso3)
    WHERE country IN (SELECT (['United States', 'Canada', 'Mexico', 'Chile', 'Peru'])[(p_partkey % 5 + 1)::INTEGER] FROM part)""",
}

TYPE_RULE = """CASE
  WHEN list_contains(codes, 'MWH') OR strpos(tech, 'battery') > 0 OR strpos(label, 'battery') > 0
    THEN 'Battery storage unit'
  WHEN list_contains(codes, 'SUN') THEN CASE WHEN strpos(tech, 'thermal solar') + strpos(tech, 'solar thermal') > 0
    THEN 'Thermal solar power facility' ELSE 'Photovoltaic power generation facility' END
  WHEN list_contains(codes, 'WND') THEN CASE WHEN strpos(tech, 'offshore') + strpos(label, 'off-shore') + strpos(label, 'offshore') > 0
    THEN 'Off-shore wind power generation facility' ELSE 'On-shore wind power generation facility' END
  WHEN list_contains(codes, 'WAT') THEN CASE WHEN strpos(tech, 'pumped') + strpos(label, 'pumped') > 0
    THEN 'Pumped hydroelectric storage facility' ELSE 'Hydroelectric dam' END
  ELSE coalesce([CASE
    WHEN c = 'GEO' THEN 'Geothermal power plant' WHEN c = 'NUC' THEN 'Nuclear power plant'
    WHEN c IN ('NG', 'BFG', 'OG', 'PG') THEN 'Gas power Plant'
    WHEN c IN ('BIT', 'SUB', 'LIG', 'WC', 'RC') THEN 'Coal power Plant'
    WHEN c IN ('DFO', 'RFO', 'JF', 'KER', 'WO') THEN 'Other power plant'
    WHEN c IN ('OBG', 'OBL', 'OBS', 'AB', 'WDL', 'WDS', 'LFG') THEN 'Biomass power plant'
    WHEN c = 'MSW' THEN 'Waste to power facility' END FOR c IN codes IF c NOT IN ('', 'XX', 'SUN', 'WND', 'WAT', 'MWH')][1], 'Other power plant') END"""


def typed(source: str) -> str:
    """Plants with the inferred asset type."""
    return f"""(SELECT *, {TYPE_RULE} AS inferred FROM (
      SELECT *, list_prepend(coalesce(primary_fuel, ''), fuels) AS codes, lower(technologies) AS tech,
        lower(coalesce(nullif(plant_name, ''), plant_slug)) AS label FROM {source}))"""


def address(side: str) -> str:
    def listed(*parts):
        return "concat_ws(', ', " + ", ".join(f"trim({p})" for p in parts) + ", 'USA')"

    return f"""CASE WHEN {side} <> '' THEN {side}
      WHEN address_raw <> '' THEN {listed('address_raw', 'city', 'state', 'postal_code')}
      WHEN city <> '' AND state <> '' THEN {listed('city', 'state', 'postal_code')}
      WHEN county <> '' AND state <> '' THEN
        CASE WHEN strpos(lower(county), 'county') > 0 THEN county ELSE county || ' County' END || ', ' || state || ', USA'
      WHEN state <> '' THEN state || ', USA' ELSE '' END"""


def address_source(side: str) -> str:
    return f"""CASE WHEN {side} <> '' THEN 'sidecar' WHEN address_raw <> '' THEN 'plants.data.address'
      WHEN city <> '' AND state <> '' THEN 'city_state_fallback'
      WHEN county <> '' AND state <> '' THEN 'county_state_fallback'
      WHEN state <> '' THEN 'state_fallback' ELSE 'missing' END"""


def exported(max_name: int, proxy: bool, detention: str) -> str:
    """Scope rows with the sidecar row found and every value resolved."""
    full = "'plant-' || split_part(plant_slug, '-', 2) || '__is_p_' || replace(plant_uuid, '-', '')"
    name = f"CASE WHEN length({full}) <= {max_name} THEN {full} ELSE 'is_p_' || replace(plant_uuid, '-', '') END"

    def field(c):
        return f"CASE WHEN s0.k IS NOT NULL THEN s0.{c} WHEN s1.k IS NOT NULL THEN s1.{c} WHEN s2.k IS NOT NULL THEN s2.{c} ELSE s3.{c} END AS side_{c}"

    fields = "asset_value revenues year detention_rate operating_entity_name address asset_type country scope_1 flood_barriers".split()
    proxy_value = "(total_capacity_mw::DECIMAL(19, 6) * latest_capex_per_kw::DECIMAL(19, 6))::DECIMAL(30, 8) * 1000::DECIMAL(4, 0)" if proxy else "NULL::DECIMAL(38, 9)"
    return f"""(
    SELECT *, coalesce(stated, proxy) IS NULL AS no_value, revenues IS NULL AS no_revenues
    FROM (
      SELECT x.* EXCLUDE (asset_type, country), x.asset_type, x.country, t.asset_type AS known_type, t.nace_code, t.sector, t.ticcs_class,
        t.ticcs_class_name, c.iso3 AS country_code
      FROM (
        SELECT *, coalesce(nullif(side_asset_type, ''), inferred) AS asset_type,
          coalesce(nullif(side_country, ''), 'United States') AS country,
          {address('side_address')} AS full_address, {address_source('side_address')} AS address_source,
          coalesce(nullif(side_detention_rate, ''), {detention})::DECIMAL(18, 6) AS detention,
          nullif(replace(side_revenues, ',', ''), '')::DECIMAL(18, 6) AS revenues,
          nullif(side_asset_value, '')::DECIMAL(18, 6) AS stated,
          CASE WHEN nullif(side_asset_value, '') IS NULL THEN {proxy_value} END AS proxy,
          coalesce(nullif(side_year, ''), '2026') AS valuation_year
        FROM (
          SELECT a.*, {', '.join(field(c) for c in fields)}
          FROM (SELECT *, {name} AS scr_asset_name FROM {typed('scope')}) a
          LEFT JOIN sidx s0 ON s0.k = a.plant_uuid
          LEFT JOIN sidx s1 ON s1.k = a.scr_asset_name
          LEFT JOIN sidx s2 ON s2.k = a.portfolio_asset_id
          LEFT JOIN sidx s3 ON s3.k = a.eia_plant_id::VARCHAR)) x
      LEFT JOIN types t ON t.asset_type = x.asset_type
      LEFT JOIN countries c ON c.country = x.country))"""


PLAIN_WARNINGS = """concat_ws('|', CASE WHEN full_address = '' THEN 'missing_address' END,
  CASE WHEN country_code IS NULL THEN 'country_code_not_found:' || country END,
  CASE WHEN no_revenues THEN 'missing_revenues_template_marks_mandatory' END,
  CASE WHEN stated IS NULL AND proxy IS NOT NULL THEN 'asset_value_uses_capex_proxy_not_true_valuation' END,
  CASE WHEN no_value THEN 'missing_asset_value_capex_proxy_unavailable' END,
  CASE WHEN detention IS NULL THEN 'missing_detention_rate' END)"""
STRICT_WARNINGS = """concat_ws('|', CASE WHEN full_address = '' THEN 'missing_address' END,
  CASE WHEN country_code IS NULL THEN 'country_code_not_found:' || country END,
  CASE WHEN no_revenues THEN 'missing_revenues_template_marks_mandatory' END,
  CASE WHEN no_value THEN 'missing_asset_value' END,
  CASE WHEN detention IS NULL THEN 'missing_detention_rate' END)"""
PLAIN_ERRORS = """concat_ws('|', CASE WHEN known_type IS NULL THEN 'asset_type_not_in_template:' || asset_type END,
  CASE WHEN latitude IS NULL THEN 'missing_latitude' END, CASE WHEN longitude IS NULL THEN 'missing_longitude' END)"""
STRICT_ERRORS = """concat_ws('|', CASE WHEN known_type IS NULL THEN 'asset_type_not_in_template:' || asset_type END,
  CASE WHEN latitude IS NULL THEN 'missing_latitude' END, CASE WHEN longitude IS NULL THEN 'missing_longitude' END,
  CASE WHEN no_revenues THEN 'missing_revenues_strict' END, CASE WHEN no_value THEN 'missing_asset_value' END)"""

plain = exported(40, True, "NULL")
strict = exported(120, False, "'0.5'")


def put(name: str, sql: str) -> None:
    """Registers a statement with the views it needs in front of it."""
    needed: list[str] = []

    def need(body: str) -> None:
        for view, text in VIEWS.items():
            if view not in needed and _mentions(body, view):
                need(text)
                if view not in needed:
                    needed.append(view)

    need(sql)
    head = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in needed)
    ORACLE[name] = (f"WITH {head}\n{sql}" if head else sql).strip()


def _mentions(body: str, view: str) -> bool:
    return re.search(rf"\b(FROM|JOIN)\s+{view}\b", body) is not None


# -- physical and transition results ---------------------------------------------------

put("valid_axes", "SELECT seq, asset_name, scenario, horizon FROM pvalid")
put("indicator_rows", "SELECT * FROM inds")
put("subrisk_rows", "SELECT * FROM subs")
put("physical_trends", "SELECT * FROM ptrends")
put("hazard_rollup", "SELECT * FROM haz")
put(
    "hazard_rating_counts",
    """SELECT asset_name, scenario, horizon, hazard, "rating_A" AS "A", "rating_B" AS "B", "rating_C" AS "C",
    "rating_D" AS "D", "rating_E" AS "E", "rating_F" AS "F", "rating_G" AS "G", least(n, 3)::INTEGER AS shown
    FROM haz JOIN (SELECT asset_name, scenario, horizon, hazard, count(*) AS n FROM pvalid GROUP BY ALL)
    USING (asset_name, scenario, horizon, hazard)""",
)
put(
    "worst_indicators",
    f"""SELECT asset_name, scenario, horizon, hazard, rank, indicator, value, unit, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, horizon, hazard
        ORDER BY {score('rating')} DESC, value DESC NULLS LAST, seq)::INTEGER AS rank
      FROM inds WHERE hazard <> '') WHERE rank <= 3""",
)
put("transition_trends", "SELECT * FROM ttrends")
put("subrisk_peaks", "SELECT * FROM peaks")
put("scenario_rankings", "SELECT * FROM ranks")
put(
    "driver_rankings",
    """SELECT b.asset_name, b.scenario, b.adjusted_revenue_impact AS peak_impact, b.horizon AS peak_year,
      b.subrisk AS peak_subrisk, b.rating AS peak_rating, k.direct_carbon_value AS direct_value,
      k.market_demand_year AS market_year
    FROM (SELECT *, row_number() OVER (PARTITION BY asset_name, scenario
        ORDER BY adjusted_revenue_impact DESC, horizon, indicator, seq) AS r
      FROM subs WHERE subrisk = 'Market_demand_shifts' AND adjusted_revenue_impact IS NOT NULL) b
    LEFT JOIN ranks k ON k.asset_name = b.asset_name AND k.scenario = b.scenario WHERE b.r = 1""",
)
put(
    "best_impact_row",
    """SELECT asset_name, scenario, horizon, indicator, indicator_value, indicator_unit, subrisk,
      adjusted_revenue_impact, rating FROM (
      SELECT *, row_number() OVER (PARTITION BY asset_name, scenario
        ORDER BY adjusted_revenue_impact DESC, horizon, subrisk, indicator, seq) AS r
      FROM subs WHERE adjusted_revenue_impact IS NOT NULL) WHERE r = 1""",
)
put(
    "driver_trend",
    """SELECT asset_name, scenario, horizon, impact,
      CASE WHEN impact IS NOT NULL THEN rating END AS rating,
      CASE WHEN impact IS NOT NULL THEN subrisk END AS driver,
      CASE WHEN impact IS NOT NULL THEN indicator END AS indicator
    FROM (SELECT *, adjusted_revenue_impact AS impact,
        row_number() OVER (PARTITION BY asset_name, scenario, horizon
          ORDER BY adjusted_revenue_impact DESC NULLS LAST, indicator, seq) AS r
      FROM subs WHERE subrisk = 'Direct_carbon_cost') WHERE r = 1""",
)
put(
    "build_meta",
    """SELECT (SELECT count(*) FROM events) AS physical_rows, (SELECT count(*) FROM orders) AS transition_rows,
      '2026-07-01' AS generated_at, 'climateZone,ticcsSubClass' AS physical_missing, 'countryCode' AS transition_missing,
      'events' AS physical_source, 'orders' AS transition_source""",
)

# -- assets and join-back ---------------------------------------------------------------

put("asset_first_seen", "SELECT * FROM firsts")
put(
    "manifest_last_wins",
    """SELECT scr_asset_name, scr_run_id, scr_grain, plant_uuid, plant_slug, portfolio_id, portfolio_asset_id,
      plant_name, asset_type, latitude, longitude FROM mani""",
)
put(
    "join_back",
    """SELECT f.asset_name, f.scr_asset_id, m.plant_uuid, m.portfolio_id, m.asset_type,
      m.scr_asset_name IS NOT NULL AS matched
    FROM firsts f LEFT JOIN mani m ON m.scr_asset_name = f.asset_name""",
)
put(
    "join_back_rows",
    """SELECT p.seq, p."assetName", p.scenario, p.hazard, m.portfolio_id
    FROM phys p LEFT JOIN mani m ON m.scr_asset_name = p."assetName" """,
)
put(
    "join_back_unmatched",
    """SELECT "assetName", count(*) AS row_count FROM phys
    WHERE "assetName" <> '' AND "assetName" NOT IN (SELECT scr_asset_name FROM mani) GROUP BY 1""",
)
put(
    "uuid_mismatches",
    """SELECT DISTINCT p."assetName", m.plant_uuid, regexp_replace(right(p."assetName", 32),
      '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') AS name_uuid
    FROM phys p JOIN mani m ON m.scr_asset_name = p."assetName"
    WHERE replace(m.plant_uuid, '-', '') <> right(p."assetName", 32)""",
)
put(
    "recover_plants",
    """SELECT t."assetName", u AS plant_uuid, NULL::VARCHAR AS generator_uuid, p.slug AS plant_slug,
      p.slug IS NOT NULL AS recovered
    FROM (SELECT DISTINCT "assetName", CASE WHEN "assetName" LIKE 'is_p_%' THEN regexp_replace(
        right("assetName", 32), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\\1-\\2-\\3-\\4-\\5') END AS u FROM trans) t
    LEFT JOIN plants p ON p.id = t.u""",
)
put(
    "portfolio_rows",
    """SELECT t.asset_name, scenario, horizon, portfolio_id, portfolio_asset_id, plant_uuid,
      adjusted_total_value_impact FROM ptrends t JOIN mani m ON m.scr_asset_name = t.asset_name""",
)

# -- slices and options -------------------------------------------------------------------

put(
    "slice_unknown_asset",
    """SELECT asset_name, scenario, horizon, adjusted_total_value_impact FROM ptrends
    WHERE asset_name = (SELECT min(asset_name) FROM firsts)""",
)
put("slice_view", "SELECT * FROM ptrends WHERE scenario = 'ssp5-8.5' AND horizon = 2100")
put("slice_from_files", "SELECT * FROM ptrends WHERE scenario = 'ssp5-8.5' AND horizon = 2100")
put(
    "slice_horizon_range",
    "SELECT seq, asset_name, scenario, horizon, rating FROM inds WHERE horizon BETWEEN 2050 AND 2075",
)
put("rated_indicators", "SELECT seq, rating FROM inds WHERE rating IS NOT NULL")
put(
    "quantified_subrisks",
    """SELECT seq, subrisk, adjusted_revenue_impact FROM subs
    WHERE subrisk = 'Direct_carbon_cost' AND adjusted_revenue_impact IS NOT NULL""",
)
put("scenario_options", "SELECT DISTINCT scenario FROM trans WHERE scenario <> ''")
put("driver_options", "SELECT DISTINCT subrisk FROM subs WHERE subrisk <> ''")
put("horizon_options", "SELECT DISTINCT horizon FROM ptrends")
put(
    "default_physical_slice",
    """SELECT asset_name, coalesce(max(scenario) FILTER (scenario = 'ssp5-8.5'), min(scenario)) AS scenario,
      coalesce(max(horizon) FILTER (horizon = 2100), max(horizon)) AS horizon FROM ptrends GROUP BY 1""",
)
put(
    "default_transition_slice",
    """SELECT asset_name, scenario FROM (SELECT *, row_number() OVER (PARTITION BY asset_name
      ORDER BY (scenario = 'Fragmented World') DESC, peak_impact DESC, scenario) AS r FROM ranks) WHERE r = 1""",
)
put(
    "kept_horizon",
    """SELECT asset_name, CASE WHEN bool_or(horizon = 2050) THEN 2050
      ELSE coalesce(max(horizon) FILTER (horizon = 2100), max(horizon)) END::INTEGER AS horizon
    FROM ptrends GROUP BY 1""",
)

# -- response and series --------------------------------------------------------------------

put(
    "static_hazards",
    """SELECT asset_name, hazard, count(adjusted_hazard_value_impact) AS n_values,
      count(adjusted_hazard_value_impact) > 1
        AND count(DISTINCT printf('%.11e', adjusted_hazard_value_impact)) = 1 AS is_static
    FROM haz GROUP BY ALL""",
)
put(
    "flat_series",
    """SELECT asset_name, scenario, hazard, count(adjusted_hazard_value_impact) AS n_values,
      count(adjusted_hazard_value_impact) < 2
        OR max(adjusted_hazard_value_impact) - min(adjusted_hazard_value_impact) <= 1e-9 AS is_flat
    FROM haz GROUP BY ALL""",
)
POINTS = """(
    SELECT i.asset_name, i.scenario, i.horizon, i.hazard, i.indicator, coalesce(i.unit, '') AS unit, i.value AS x,
      i.rating, i.seq, y.metric, y.y
    FROM inds i JOIN (
      SELECT h.asset_name, h.scenario, h.horizon, h.hazard, c.metric, CASE c.metric
        WHEN 'damage' THEN adjusted_hazard_damage WHEN 'disruption' THEN adjusted_hazard_disruption
        ELSE adjusted_hazard_value_impact END AS y
      FROM haz h JOIN (SELECT asset_name, scenario, hazard, CASE
          WHEN count(adjusted_hazard_damage) > 0 THEN 'damage'
          WHEN count(adjusted_hazard_disruption) > 0 THEN 'disruption'
          WHEN count(adjusted_hazard_value_impact) > 0 THEN 'value_impact' END AS metric
        FROM haz GROUP BY ALL) c
      ON c.asset_name = h.asset_name AND c.scenario = h.scenario AND c.hazard = h.hazard) y
    ON y.asset_name = i.asset_name AND y.scenario = i.scenario AND y.horizon = i.horizon AND y.hazard = i.hazard
    WHERE i.value IS NOT NULL AND y.y IS NOT NULL)"""
put("response_points", f"SELECT * FROM {POINTS}")
put(
    "magnitude_response",
    f"""SELECT p.*, s.n_points, s.distinct_x, s.distinct_y, s.series_rank FROM {POINTS} p JOIN (
      SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, hazard
        ORDER BY distinct_y DESC, distinct_x DESC, indicator, unit)::INTEGER AS series_rank
      FROM (SELECT asset_name, scenario, hazard, indicator, unit, count(*) AS n_points,
          count(DISTINCT printf('%.11e', x)) AS distinct_x, count(DISTINCT printf('%.11e', y)) AS distinct_y
        FROM {POINTS} GROUP BY ALL) WHERE n_points >= 3 AND distinct_x > 1) s
    ON s.asset_name = p.asset_name AND s.scenario = p.scenario AND s.hazard = p.hazard
      AND s.indicator = p.indicator AND s.unit = p.unit WHERE s.series_rank <= 2""",
)
put(
    "hazard_curves_long",
    """SELECT u.asset_name, u.scenario, u.horizon, u.hazard, u.metric, u.value, f.is_flat FROM (
      SELECT asset_name, scenario, horizon, hazard, metric, value FROM haz UNPIVOT INCLUDE NULLS (value FOR metric IN (
        adjusted_hazard_damage, adjusted_hazard_disruption, adjusted_hazard_disruption_damage_equivalent,
        adjusted_hazard_value_impact))) u
    JOIN (SELECT asset_name, scenario, hazard, metric,
        count(value) < 2 OR max(value) - min(value) <= 1e-9 AS is_flat
      FROM (SELECT * FROM haz UNPIVOT (value FOR metric IN (
        adjusted_hazard_damage, adjusted_hazard_disruption, adjusted_hazard_disruption_damage_equivalent,
        adjusted_hazard_value_impact))) GROUP BY ALL) f
    ON f.asset_name = u.asset_name AND f.scenario = u.scenario AND f.hazard = u.hazard AND f.metric = u.metric
    WHERE u.value IS NOT NULL""",
)
CHANGE = """CASE WHEN {v} <> 0 AND {b} <> 0 THEN round(({v} / {b} - 1) * 100, 1) END"""
put(
    "change_from_first",
    f"""SELECT asset_name, scenario, horizon, v AS adjusted_total_value_impact, {CHANGE.format(v='v', b='b')} AS change_pct
    FROM (SELECT *, adjusted_total_value_impact AS v, first_value(adjusted_total_value_impact) OVER (
      PARTITION BY asset_name, scenario ORDER BY horizon) AS b FROM ptrends)""",
)
put(
    "horizon_delta",
    """SELECT asset_name, scenario, horizon, delta,
      delta - lag(delta) OVER (PARTITION BY asset_name, scenario ORDER BY horizon) AS acceleration
    FROM (SELECT *, adjusted_total_value_impact - lag(adjusted_total_value_impact) OVER (
      PARTITION BY asset_name, scenario ORDER BY horizon) AS delta FROM ptrends)""",
)
BAR = """CASE WHEN max(coalesce({v}, 0)) OVER ({w}) > 0
      THEN coalesce({v}, 0) / max(coalesce({v}, 0)) OVER ({w}) ELSE 0 END"""
put(
    "bar_share",
    f"""SELECT asset_name, scenario, horizon, hazard,
      {BAR.format(v='adjusted_hazard_value_impact', w='PARTITION BY asset_name, scenario, horizon')} AS bar_share
    FROM haz""",
)
put(
    "scaled_series",
    """SELECT asset_name, scenario, horizon, CASE WHEN hi > lo THEN floor((v - lo) / (hi - lo) * 7)
      WHEN v IS NOT NULL THEN 0 END::INTEGER AS level
    FROM (SELECT *, adjusted_total_value_impact AS v,
      min(adjusted_total_value_impact) OVER (PARTITION BY asset_name, scenario) AS lo,
      max(adjusted_total_value_impact) OVER (PARTITION BY asset_name, scenario) AS hi FROM ptrends)""",
)
put(
    "trend_summary",
    f"""SELECT *, {CHANGE.format(v='last_value', b='first_value')} AS change_pct FROM (
      SELECT asset_name, scenario, min(v) AS min_value, max(v) AS max_value,
        min(horizon) FILTER (v = hi)::INTEGER AS peak_horizon, min(horizon) AS first_horizon,
        max(horizon) AS last_horizon, max(v) FILTER (horizon = h0) AS first_value,
        max(v) FILTER (horizon = h1) AS last_value
      FROM (SELECT *, adjusted_total_value_impact AS v,
        max(adjusted_total_value_impact) OVER (PARTITION BY asset_name, scenario) AS hi,
        min(horizon) OVER (PARTITION BY asset_name, scenario) AS h0,
        max(horizon) OVER (PARTITION BY asset_name, scenario) AS h1 FROM ptrends) GROUP BY ALL)""",
)

# -- quality ------------------------------------------------------------------------------------

put(
    "grain_violations",
    """SELECT "assetName", scenario, "timeHorizon", indicator, hazard, count(*) AS n FROM phys
    GROUP BY ALL HAVING count(*) > 1""",
)
put(
    "repeat_inconsistency",
    """SELECT * FROM (SELECT "assetName", scenario, "timeHorizon", concat_ws('|',
      CASE WHEN count(DISTINCT "adjustedSubriskRevenueImpact") > 1 THEN 'adjustedSubriskRevenueImpact' END,
      CASE WHEN count(DISTINCT "countryCode") > 1 THEN 'countryCode' END,
      CASE WHEN count(DISTINCT "climateZone") > 1 THEN 'climateZone' END) AS inconsistent
    FROM trans GROUP BY ALL) WHERE inconsistent <> ''""",
)
put(
    "value_identity",
    """SELECT * FROM (SELECT seq, "assetName", hazard, "adjustedHazardValueImpact"
      - ("adjustedHazardDamage" + "adjustedHazardDisruptionDamageEquivalent") AS difference FROM phys)
    WHERE abs(difference) > 1e-9""",
)
put(
    "id_drift",
    """SELECT "assetName", count(DISTINCT "assetId") AS n_ids FROM hist WHERE "assetName" <> ''
    GROUP BY 1 HAVING count(DISTINCT "assetId") > 1""",
)
put(
    "coordinate_grain",
    """SELECT * FROM (SELECT "assetName", count(*) AS n_rows,
      count(DISTINCT CASE WHEN seq % 40 <> 0 THEN lon END) AS n_pairs,
      count(*) FILTER (seq % 40 = 0) AS n_missing
    FROM (SELECT *, CASE WHEN seq % 3 = 0 THEN 2.5 ELSE length("assetId") END AS lon FROM phys) GROUP BY 1)
    WHERE n_pairs > 1 OR (n_missing > 0 AND n_missing < n_rows)""",
)
put(
    "vocabulary_status",
    """SELECT hazard AS term, count(*) AS row_count, CASE WHEN lower(hazard) IN (SELECT lower(term) FROM vocab)
      THEN 'mapped' ELSE 'missing' END AS metadata_mapping_status FROM phys WHERE hazard <> '' GROUP BY 1""",
)
put(
    "vocabulary_unused",
    "SELECT term FROM vocab WHERE lower(term) NOT IN (SELECT lower(hazard) FROM phys)",
)
put(
    "scenario_category",
    """SELECT seq, upper(scenario) AS scenario, CASE WHEN scenario IN ('Net Zero 2050', 'Below 2C') THEN 'Orderly'
      WHEN scenario = 'Delayed Transition' THEN 'Disorderly'
      WHEN scenario IN ('NDCs', 'Current Policies') THEN 'Hot House World' END AS scenario_category,
      CASE WHEN scenario <> 'Low Demand' THEN 'SSP2-4.5' END AS physical_scenario FROM trans""",
)
put(
    "driver_labels",
    """SELECT seq, subrisk, CASE subrisk WHEN 'Direct_carbon_cost' THEN 'Direct carbon cost'
      WHEN 'Market_demand_shifts' THEN 'Market demand shifts' ELSE 'n/a' END AS label FROM subs""",
)
put(
    "display_labels",
    """SELECT seq, hazard, CASE WHEN hazard = '' THEN 'n/a' WHEN upper(hazard) IN (SELECT term FROM vocab)
      THEN 'Hazard: ' || hazard ELSE hazard END AS label FROM phys""",
)
put(
    "coverage",
    """SELECT family, populated, cells, populated / cells AS share FROM (
      SELECT 'totals' AS family, count("adjustedTotalDamage") + count("adjustedTotalDisruption")
        + count("adjustedTotalValueImpact") AS populated, count(*) * 3 AS cells FROM phys
      UNION ALL SELECT 'hazard', count("adjustedHazardDamage") + count("adjustedHazardValueImpact"), count(*) * 2
        FROM phys
      UNION ALL SELECT 'ratings', count(nullif("hazardExposureRating", ''))
        + count(nullif("adjustedHazardExposureRating", '')) + count(nullif("HazardRating", '')), count(*) * 3
        FROM phys
      UNION ALL SELECT 'indicator', count("indicatorValue") + count(nullif("indicatorUnit", ''))
        + count(nullif("indicatorRating", '')), count(*) * 3 FROM phys
      UNION ALL SELECT 'absent', 0, count(*) FROM phys)""",
)
put(
    "rating_distribution",
    """SELECT scenario, coalesce(nullif("indicatorRating", ''), 'NA') AS rating, count(*) AS n
    FROM phys GROUP BY ALL""",
)
put("row_mix", "SELECT hazard, count(*) AS n FROM phys WHERE hazard <> '' GROUP BY 1")
put(
    "row_matrix",
    "SELECT scenario, "
    + ", ".join(
        f"""count(*) FILTER ("timeHorizon" = '{h}') AS "h_{h}" """
        for h in ("Historical", "2025", "2050", "2075", "2100")
    )
    + " FROM phys GROUP BY 1",
)
put(
    "subrisk_matrix",
    """SELECT scenario, max(value) FILTER (subrisk = 'Direct_carbon_cost') AS "Direct_carbon_cost",
      max(value) FILTER (subrisk = 'Market_demand_shifts') AS "Market_demand_shifts" FROM peaks GROUP BY 1""",
)
DIFFERENCES = """(
    SELECT f.*, coalesce(abs(split_part(trim(coordinates, '()'), ',', 1)::DOUBLE - m.latitude::DOUBLE) > 1e-6, true)
      OR coalesce(abs(split_part(trim(coordinates, '()'), ',', 2)::DOUBLE - m.longitude::DOUBLE) > 1e-6, true)
      AS coordinates_differ
    FROM firsts f JOIN mani m ON m.scr_asset_name = f.asset_name)"""
put(
    "manifest_differences",
    f"""SELECT * FROM (SELECT asset_name, coordinates_differ, country_code <> 'USA' AS country_differs,
      NOT starts_with(ticcs_sub_class, CASE WHEN n % 4 = 0 THEN 'IC1010' ELSE 'IC2010' END) AS class_differs
    FROM {DIFFERENCES} JOIN (SELECT DISTINCT n, 'is_p_' || md5(n::VARCHAR) AS asset_name FROM mani_all)
    USING (asset_name)) WHERE coordinates_differ OR country_differs OR class_differs""",
)
put(
    "import_summary",
    """SELECT import_id, source_file, max(m.scr_run_id) AS scr_run_id, count(*) AS row_count,
      count(DISTINCT nullif("assetName", '')) AS asset_count, count(DISTINCT m.scr_asset_name) AS matched_asset_count,
      count(DISTINCT CASE WHEN m.scr_asset_name IS NULL THEN nullif("assetName", '') END) AS unmatched_asset_count
    FROM hist LEFT JOIN mani m ON m.scr_asset_name = "assetName" GROUP BY ALL""",
)
put(
    "latest_import",
    """SELECT seq, "assetName", import_id, imported_at FROM (SELECT *, dense_rank() OVER (PARTITION BY "assetName"
      ORDER BY imported_at DESC, import_id DESC) AS r FROM hist) WHERE r = 1""",
)
put(
    "import_failures",
    """SELECT 'physical_2' AS source_file, 'unreadable_file' AS code, 'no sheet Output' AS detail
    UNION ALL SELECT 'physical_1', 'kind_unknown', 'assetName|scenario'
    UNION ALL SELECT * FROM (SELECT DISTINCT source_file, CASE WHEN "assetName" = '' THEN 'missing_asset_name'
        WHEN m.scr_asset_name IS NULL THEN 'asset_not_in_manifest'
        WHEN replace(m.plant_uuid, '-', '') <> right("assetName", 32) THEN 'uuid_differs_from_manifest' END AS code,
        "assetName" FROM phys LEFT JOIN mani m ON m.scr_asset_name = "assetName") WHERE code IS NOT NULL""",
)
put(
    "import_warnings",
    f"""SELECT 'hazard_not_in_metadata' AS code, hazard AS detail, count(*) AS n FROM phys
      WHERE hazard <> '' AND lower(hazard) NOT IN (SELECT lower(term) FROM vocab) GROUP BY hazard
    UNION ALL SELECT 'hazard_not_returned', term, 1 FROM vocab WHERE lower(term) NOT IN (SELECT lower(hazard) FROM phys)
    UNION ALL SELECT 'metrics_blank', source_file, count(*) FROM phys WHERE "assetName" <> ''
      AND "indicatorValue" IS NULL AND "adjustedHazardValueImpact" IS NULL AND "adjustedTotalValueImpact" IS NULL
      GROUP BY source_file
    UNION ALL SELECT 'metric_column_missing', 'totalDamage', 1
    UNION ALL SELECT 'asset_id_changed', "assetName", count(DISTINCT "assetId") FROM hist WHERE "assetName" <> ''
      GROUP BY "assetName" HAVING count(DISTINCT "assetId") > 1
    UNION ALL SELECT 'coordinates_differ', asset_name, 1 FROM {DIFFERENCES} WHERE coordinates_differ""",
)
put(
    "output_kind",
    """SELECT source_file, CASE seq % 3 WHEN 0 THEN 'physical' WHEN 1 THEN 'transition' END AS kind, count(*) AS n
    FROM phys GROUP BY ALL""",
)

# -- portfolio ------------------------------------------------------------------------------------

VALID = "CASE WHEN {s} > 0 THEN {s} END"
put(
    "portfolio_rating",
    f"""SELECT portfolio_id, scenario, horizon, {letter('round(sum(v) / count(v), 0)')} AS portfolio_rating,
      count(v) AS rated, count(*) FILTER (v IS NULL) AS unrated,
      {', '.join(f'count(*) FILTER (v = {i}) AS "rating_{x}"' for i, x in enumerate('ABCDEFG', 1))}
    FROM (SELECT *, {VALID.format(s=score('adjusted_physical_exposure_rating'))} AS v
      FROM ptrends JOIN mani ON scr_asset_name = asset_name) GROUP BY ALL""",
)
PVIEW = """(SELECT t.*, m.portfolio_id, f.ticcs_sub_class FROM ptrends t JOIN mani m ON m.scr_asset_name = t.asset_name
    LEFT JOIN firsts f ON f.asset_name = t.asset_name WHERE scenario = 'ssp2-4.5' AND horizon = 2050)"""
put(
    "portfolio_rollup",
    f"""SELECT portfolio_id, ticcs_sub_class, grouping(portfolio_id, ticcs_sub_class)::BIGINT AS level,
      count(*) AS n_assets, {letter('max(' + score('adjusted_physical_exposure_rating') + ')')} AS worst_rating,
      max(adjusted_total_value_impact) AS max_value
    FROM {PVIEW} GROUP BY ROLLUP (portfolio_id, ticcs_sub_class)""",
)
put(
    "portfolio_top_assets",
    f"""SELECT * FROM (SELECT portfolio_id, row_number() OVER (PARTITION BY portfolio_id
      ORDER BY {score('adjusted_physical_exposure_rating')} DESC, adjusted_total_value_impact DESC NULLS LAST,
      asset_name)::INTEGER AS position, asset_name, adjusted_total_value_impact FROM {PVIEW}) WHERE position <= 2""",
)
put(
    "portfolio_top_hazards",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY portfolio_id
      ORDER BY max_value DESC NULLS LAST, hazard)::INTEGER AS position FROM (
      SELECT portfolio_id, hazard, max(adjusted_hazard_value_impact) AS max_value,
        count(DISTINCT asset_name) AS n_assets FROM haz JOIN mani ON scr_asset_name = asset_name GROUP BY ALL))
    WHERE position <= 3""",
)
put(
    "portfolio_scenarios",
    """SELECT portfolio_id, horizon, max(adjusted_total_value_impact) FILTER (scenario = 'ssp2-4.5') AS "ssp2-4.5",
      max(adjusted_total_value_impact) FILTER (scenario = 'ssp5-8.5') AS "ssp5-8.5"
    FROM ptrends JOIN mani ON scr_asset_name = asset_name GROUP BY ALL""",
)

# -- reports ------------------------------------------------------------------------------------------

HAZARD_RANK = f"""row_number() OVER (PARTITION BY asset_name, scenario, horizon ORDER BY
      coalesce(adjusted_hazard_value_impact, 0) DESC, {score('hazard_rating')} DESC, hazard)::INTEGER"""
KPIS = f"""(
    SELECT f.asset_name, coalesce(nullif(scr_asset_id, ''), f.asset_name) AS asset_label,
      coalesce(nullif(ticcs_sub_class_name, ''), nullif(ticcs_sub_class, ''), '') AS sector, coordinates,
      v.scenario, v.horizon, t.adjusted_physical_exposure_rating AS physical_rating,
      t.adjusted_total_value_impact AS impact, @change AS change_pct, h.hazard AS top_hazard,
      a.scenario AS top_scenario,
      a.peak_impact AS top_peak, a.peak_year AS top_peak_year, b.scenario AS selected_scenario,
      b.peak_impact AS selected_peak, b.peak_year AS selected_peak_year, b.peak_subrisk AS selected_driver
    FROM firsts f
    LEFT JOIN (SELECT asset_name, coalesce(max(scenario) FILTER (scenario = '@scenario'),
        max(scenario) FILTER (scenario = 'ssp5-8.5'), min(scenario)) AS scenario,
        coalesce(max(horizon) FILTER (horizon = @horizon), max(horizon) FILTER (horizon = 2100), max(horizon))
        AS horizon FROM ptrends GROUP BY 1) v ON v.asset_name = f.asset_name
    LEFT JOIN (SELECT *, first_value(adjusted_total_value_impact) OVER (
      PARTITION BY asset_name, scenario ORDER BY horizon) AS b FROM ptrends) t
      ON t.asset_name = v.asset_name AND t.scenario = v.scenario AND t.horizon = v.horizon
    LEFT JOIN (SELECT *, {HAZARD_RANK} AS r FROM haz) h
      ON h.asset_name = v.asset_name AND h.scenario = v.scenario AND h.horizon = v.horizon AND h.r = 1
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY peak_impact DESC, scenario) AS r
      FROM ranks) a ON a.asset_name = f.asset_name AND a.r = 1
    LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY asset_name ORDER BY scenario = 'Net Zero 2050' DESC,
      peak_impact DESC, scenario) AS r FROM ranks) b ON b.asset_name = f.asset_name AND b.r = 1)""".replace(
    "@change", CHANGE.format(v="t.adjusted_total_value_impact", b="t.b")
)
put("asset_kpis", "SELECT * FROM " + KPIS.replace("@scenario", "ssp5-8.5").replace("@horizon", "2100"))
put(
    "physical_trend_series",
    """SELECT asset_name, scenario, horizon, adjusted_total_disruption AS raw_value,
      adjusted_total_disruption * 10000 AS display_value,
      CASE WHEN adjusted_total_disruption IS NULL THEN 'not quantified'
        ELSE printf('%.2f bps', adjusted_total_disruption * 10000) END AS label,
      adjusted_physical_exposure_rating AS rating FROM ptrends""",
)


def band(c: str) -> str:
    s = score(c)
    return f"""CASE WHEN {s} = 0 THEN 'No rating' WHEN {s} <= 2 THEN 'Lower exposure'
      WHEN {s} <= 4 THEN 'Moderate exposure' ELSE 'Higher exposure' END"""


def tone(c: str) -> str:
    return f"CASE WHEN {score(c)} >= 5 THEN 'high' WHEN {score(c)} >= 3 THEN 'mid' ELSE 'low' END"


def number_text(c: str) -> str:
    return f"""CASE WHEN {c} IS NULL THEN 'n/a' WHEN abs({c}) > 0 AND abs({c}) < 0.01 THEN printf('%.9f', {c})
      ELSE rtrim(rtrim(printf('%.3f', {c}), '0'), '.') END"""


def magnitude(value: str, unit: str) -> str:
    return f"""CASE WHEN {value} IS NULL THEN 'rating only' ELSE {number_text(value)}
      || CASE WHEN coalesce({unit}, '') = '' THEN '' ELSE ' ' || {unit} END END"""


def peak_text(value: str, year: str) -> str:
    return f"CASE WHEN {value} IS NULL THEN 'n/a' ELSE {number_text(value)} || ' @ ' || {year} END"


put(
    "hazard_ranking",
    f"""SELECT h.asset_name, scenario, horizon, h.hazard, {HAZARD_RANK.replace('asset_name', 'h.asset_name', 1).replace(', hazard)', ', h.hazard)')} AS position,
      hazard_rating, {band('hazard_rating')} AS band,
      {BAR.format(v='adjusted_hazard_value_impact', w='PARTITION BY h.asset_name, scenario, horizon')} AS bar_share,
      s.is_static, CASE WHEN adjusted_hazard_value_impact IS NULL THEN 'not quantified'
        ELSE printf('%.4f%%', adjusted_hazard_value_impact * 100) END AS label
    FROM haz h JOIN (SELECT asset_name, hazard, count(adjusted_hazard_value_impact) > 1
      AND count(DISTINCT adjusted_hazard_value_impact) = 1 AS is_static FROM haz GROUP BY ALL) s
    ON s.asset_name = h.asset_name AND s.hazard = h.hazard""",
)
put(
    "top_indicators",
    f"""SELECT *, {band('rating')} AS band, {tone('rating')} AS tone, {magnitude('value', 'unit')} AS magnitude FROM (
      SELECT * EXCLUDE (seq), row_number() OVER (PARTITION BY asset_name, scenario, horizon
        ORDER BY {score('rating')} DESC, hazard, indicator, seq)::INTEGER AS position
      FROM inds WHERE rating IS NOT NULL) WHERE position <= 18""",
)
put(
    "transition_ranking",
    f"""SELECT asset_name, row_number() OVER (PARTITION BY asset_name ORDER BY peak_impact DESC, scenario)::INTEGER
        AS position, scenario, peak_impact, peak_year, peak_subrisk,
      CASE peak_subrisk WHEN 'Direct_carbon_cost' THEN 'Direct carbon cost' ELSE 'Market demand shifts' END
        AS driver_label,
      {BAR.format(v='peak_impact', w='PARTITION BY asset_name')} AS bar_share,
      {peak_text('direct_carbon_value', 'direct_carbon_year')} AS direct_label,
      {peak_text('market_demand_value', 'market_demand_year')} AS market_label FROM ranks""",
)
put(
    "top_subrisks",
    """SELECT * FROM (SELECT * EXCLUDE (seq), row_number() OVER (PARTITION BY asset_name, scenario
        ORDER BY adjusted_revenue_impact DESC, horizon, subrisk, indicator, seq)::INTEGER AS position
      FROM subs WHERE adjusted_revenue_impact IS NOT NULL) WHERE position <= 18""",
)
put(
    "interpretation",
    f"""SELECT k.asset_name, k.change_pct,
      coalesce(k.scenario, '-') || ' at ' || coalesce(k.horizon::VARCHAR, '-') || ': rating '
        || coalesce(physical_rating, '-') || ', impact ' || CASE WHEN impact IS NULL THEN 'not quantified'
          ELSE printf('%.4f%% (raw %.9f)', impact * 100, impact) END
        || coalesce(', a ' || printf('%.1f', k.change_pct) || '% move from the first horizon', '') || '.'
        || coalesce(' The top quantified hazard is ' || top_hazard || '.', '') AS physical_text,
      'Highest peak: ' || coalesce(top_scenario, '-') || ' with ' || {number_text('top_peak')} || '. Selected: '
        || coalesce(selected_scenario, '-') || ', led by ' || CASE selected_driver
          WHEN 'Direct_carbon_cost' THEN 'Direct carbon cost' WHEN 'Market_demand_shifts' THEN 'Market demand shifts'
          ELSE 'n/a' END || ' at ' || coalesce(selected_peak_year::VARCHAR, '-') || '.' AS transition_text
    FROM {KPIS.replace('@scenario', 'ssp2-4.5').replace('@horizon', '2075')} k""",
)
put(
    "physical_summary",
    f"""SELECT t.asset_name, t.scenario, t.horizon, adjusted_physical_exposure_rating AS rating,
      adjusted_total_value_impact AS value_impact, h.names AS top_hazards, i.names AS top_indicators
    FROM ptrends t
    LEFT JOIN (SELECT asset_name, scenario, horizon, string_agg(hazard, '|' ORDER BY r) AS names
      FROM (SELECT *, {HAZARD_RANK} AS r FROM haz) WHERE r <= 3 GROUP BY ALL) h
    ON h.asset_name = t.asset_name AND h.scenario = t.scenario AND h.horizon = t.horizon
    LEFT JOIN (SELECT asset_name, scenario, horizon, string_agg(indicator, '|' ORDER BY r) AS names
      FROM (SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, horizon
        ORDER BY {score('rating')} DESC, hazard, indicator, seq) AS r FROM inds WHERE rating IS NOT NULL)
      WHERE r <= 3 GROUP BY ALL) i
    ON i.asset_name = t.asset_name AND i.scenario = t.scenario AND i.horizon = t.horizon""",
)
put(
    "transition_summary",
    """SELECT t.*, b.indicator FROM ttrends t LEFT JOIN (
      SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, horizon
        ORDER BY adjusted_revenue_impact DESC, subrisk, indicator, seq) AS r
      FROM subs WHERE adjusted_revenue_impact IS NOT NULL) b
    ON b.asset_name = t.asset_name AND b.scenario = t.scenario AND b.horizon = t.horizon AND b.r = 1""",
)
put(
    "driver_split",
    """SELECT asset_name, scenario, direct_carbon_value, market_demand_value, CASE
      WHEN coalesce(direct_carbon_value, -1) > coalesce(market_demand_value, -1) THEN 'Direct_carbon_cost'
      WHEN coalesce(market_demand_value, -1) > coalesce(direct_carbon_value, -1) THEN 'Market_demand_shifts'
      WHEN direct_carbon_value IS NOT NULL THEN 'equal' END AS leading_driver FROM ranks""",
)
put(
    "scenario_compare",
    """SELECT asset_name, horizon, max(adjusted_total_value_impact) FILTER (scenario = 'ssp2-4.5') AS "ssp2-4.5",
      max(adjusted_total_value_impact) FILTER (scenario = 'ssp5-8.5') AS "ssp5-8.5" FROM ptrends GROUP BY ALL""",
)

# -- registry and export --------------------------------------------------------------------------------


def scope_text(source: str, first: str = "*") -> str:
    return f"""SELECT {first}, plant_uuid, eia_plant_id, plant_slug, source_type, plant_name, operating_entity_name,
      state, county, city, postal_code, address_raw, {dec('latitude')} AS latitude, {dec('longitude')} AS longitude,
      primary_fuel, array_to_string(fuels, '|') AS fuel_types, technologies,
      {dec('total_capacity_mw')} AS total_capacity_mw, {dec('latest_capex_per_kw')} AS latest_capex_per_kw
    FROM {source}"""


SCOPE = "workspace_id, workspace_slug, portfolio_id, portfolio_name, portfolio_kind, portfolio_asset_id, workspace_asset_state"
put(
    "scope_reference",
    scope_text("rec WHERE home IS NULL", ", ".join(f"NULL::VARCHAR AS {c}" for c in SCOPE.split(", "))),
)
put("scope_portfolio", scope_text("scope", SCOPE))
put("scope_workspace", scope_text("wscope", SCOPE))
put(
    "scope_workspace_portfolio",
    """SELECT plant_uuid, workspace_slug, portfolio_id, portfolio_asset_id FROM wscope
    WHERE workspace_id = 'ws_1' AND workspace_asset_state = 'portfolio'""",
)
put(
    "scope_plants",
    f"""SELECT r.plant_uuid, w.id AS workspace_id, w.slug AS workspace_slug, wa.state AS workspace_asset_state,
      f.id AS portfolio_id, pa.id AS portfolio_asset_id
    FROM rec r LEFT JOIN ws w ON w.id = r.home
    LEFT JOIN wsa wa ON wa.workspace_id = w.id AND wa.plant_uuid = r.plant_uuid
    LEFT JOIN pfa pa ON pa.plant_uuid = r.plant_uuid LEFT JOIN pf f ON f.id = pa.portfolio_id
    WHERE r.plant_uuid IN (SELECT {uuid('o_custkey')} FROM orders)""",
)
put("live_portfolios", "SELECT id, name, created_at FROM pf WHERE workspace_id = 'ws_2'")
put(
    "sidecar_priority",
    """SELECT plant_uuid, portfolio_asset_id,
      CASE WHEN s0.k IS NOT NULL THEN s0.asset_value WHEN s1.k IS NOT NULL THEN s1.asset_value
        WHEN s2.k IS NOT NULL THEN s2.asset_value ELSE s3.asset_value END AS side_value,
      CASE WHEN s0.k IS NOT NULL THEN s0.revenues WHEN s1.k IS NOT NULL THEN s1.revenues
        WHEN s2.k IS NOT NULL THEN s2.revenues ELSE s3.revenues END AS side_revenues,
      CASE WHEN s0.k IS NOT NULL THEN s0.eia_plant_id WHEN s1.k IS NOT NULL THEN s1.eia_plant_id
        WHEN s2.k IS NOT NULL THEN s2.eia_plant_id ELSE s3.eia_plant_id END AS side_eia
    FROM wscope a LEFT JOIN sidx s0 ON s0.k = plant_uuid
    LEFT JOIN sidx s1 ON s1.k = 'is_p_' || replace(plant_uuid, '-', '')
    LEFT JOIN sidx s2 ON s2.k = portfolio_asset_id LEFT JOIN sidx s3 ON s3.k = a.eia_plant_id::VARCHAR""",
)
PASSED = """scope_1 scope_2 decarbonisation_scope_1 decarbonisation_scope_2 flood_blue_green_infrastructure
flood_drainage_system_upgrades flood_elevation flood_erosion_control flood_barriers flood_pumps
flood_reservoir_capacity_expansion flood_sea_walls flood_spillway_enhancement flood_structural_improvements
flood_undergrounding storm_vegetation_management storm_structural_improvements storm_undergrounding
storm_wind_breaks_structural storm_wind_breaks_terrain_landscaping storm_wind_breaks_vegetation
heat_blue_green_infrastructure heat_cooling_systems_mechanical heat_cooling_systems_natural_evaporative
heat_reflective_coatings heat_resistant_construction_materials heat_insulation heat_optimise_operational_practices
heat_shading_greening heat_shading_shade_structures heat_undergrounding wildfire_defensible_space_management
wildfire_erosion_sediment_control wildfire_fire_retardants wildfire_fire_suppression_systems wildfire_firebreaks
wildfire_fireproof_building_materials wildfire_fuel_reduction_zones wildfire_prescribed_burns
wildfire_structural_hardening wildfire_undergrounding wildfire_vegetation_management_landscaping""".split()
put(
    "manifest_rows",
    f"""SELECT 'run_check' AS scr_run_id, '2026-07-01T00:00:00+00:00' AS generated_at, scr_asset_name,
      'plant' AS scr_grain, plant_uuid, '' AS generator_uuid, plant_slug,
      coalesce(nullif(eia_plant_id, 0)::VARCHAR, '') AS eia_plant_id, '' AS eia_generator_code, workspace_id,
      workspace_slug, portfolio_id, portfolio_name, portfolio_asset_id,
      coalesce(workspace_asset_state, '') AS workspace_asset_state, source_type,
      coalesce(plant_name, '') AS plant_name, asset_type, full_address AS address, address_source,
      {dec('latitude')} AS latitude, {dec('longitude')} AS longitude, {dec('detention')} AS detention_rate,
      {dec('revenues')} AS revenues, CASE WHEN no_revenues THEN 'missing' ELSE 'sidecar' END AS revenue_source,
      CASE WHEN stated IS NOT NULL THEN {dec('stated')} ELSE {dec('proxy')} END AS asset_value,
      CASE WHEN stated IS NOT NULL THEN 'sidecar' WHEN proxy IS NOT NULL
        THEN 'capex_proxy_latest_capex_per_kw_times_mw_times_1000' ELSE 'missing' END AS asset_value_source,
      valuation_year, coalesce(primary_fuel, '') AS primary_fuel, array_to_string(fuels, '|') AS fuel_types,
      technologies, {dec('total_capacity_mw')} AS total_capacity_mw,
      {dec('latest_capex_per_kw')} AS latest_capex_per_kw,
      CASE WHEN {PLAIN_ERRORS} = '' THEN 'accepted' ELSE 'rejected' END AS validation_status,
      {PLAIN_ERRORS} AS validation_errors, {PLAIN_WARNINGS} AS validation_warnings FROM {plain}""",
)
put(
    "upload_values",
    f"""SELECT scr_asset_name AS asset_name, asset_type, ticcs_class, ticcs_class_name, nace_code, sector,
      coalesce(nullif(side_operating_entity_name, ''), operating_entity_name, '') AS operating_entity_name,
      {dec('detention')} AS detention_rate, country, coalesce(country_code, '') AS country_code,
      full_address AS address, {dec('latitude')} AS latitude, {dec('longitude')} AS longitude,
      {dec('revenues')} AS revenues, {dec('stated')} AS asset_value, valuation_year AS year,
      {', '.join(f"coalesce(side_{c}, '') AS {c}" if c in ('scope_1', 'flood_barriers') else f"'' AS {c}" for c in PASSED)}
    FROM {strict} WHERE {STRICT_ERRORS} = ''""",
)
put(
    "export_validation",
    f"SELECT portfolio_asset_id, plant_uuid, {STRICT_ERRORS} AS errors, {STRICT_WARNINGS} AS warnings FROM {strict}",
)
put("rejects", f"SELECT portfolio_asset_id, plant_uuid FROM {plain} WHERE {PLAIN_ERRORS} <> ''")
put(
    "warning_counts",
    f"""SELECT message, count(*) AS n FROM (SELECT unnest(string_split({PLAIN_WARNINGS}, '|')) AS message
    FROM {plain}) WHERE message <> '' GROUP BY 1""",
)
put(
    "error_counts",
    f"""SELECT message, count(*) AS n FROM (SELECT unnest(string_split({STRICT_ERRORS}, '|')) AS message
    FROM {strict}) WHERE message <> '' GROUP BY 1""",
)
put(
    "run_summary",
    f"""SELECT *, CASE WHEN rejected_rows > 0 THEN 'completed with rejects' ELSE 'completed' END AS status,
      CASE WHEN rejected_rows > 0 THEN 2 ELSE 0 END AS exit_code FROM (
      SELECT count(*) AS selected_rows, count(*) FILTER (e = '') AS accepted_rows,
        count(*) FILTER (e <> '') AS rejected_rows, count(*) FILTER (w <> '') AS rows_with_warnings
      FROM (SELECT {STRICT_ERRORS} AS e, {STRICT_WARNINGS} AS w FROM {strict}))""",
)
put(
    "preupload_check",
    f"""SELECT unnest(['rejected_rows_is_zero', 'operating_entity_is_off', 'no_warnings_to_review',
        'has_accepted_rows']) AS rule, unnest([r = 0, true, w = 0, a > 0]) AS passed, unnest([r, 0, w, a]) AS n
    FROM (SELECT count(*) FILTER (e = '') AS a, count(*) FILTER (e <> '') AS r, count(*) FILTER (w <> '') AS w
      FROM (SELECT {PLAIN_ERRORS} AS e, {PLAIN_WARNINGS} AS w FROM {plain}))""",
)
put(
    "upload_batches",
    f"""SELECT portfolio_asset_id, scr_asset_name, row_number, ((row_number - 1) // 1001)::INTEGER AS batch_id FROM (
      SELECT *, row_number() OVER (ORDER BY workspace_slug, portfolio_name, plant_slug, plant_uuid,
        portfolio_asset_id) AS row_number FROM {plain} WHERE {PLAIN_ERRORS} = '')""",
)

# -- functions -----------------------------------------------------------------------------------------------

put("infer_asset_type", f"SELECT plant_uuid, inferred AS asset_type FROM {typed('rec')} WHERE home IS NULL")
put(
    "compose_address",
    f"""SELECT plant_uuid, {address('given')} AS address, {address_source('given')} AS source FROM (
      SELECT *, CASE WHEN eia_plant_id % 50 = 1 THEN 'Given Street 1' ELSE '' END AS given FROM rec
      WHERE home IS NULL)""",
)
put(
    "capex_proxy",
    f"""SELECT plant_uuid, {dec('p')} AS asset_value FROM (SELECT *,
      (total_capacity_mw::DECIMAL(19, 6) * latest_capex_per_kw::DECIMAL(19, 6))::DECIMAL(30, 8) * 1000::DECIMAL(4, 0) AS p FROM rec
      WHERE home IS NULL)""",
)
put(
    "asset_names",
    """SELECT id, slug || '__is_p_' || replace(id, '-', '') AS long_name,
      'is_p_' || replace(id, '-', '') AS short_name, id AS recovered FROM plants""",
)
put(
    "normalized_keys",
    """SELECT p_partkey, replace(replace(p_name, ' ', '_') || '_' || lower(replace(p_brand, '#', '_')), ' ', '_') AS key,
      replace(p_name || '-' || lower(replace(p_brand, '#', '-')), ' ', '-') AS slug,
      array_to_string([upper(w[1]) || w[2:] FOR w IN string_split(p_name, ' ')], '_')
        || '_(' || p_brand || ')_' AS file_name FROM part""",
)
put(
    "number_parsing",
    f"""SELECT o_orderkey,
      CASE WHEN d OR bad THEN NULL ELSE raw::DOUBLE END AS as_float,
      CASE WHEN d OR bad OR half THEN NULL ELSE raw::INTEGER END AS as_int,
      CASE WHEN d OR bad THEN '' ELSE {dec('dd')} END AS as_decimal,
      CASE WHEN d OR bad OR half THEN raw ELSE raw::BIGINT::VARCHAR END AS as_year
    FROM (SELECT *, try_cast(raw AS DECIMAL(18, 6)) AS dd FROM (
      SELECT o_orderkey, o_orderkey % 11 = 0 AS d, o_orderkey % 7 = 0 AS bad, o_orderkey % 5 = 0 AS half,
        CASE WHEN o_orderkey % 7 = 0 THEN '$' ELSE '' END || floor(o_totalprice)::BIGINT
        || CASE WHEN o_orderkey % 5 = 0 THEN '.50' ELSE '' END
        || CASE WHEN o_orderkey % 11 = 0 THEN 'd' ELSE '' END AS raw FROM orders))""",
)
put(
    "rating_functions",
    f"""SELECT seq, {score('"indicatorRating"')}::INTEGER AS score,
      {letter('greatest(' + ', '.join(score(c) for c in ('"adjustedHazardExposureRating"', '"hazardExposureRating"', '"HazardRating"')) + ')')}
        AS worst, {band('"indicatorRating"')} AS band, {tone('"indicatorRating"')} AS tone FROM phys""",
)
put(
    "display_values",
    f"""SELECT seq, value * 100 AS percent,
      CASE WHEN value IS NULL THEN 'not quantified' ELSE printf('%.4f%%', value / 700 * 100) END AS percent_label,
      CASE WHEN value IS NULL THEN 'not quantified'
        ELSE printf('%.2f bps (raw %.9f)', value / 700 * 10000, value / 700) END AS bps_label,
      CASE WHEN value IS NULL THEN 'not quantified' ELSE printf('%.9f raw', value / 700) END AS raw_label,
      {magnitude('value', 'unit')} AS magnitude, {peak_text('value', 'horizon')} AS peak FROM inds""",
)
put("listing_names", "SELECT c_custkey, c_name AS name FROM customer")
put("url_hosts", "SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)) AS host FROM pages")
put(
    "points",
    """SELECT seq, split_part(trim("geolocationCoordinates", '()'), ',', 1)::DOUBLE AS lat,
      split_part(trim("geolocationCoordinates", '()'), ',', 2)::DOUBLE AS lon FROM phys""",
)
put("share_ranges", "SELECT seq, flood_barriers = '0.5' AS in_range FROM side")
put(
    "lookup_join_salted",
    """SELECT l.k AS s_suppkey, s_name, count(*) AS n, sum(l_quantity::BIGINT)::BIGINT AS quantity
    FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 1 ELSE l_suppkey END AS k FROM lineitem) l
    LEFT JOIN supplier s ON s.s_suppkey = l.k GROUP BY ALL""",
)

# -- files -----------------------------------------------------------------------------------------------------

HEADERS = [header for _, header in UPLOAD_LAYOUT]
FIRST_KEYS = """asset_name asset_type ticcs_class ticcs_class_name nace_code sector operating_entity_name detention_rate
country country_code address latitude longitude revenues asset_value year""".split()
put(
    "upload_file",
    "SELECT "
    + ", ".join(f'{key} AS "{header}"' for key, header in zip([*FIRST_KEYS, *PASSED], HEADERS, strict=True))
    + f" FROM ({ORACLE['upload_values'][ORACLE['upload_values'].rindex('SELECT scr_asset_name AS asset_name, asset_type'):]})",
)
put(
    "upload_batch_files",
    f"""SELECT ((r - 1) // 1001)::INTEGER AS batch_id, count(*) AS n, 1::BIGINT AS n_files FROM (
      SELECT row_number() OVER () AS r FROM {plain} WHERE {PLAIN_ERRORS} = '') GROUP BY 1""",
)
put(
    "manifest_file",
    f"""SELECT scr_asset_name, any_value(plant_uuid) AS plant_uuid, any_value(nullif(plant_name, '')) AS plant_name,
      nullif(any_value({dec('latitude')}), '') AS latitude,
      bool_or({PLAIN_ERRORS} <> '') AS has_reject FROM {plain} GROUP BY 1""",
)
put(
    "sidecar_file",
    f"""SELECT CASE WHEN (seq // 5) % 4 = 0 THEN k ELSE '' END AS plant_uuid, eia_plant_id, asset_value, revenues,
      operating_entity_name, '' AS address, seq::VARCHAR AS row_no FROM side""",
)
put(
    "long_results_csv",
    """SELECT "assetName", scenario, "timeHorizon", subrisk, "indicatorValue", "adjustedSubriskRevenueImpact",
      NULL::DOUBLE AS "subriskRevenueImpact", "indicatorValue" AS row_key FROM trans""",
)
put(
    "result_set",
    f"""SELECT h.asset_name, h.scenario, h.horizon, h.hazard, hazard_rating, adjusted_hazard_value_impact,
      w.indicator AS worst_indicator, "rating_A" AS n_a, m.portfolio_id
    FROM haz h JOIN (SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, horizon, hazard
        ORDER BY {score('rating')} DESC, value DESC NULLS LAST, seq) AS r FROM inds) w
    ON w.asset_name = h.asset_name AND w.scenario = h.scenario AND w.horizon = h.horizon AND w.hazard = h.hazard
      AND w.r = 1
    LEFT JOIN mani m ON m.scr_asset_name = h.asset_name WHERE h.scenario = 'ssp5-8.5'""",
)
put(
    "result_set_incremental",
    f"""SELECT h.*, w.worst_1, w.worst_2, w.worst_3, m.portfolio_id
    FROM haz h JOIN (
      SELECT asset_name, scenario, horizon, hazard, {", ".join(f"max(indicator) FILTER (r = {i}) AS worst_{i}" for i in (1, 2, 3))}
      FROM (SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, horizon, hazard
        ORDER BY {score('rating')} DESC, value DESC NULLS LAST, seq) AS r FROM inds) GROUP BY ALL) w
    USING (asset_name, scenario, horizon, hazard) LEFT JOIN mani m ON m.scr_asset_name = h.asset_name""",
)
put("trends_incremental", "SELECT * FROM ptrends")
put("rankings_incremental", "SELECT * FROM ranks")
put(
    "import_history",
    """SELECT import_id, m.plant_uuid, m.portfolio_asset_id, count(*) AS n
    FROM phys LEFT JOIN mani m ON m.scr_asset_name = "assetName"
    CROSS JOIN (VALUES ('first'), ('second')) i(import_id) GROUP BY ALL""",
)
put(
    "import_history_as_of",
    """SELECT version, "table", CASE i WHEN 0 THEN 'first' ELSE 'second' END AS import_id, source_file,
      CASE "table" WHEN 'physical_long' THEN n ELSE 1 END AS n
    FROM (SELECT source_file, count(*) AS n FROM phys GROUP BY 1), (VALUES (0, 0), (1, 0), (1, 1)) v(version, i), (VALUES ('physical_long'), ('import_manifest')) t("table")""",
)
put(
    "import_log",
    """SELECT version::BIGINT AS version, 'physical_long' AS "table", import_id, (SELECT count(*) FROM phys) AS n_rows, true AS agrees
    FROM (VALUES (0, 'first'), (1, 'second')) v(version, import_id)""",
)
put(
    "import_returns",
    """SELECT * FROM (WITH p AS (SELECT *, seq // 1000 AS block FROM phys WHERE "assetName" <> ''),
    w AS (
      SELECT 'hazard_not_in_metadata' AS code, hazard AS detail FROM p
      WHERE hazard <> '' AND lower(hazard) NOT IN (SELECT lower(term) FROM vocab) GROUP BY hazard
      UNION ALL SELECT 'hazard_not_returned', term FROM vocab WHERE lower(term) NOT IN (SELECT lower(hazard) FROM p)
      UNION ALL SELECT DISTINCT 'metrics_blank', block::VARCHAR FROM p
      WHERE "indicatorValue" IS NULL AND "adjustedHazardValueImpact" IS NULL
    )
    SELECT 'pass' AS part, 'rows' AS name, count(*) AS n FROM p
    UNION ALL SELECT 'pass', 'blank_names', 0 UNION ALL SELECT 'pass', 'unusable_files', 0 UNION ALL SELECT 'pass', 'version', 0
    UNION ALL SELECT 'pass', 'blank_metrics', count(*) FROM p WHERE "indicatorValue" IS NULL AND "adjustedHazardValueImpact" IS NULL
    UNION ALL SELECT 'pass', 'warnings', count(*) FROM w
    UNION ALL SELECT 'manifest', 'rows', count(*) FROM p UNION ALL SELECT 'manifest', 'files', count(DISTINCT block) FROM p
    UNION ALL SELECT 'manifest', 'assets', count(*) FROM (SELECT DISTINCT block, "assetName" FROM p)
    UNION ALL SELECT 'warnings', code, count(*) FROM w GROUP BY code)""",
)
put(
    "workbook_blank_rows",
    """SELECT 'block_' || lpad((seq // 1000)::VARCHAR, 6, '0') AS source_file, seq % 1000 AS row_in_file, seq, indicator FROM phys""",
)
put(
    "workbook_failures",
    """SELECT 'supplier_' || s_suppkey AS source_file,
      CASE s_suppkey % 5 WHEN 1 THEN 'missing_columns' WHEN 2 THEN 'wrong_kind' ELSE 'unreadable_file' END AS code,
      CASE s_suppkey % 5 WHEN 1 THEN 'climateZone, countryCode' WHEN 2 THEN 'transition where physical was asked for'
        WHEN 3 THEN 'no sheet Output' ELSE 'File is not a zip file' END AS detail
    FROM supplier WHERE s_suppkey % 5 <> 0""",
)
put(
    "run_messages",
    f"""SELECT kind, message, count(*) AS n FROM (
      SELECT 'error' AS kind, unnest(string_split({STRICT_ERRORS}, '|')) AS message FROM {strict}
      UNION ALL SELECT 'warning', unnest(string_split({STRICT_WARNINGS}, '|')) FROM {strict}
    ) WHERE message <> '' GROUP BY ALL""",
)
put(
    "workbook_rows",
    """SELECT seq, seq % 1000 AS row_in_file, 'block_' || lpad((seq // 1000)::VARCHAR, 6, '0') AS source_file,
      "assetName", scenario, "timeHorizon", hazard, indicator, "indicatorRating", "indicatorValue" FROM phys""",
)

# -- orders, names and files ---------------------------------------------------------------


def position(order: str) -> str:
    return f"row_number() OVER (ORDER BY {order}) AS position"


PLACES = "asset_name, scenario, horizon"
INDICATOR_ORDER = PLACES + ", coalesce(hazard, ''), coalesce(indicator, ''), seq"
SUBRISK_ORDER = PLACES + ", coalesce(subrisk, ''), coalesce(indicator, ''), seq"
EXPORT_ORDER = "coalesce(slug, ''), coalesce(name, ''), plant_slug, plant_uuid, coalesce(portfolio_asset_id, '')"
put(
    "ordered_scope",
    f"""SELECT plant_uuid, portfolio_asset_id, {position(EXPORT_ORDER)}
    FROM (SELECT r.plant_uuid, r.plant_slug, w.slug, f.name, pa.id AS portfolio_asset_id FROM rec r LEFT JOIN ws w ON w.id = r.home
      LEFT JOIN pfa pa ON pa.plant_uuid = r.plant_uuid LEFT JOIN pf f ON f.id = pa.portfolio_id
      WHERE r.plant_uuid IN (SELECT {uuid('o_custkey')} FROM orders))""",
)
put("ordered_assets", f"SELECT asset_name, {position('asset_name')} FROM firsts")
put(
    "ordered_trends",
    f"""SELECT {PLACES}, 'physical_trends' AS "table", {position(PLACES)} FROM ptrends
    UNION ALL SELECT {PLACES}, 'transition_trends', {position(PLACES)} FROM ttrends""",
)
put("ordered_hazards", f"SELECT {PLACES}, hazard, {position(PLACES + ', hazard')} FROM haz")
put("ordered_indicators", f"SELECT seq, {position(INDICATOR_ORDER)} FROM inds")
put("indicator_page", f"SELECT * FROM (SELECT seq, {position(INDICATOR_ORDER)} FROM inds) WHERE position BETWEEN 101 AND 200")
put("ordered_subrisks", f"SELECT seq, {position(SUBRISK_ORDER)} FROM subs")
put("ordered_rankings", f"SELECT asset_name, scenario, {position('asset_name, peak_impact DESC, scenario')} FROM ranks")
put(
    "ordered_points",
    f"""SELECT p.seq, {position("p.asset_name, p.scenario, p.hazard, p.indicator, p.unit, p.x, p.horizon, p.seq")}
    FROM {POINTS} p JOIN (
      SELECT *, row_number() OVER (PARTITION BY asset_name, scenario, hazard ORDER BY distinct_y DESC, distinct_x DESC, indicator, unit) AS r
      FROM (SELECT asset_name, scenario, hazard, indicator, unit, count(*) AS n,
          count(DISTINCT printf('%.11e', x)) AS distinct_x, count(DISTINCT printf('%.11e', y)) AS distinct_y
        FROM {POINTS} GROUP BY ALL) WHERE n >= 3 AND distinct_x > 1) s
    USING (asset_name, scenario, hazard, indicator, unit) WHERE s.r <= 2""",
)
put("ordered_portfolios", f"SELECT workspace_id, id AS portfolio_id, {position('workspace_id, created_at DESC, id')} FROM pf")
put(
    "lookup_files",
    """SELECT 'type' AS lookup, asset_type AS "key", sector AS "value" FROM types
    UNION ALL SELECT 'country', country, iso3 FROM countries""",
)
put(
    "quoted_lines",
    """SELECT o_orderkey AS "key", CASE WHEN o_orderkey % 3 = 0 THEN 'two "lines",' || chr(10) || o_custkey
      WHEN o_orderkey % 5 = 0 THEN '"' ELSE o_custkey::VARCHAR END AS note, o_orderkey % 7 AS rest FROM orders""",
)
put("vocabulary_file", "SELECT DISTINCT p_brand AS term FROM part WHERE p_partkey % 9 <> 0")
put(
    "resolved_names",
    """SELECT 'workspace' AS kind, a.slug AS asked, coalesce(w.id, 'no') AS outcome
    FROM (VALUES ('africa'), ('middle east'), ('mars')) a(slug) LEFT JOIN ws w ON w.slug = a.slug AND w.is_live
    UNION ALL SELECT 'portfolio', a.ws || '/' || a.pf, CASE WHEN a.pf = 'pf_2' THEN 'several' ELSE coalesce(f.id, 'no') END
    FROM (VALUES ('ws_1', 'pf_1'), ('ws_2', 'pf_2'), ('ws_0', 'pf_10'), ('ws_3', 'pf_1')) a(ws, pf)
    LEFT JOIN pf f ON f.id = a.pf AND f.workspace_id = a.ws""",
)
put(
    "error_counts_strict",
    f"""SELECT message, count(*) AS n FROM (
      SELECT unnest(string_split({STRICT_ERRORS.replace("'missing_asset_value'", "'missing_asset_value_strict'")}, '|')) AS message
    FROM {strict}) WHERE message <> '' GROUP BY 1""",
)
put(
    "portfolio_top_subrisks",
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY portfolio_id
      ORDER BY max_value DESC NULLS LAST, peak_subrisk)::INTEGER AS position FROM (
      SELECT portfolio_id, peak_subrisk, max(peak_impact) AS max_value, count(DISTINCT asset_name) AS n_assets
      FROM ranks JOIN mani ON scr_asset_name = asset_name WHERE peak_subrisk <> '' GROUP BY ALL))
    WHERE position <= 5""",
)
put(
    "vocabulary_suggestions",
    """SELECT t.term, t.row_count, CASE WHEN lower(t.term) IN (SELECT lower(term) FROM vocab) THEN 'mapped' ELSE 'missing' END
        AS metadata_mapping_status, arg_min(k.term, struct_pack(d := k.d, t := k.term)) AS suggestion, min(k.d)::INTEGER AS distance
    FROM (SELECT term, count(*) AS row_count FROM (SELECT CASE seq % 6 WHEN 1 THEN hazard || 's' WHEN 2 THEN substr(hazard, 2)
          WHEN 3 THEN 'x' || hazard || 'yy' WHEN 4 THEN reverse(hazard) WHEN 5 THEN substr(hazard, 1, 1) || 'zz' || substr(hazard, 4)
          ELSE hazard END AS term FROM phys WHERE hazard <> '') GROUP BY 1) t
    LEFT JOIN (SELECT a.term AS asked, v.term, levenshtein(lower(a.term), lower(v.term)) AS d
      FROM (SELECT DISTINCT CASE seq % 6 WHEN 1 THEN hazard || 's' WHEN 2 THEN substr(hazard, 2)
          WHEN 3 THEN 'x' || hazard || 'yy' WHEN 4 THEN reverse(hazard) WHEN 5 THEN substr(hazard, 1, 1) || 'zz' || substr(hazard, 4)
          ELSE hazard END AS term FROM phys WHERE hazard <> '') a, vocab v) k ON k.asked = t.term AND k.d <= 2
    GROUP BY ALL""",
)

CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split("assetName", ''), lambda c: ord(c)::BIGINT)),
  lambda crc, c: list_reduce(list_prepend(xor(crc, c), range(8)),
    lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""
VIEWS["sparse"] = f"""
    SELECT * EXCLUDE ("assetId"), CASE WHEN number = 2 THEN "assetId" || 'x' ELSE "assetId" END AS "assetId",
      epoch(['2026-07-01', '2026-07-11', '2026-07-11', '2026-07-21', '2026-09-19'][number + 1]::TIMESTAMP)::BIGINT AS moment
    FROM (SELECT *, (seq // 50) % 5 AS number FROM phys WHERE "assetName" <> '') WHERE {CRC} % 4 <> number OR number = 4"""
VIEWS["told"] = """
    SELECT "assetName" AS asset_name, moment, arg_min(ROW("assetId", "climateZone", "geolocationCoordinates", "countryCode", "ticcsSubClass", "ticcsSubClassName"), seq) AS context,
      arg_min("assetId", seq) AS scr_asset_id, arg_min("climateZone", seq) AS climate_zone, number
    FROM sparse GROUP BY "assetName", moment, number
    QUALIFY number = max(number) OVER (PARTITION BY moment)"""
VIEWS["runs"] = """
    SELECT t.*, u.until, CASE WHEN lag(u.until) OVER w = t.moment AND lag(t.context) OVER w = t.context THEN 0 ELSE 1 END AS starts
    FROM told t JOIN (SELECT moment, lead(moment) OVER (ORDER BY moment) AS until FROM (SELECT DISTINCT moment FROM sparse)) u ON u.moment = t.moment
    WINDOW w AS (PARTITION BY t.asset_name ORDER BY t.moment)"""
VIEWS["held"] = """
    SELECT asset_name, arg_min(scr_asset_id, moment) AS scr_asset_id, arg_min(climate_zone, moment) AS climate_zone,
      'import_' || arg_min(number, moment) AS import_id, min(moment) AS valid_from,
      CASE WHEN count(*) = count(until) THEN max(until) END AS valid_to
    FROM (SELECT *, sum(starts) OVER (PARTITION BY asset_name ORDER BY moment) AS run FROM runs) GROUP BY asset_name, run"""
put("asset_context_intervals", "SELECT * FROM held")
put(
    "asset_context_as_of",
    f"""SELECT a.o_orderkey, a.asset_name, h.scr_asset_id, h.import_id, h.valid_from
    FROM (SELECT o_orderkey, {returned_name('(o_custkey % 40)')} AS asset_name,
      epoch('2026-06-28'::TIMESTAMP)::BIGINT + o_orderkey % 130 * 86400 AS moment FROM orders) a
    LEFT JOIN held h ON h.asset_name = a.asset_name AND h.valid_from <= a.moment AND (h.valid_to IS NULL OR a.moment < h.valid_to)""",
)

"""Check SQL: the same source tables and plans as common table expressions for DuckDB.

Written from the definitions, not from the Spark code: plain groupings, row_number for ties,
cross joins for searches. ``with_tables`` puts the needed expressions in front of a query.
"""

from __future__ import annotations

import re

from tenderline import catalog
from testbed import tables as B

CTES: dict[str, str] = {}
#: Expressions that are worked out once, as several others read them.
KEPT = {"p_products", "p_features", "s_bounds", "s_grid", "s_ladder", "s_run1", "s_two", "s_run2", "s_optimum", "s_targets", "s_surch", "s_quotes", "s_results", "s_updates", "s_surch_updates"}


def values(rows: list[tuple], names: str) -> str:
    def lit(v) -> str:
        if v is None:
            return "NULL"
        if isinstance(v, bool):
            return str(v).lower()
        if isinstance(v, float):
            return f"{v!r}::DOUBLE"
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({names})"


def with_tables(query: str) -> str:
    """Prefix the query with every expression it uses, directly or through others."""
    order: list[str] = []

    def need(text: str) -> None:
        for name, body in CTES.items():
            if name not in order and re.search(rf"\b{name}\b", text):
                need(body)
                if name not in order:
                    order.append(name)

    need(query)
    kept = lambda n: "MATERIALIZED " if n in KEPT else ""
    return "WITH " + ",\n".join(f"{n} AS {kept(n)}({CTES[n]})" for n in order) + "\n" + query if order else query


def q(text: str) -> str:
    return f"floor(({text}) * 1024.0) / 1024.0"


def listed(names) -> str:
    return "(" + ", ".join(f"'{n}'" for n in names) + ")"


GROUND, AIR, TRADE, RESI = (listed(x) for x in (catalog.GROUND_FAMILY, catalog.AIR_FAMILY, catalog.TRADE_FAMILY, catalog.RESIDENTIAL_FAMILY))

# --- source tables ---------------------------------------------------------------------
CTES["t_line"] = f"""
SELECT *, 'B' || (l_orderkey // 3) AS bid_id, l_orderkey // 3 AS bid_number, CAST(l_partkey % 20 AS INT) AS svc_group,
  {q('l_extendedprice / 100.0')} AS line_rev, {q('l_extendedprice / l_quantity / 100.0')} AS price_pp
FROM lineitem"""
CTES["t_groups"] = f"""
SELECT bid_id, svc_group,
  CASE svc_group % 10 WHEN 8 THEN 'I' WHEN 9 THEN 'E' ELSE 'N' END AS direction, 'S' || (svc_group % 10) AS svc_type,
  CASE WHEN svc_group >= 10 THEN 'F1' ELSE 'F0' END AS feature, 'PKG' AS package_type,
  CAST(part % 50 + 1 AS DOUBLE) AS density,
  CAST(CASE supplier % 4 WHEN 0 THEN 15 WHEN 1 THEN 60 ELSE supplier % 7 + 40 END AS INT) AS competitor_code,
  volume, prior_volume, list_pp, freight_pp, {q('list_pp * (0.4 + (supplier % 20) / 100.0)')} AS marg_cost_pp, {q('list_pp * 0.9')} AS full_cost_pp,
  CASE WHEN first_line % 3 = 0 THEN 0.0 ELSE {q('freight_pp * (1.0 - discount)')} END AS comp_keyed_pp
FROM (SELECT *, {q('list_pp * (1.0 - tax)')} AS freight_pp FROM (
  SELECT *, {q('rev / volume')} AS list_pp FROM (
    SELECT bid_id, svc_group, sum(l_quantity) AS volume, sum(line_rev) AS rev, min(l_tax) AS tax, min(l_discount) AS discount,
      min(l_suppkey) AS supplier, min(l_linenumber) AS first_line, min(l_partkey) AS part,
      sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0 END) AS prior_volume
    FROM t_line GROUP BY ALL)))"""
CTES["t_volumes"] = f"""
SELECT bid_id, svc_group, 'A' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS account, l_linenumber AS tier, l_quantity AS qty, price_pp,
  CASE WHEN l_returnflag <> 'N' THEN {q('price_pp * 0.9')} * 13.0 ELSE 0.0 END AS prior_gross_pp,
  CASE WHEN l_returnflag <> 'N' THEN {q('price_pp * 0.9 * (1.0 - 3.0 * l_discount)')} * 13.0 ELSE 0.0 END AS prior_net_pp
FROM t_line JOIN orders ON l_orderkey = o_orderkey"""
CTES["t_targets"] = f"""
SELECT bid_id, svc_group, CAST(l_linenumber % 3 AS DOUBLE) AS factor, {q('price_pp * 0.9')} AS comp_est_pp, {q('price_pp * 0.7')} AS target_pp,
  {q('price_pp * 0.65')} AS target_low_pp, {q('price_pp * 0.72')} AS target_high_pp
FROM t_line"""
CTES["t_weights"] = """
SELECT bid_id, svc_group, zone, unit, CASE WHEN unit = 'OZ' THEN w / 16.0 ELSE w END AS weight, packages FROM (
  SELECT bid_id, svc_group,
    CASE WHEN l_linenumber = 7 THEN 'ALL' WHEN l_suppkey % 97 = 0 THEN '44' WHEN l_suppkey % 10 < 7 THEN CAST(l_suppkey % 10 + 2 AS VARCHAR)
      ELSE CAST(l_suppkey % 10 + 39 AS VARCHAR) END AS zone,
    CASE WHEN l_linenumber = 1 THEN 'OZ' ELSE 'LB' END AS unit,
    CAST(CAST((l_quantity - 1.0) * 2.5 AS DECIMAL(9,2)) AS DOUBLE) AS w, round(CAST(l_partkey % 9 + 1 AS DOUBLE), 10) AS packages
  FROM t_line) WHERE zone <> 'ALL'"""
CTES["t_ceiling"] = "SELECT DISTINCT bid_id, svc_group FROM t_line WHERE svc_group % 4 <> 3"
CTES["t_prior"] = """
SELECT bid_id, svc_group, result_type, line / 16.0 AS recommended, line / 16.0 - 0.0625 AS low, line / 16.0 + 0.0625 AS high
FROM (SELECT bid_id, svc_group, min(l_linenumber) AS line FROM t_line GROUP BY ALL), (VALUES ('P'), ('T')) AS k(result_type)"""
CTES["t_surcharge"] = """
SELECT DISTINCT bid_id, svc_group, 'N' AS direction, 'F1' AS feature, 'S7' AS svc_type,
  CASE WHEN bid_number % 2 = 0 THEN 'RES' ELSE 'GDL' END AS surcharge_type, 'PKG' AS package_type, 'A' AS acquisition
FROM t_line WHERE svc_group = 17"""
CTES["t_bids"] = """
SELECT 'B' || n AS bid_id, CAST(n % 6 AS VARCHAR) AS category_code,
  CASE WHEN n % 7 = 0 THEN 'C' WHEN n % 11 = 0 THEN '$' WHEN s = 'F' THEN 'A' WHEN s = 'O' THEN 'R' ELSE 'P' END AS status,
  last AS status_date, CASE WHEN n % 13 <> 0 THEN last - CAST(n % 120 AS INT) END AS proposed_date, first AS init_date, CAST(n % 4 AS INT) AS reason_code
FROM (SELECT o_orderkey // 3 AS n, min(o_orderstatus) AS s, CAST(min(o_orderdate) AS DATE) AS first, CAST(max(o_orderdate) AS DATE) AS last FROM orders GROUP BY 1)"""
CTES["t_shippers"] = """
SELECT 'B' || n AS bid_id, 'A' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS account, '1' || lpad(CAST(c_custkey % 11 AS VARCHAR), 2, '0') AS industry_code,
  lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS district, lpad(CAST(n_regionkey AS VARCHAR), 2, '0') AS region
FROM (SELECT DISTINCT o_orderkey // 3 AS n, o_custkey FROM orders) JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
CTES["t_codes"] = values(
    [({8: "I", 9: "E"}.get(g % 10, "N"), f"S{g % 10}", f"F{g // 10}", "Unknown" if g == 19 else B.PRODUCT_ORDER[g % 10]) for g in range(20) if g != 18],
    "direction, svc_type, feature, product",
)
CTES["t_bands"] = values(B.band_rows(), "product, min_rev, max_rev, ceiling")
CTES["t_breaks"] = values(B.SURCHARGE_BREAKS, "surcharge_type, break_at, incentive")
CTES["t_surcharge_map"] = values(B.surcharge_map_rows(), "product, direction, feature, svc_type, surcharge_type, package_type, acquisition, description")
CTES["t_industry"] = values(B.industry_rows(), "industry_code, segment")
CTES["t_overlay"] = values(B.overlay_rows(), "district, industry, product, increment")
CTES["t_holdout"] = values([(d, d != 3) for d in range(10) if d != 8], "digit, is_on")
CTES["t_seg_tier"] = values(B.segment_tiers(), "mode, tier, tier_segment")
CTES["t_seg_density"] = values(B.segment_densities(), "mode, min_value, max_value, density_segment")
CTES["t_seg_size"] = values(B.segment_sizes(), "mode, min_value, max_value, size_segment")
CTES["t_seg_cohort"] = values(B.segment_cohorts(), "mode, tier_segment, density_segment, size_segment, cohort")
CTES["t_seg_incentive"] = values(B.segment_incentives(), "mode, cohort, incentive")
CTES["t_modes"] = values([(p, m) for p, m in catalog.PRODUCT_MODES.items()], "product, mode")
CTES["t_settings"] = values(
    [(m, *[float(v) for v in s.values()]) for m, s in catalog.MODE_SETTINGS.items()], "mode, " + ", ".join(catalog.MODE_SETTINGS["AIR"])
)

# --- plans ------------------------------------------------------------------------------
def modal(table: str, value: str, keys: str) -> str:
    return (
        f"SELECT {keys}, {value} FROM (SELECT {keys}, {value}, row_number() OVER (PARTITION BY {keys} ORDER BY count(*) DESC, {value}) AS rn "
        f"FROM {table} WHERE {value} IS NOT NULL GROUP BY {keys}, {value}) WHERE rn = 1"
    )


CTES["p_headers"] = f"""
SELECT b.bid_id, status, status_date, proposed_date, init_date, reason_code,
  CASE '0' || category_code WHEN '01' THEN 'National' WHEN '02' THEN 'Major' WHEN '03' THEN 'Key' WHEN '04' THEN 'Small' ELSE 'Not known' END AS category,
  region, district, account AS lead_account
FROM t_bids b JOIN ({modal('t_shippers', 'region', 'bid_id')}) USING (bid_id) JOIN ({modal('t_shippers', 'district', 'bid_id')}) USING (bid_id)
JOIN (SELECT bid_id, account FROM (SELECT bid_id, account, row_number() OVER (PARTITION BY bid_id ORDER BY sum(qty * price_pp) DESC, account) AS rn
  FROM t_volumes GROUP BY 1, 2) WHERE rn = 1) USING (bid_id)"""
CTES["p_latest"] = """
SELECT bid_id, svc_group, max(comp_est_pp) AS comp_est_pp, max(target_pp) AS target_pp, max(target_low_pp) AS target_low_pp, max(target_high_pp) AS target_high_pp
FROM t_targets t WHERE factor = (SELECT max(factor) FROM t_targets u WHERE u.bid_id = t.bid_id) GROUP BY 1, 2"""
CTES["p_rollup"] = f"""
SELECT * FROM (SELECT bid_id, svc_group, sum(qty * prior_gross_pp) AS prior_gross, sum(qty * prior_net_pp) AS prior_net FROM t_volumes GROUP BY 1, 2)
JOIN ({modal('t_volumes', 'tier', 'bid_id, svc_group')}) USING (bid_id, svc_group)"""
CTES["p_lines"] = """
SELECT g.*, comp_est_pp, target_pp, target_low_pp, target_high_pp, tier,
  CASE WHEN competitor_code IN (15, 16, 60, 83) THEN 'FedEx' ELSE 'Other' END AS competitor,
  CASE WHEN comp_keyed_pp = 0 THEN comp_est_pp ELSE comp_keyed_pp END AS comp_net_pp,
  prior_gross / 13.0 AS prior_gross_rev, prior_net / 13.0 AS prior_net_rev
FROM t_groups g LEFT JOIN p_latest USING (bid_id, svc_group) LEFT JOIN p_rollup USING (bid_id, svc_group)
WHERE NOT EXISTS (SELECT 1 FROM t_surcharge s WHERE s.bid_id = g.bid_id AND s.svc_group = g.svc_group)"""
CTES["p_product_lines"] = """
SELECT l.*, c.product FROM p_lines l LEFT JOIN t_codes c USING (direction, svc_type, feature) WHERE c.product IS NULL OR c.product NOT IN ('GND_Unclassified', 'Unknown')"""
CTES["p_bids"] = """
SELECT *, CASE status_updated WHEN 'A' THEN '1' WHEN 'C' THEN '1' WHEN 'O' THEN '1' WHEN 'R' THEN '0' ELSE 'Unclassified' END AS win_flag_updated FROM (
  SELECT *, date_diff('day', proposed_date, status_date) AS proposed_lag,
    CASE WHEN status = 'P' AND date_diff('day', proposed_date, status_date) > 90 THEN 'R' ELSE status END AS status_updated,
    CAST(status = 'P' AS INT) AS proposal_flag,
    CASE status WHEN 'A' THEN '1' WHEN 'C' THEN '1' WHEN 'O' THEN '1' WHEN 'R' THEN '0' ELSE 'Unclassified' END AS win_flag,
    CASE reason_code WHEN 1 THEN 'RETENTION' WHEN 2 THEN 'PENETRATION' WHEN 3 THEN 'CONVERSION' ELSE 'Other' END AS reason,
    date_diff('day', init_date, status_date) / 7.0 AS weeks_since_init, month(init_date) AS month_of_bid
  FROM p_headers)"""

BANDS = [
    f"WHEN w > {lo} AND w <= {hi if hi is not None else '1e308'} THEN '{label}'"
    for lo, hi, label in zip(catalog.WEIGHT_EDGES, catalog.WEIGHT_EDGES[1:], catalog.WEIGHT_LABELS)
]
BANDS_AS_CODED = [
    f"WHEN w > {lo} AND w <= {hi} THEN '{label}'"
    for lo, hi, label in zip(catalog.WEIGHT_EDGES_AS_CODED, catalog.WEIGHT_EDGES_AS_CODED[1:], catalog.WEIGHT_LABELS)
]
for name, bands in (("p_packed", BANDS), ("p_packed_as_coded", BANDS_AS_CODED)):
    CTES[name] = f"""
SELECT bid_id, product, zone, w * packages AS moved, packages, CASE {' '.join(bands)} END AS band FROM (
  SELECT t.bid_id, c.product, t.zone, t.packages, CASE WHEN weight = 0 THEN 0.01 ELSE weight END AS w
  FROM t_weights t JOIN t_groups g USING (bid_id, svc_group) JOIN t_codes c ON c.direction = g.direction AND c.svc_type = g.svc_type AND c.feature = g.feature)"""
CTES["p_zone_shares"] = """
SELECT bid_id, product, zone, moved / nullif(sum(moved) OVER (PARTITION BY bid_id, product), 0) AS zone_pct
FROM (SELECT bid_id, product, zone, sum(moved) AS moved FROM p_packed GROUP BY ALL)"""
CTES["p_band_shares"] = """
SELECT bid_id, product, band, packages, packages / nullif(sum(packages) OVER (PARTITION BY bid_id, product), 0) AS band_pct
FROM (SELECT bid_id, product, band, sum(packages) AS packages FROM p_packed WHERE band IS NOT NULL GROUP BY ALL)"""
CTES["p_profile"] = "SELECT * FROM (SELECT bid_id, product, " + ", ".join(
    f"coalesce(sum(band_pct) FILTER (band = '{b}'), 0.0) AS \"{b}_pct\"" for b in catalog.WEIGHT_LABELS
) + " FROM p_band_shares GROUP BY 1, 2) JOIN (SELECT bid_id, product, " + ", ".join(
    f"round(coalesce(sum(zone_pct) FILTER (zone = '{z}'), 0.0), 9) AS \"{z}_pct\"" for z in catalog.ZONES
) + " FROM p_zone_shares GROUP BY 1, 2) USING (bid_id, product)"

WEEKLY = {
    "list_rev": "list_pp * volume", "freight_rev": "freight_pp * volume", "watched_rev": "CASE WHEN competitor = 'FedEx' THEN list_pp * volume ELSE 0.0 END",
    "marg_cost": "marg_cost_pp * volume", "volume": "volume", "prior_volume": "prior_volume", "comp_net_rev": "comp_net_pp * volume",
    "target_high_rev": "target_high_pp * volume", "target_low_rev": "target_low_pp * volume", "prior_net_rev": "prior_net_rev",
    "prior_gross_rev": "prior_gross_rev", "comp_keyed_rev": "comp_keyed_pp * volume", "comp_est_rev": "comp_est_pp * volume",
    "density_rev": "density * list_pp * volume",
}


def floor0(text: str) -> str:
    return f"CASE WHEN ({text}) IS NOT NULL THEN greatest({text}, 0.0) END"


RATIOS = f"""watched_rev / nullif(list_rev, 0) AS watched_share, 1.0 - prior_net_rev / nullif(prior_gross_rev, 0) AS prior_incentive,
  {floor0('1.0 - prior_volume / nullif(volume, 0)')} AS new_volume_share, marg_cost / nullif(list_rev, 0) AS gross_cost_ratio,
  freight_rev / nullif(list_rev, 0) AS freight_share,
  CASE WHEN watched_rev / nullif(list_rev, 0) > 0.95 THEN 1 ELSE 0 END AS mostly_watched,
  CASE WHEN watched_rev / nullif(list_rev, 0) < 0.2 THEN 1 ELSE 0 END AS mostly_third_party"""
CTES["p_sums"] = "SELECT * FROM (SELECT bid_id, product, " + ", ".join(f"sum({v}) AS {k}" for k, v in WEEKLY.items()) + f""" FROM p_product_lines WHERE product IS NOT NULL GROUP BY 1, 2)
LEFT JOIN (SELECT bid_id, product, competitor AS major_competitor FROM (SELECT bid_id, product, competitor,
  row_number() OVER (PARTITION BY bid_id, product ORDER BY sum(list_pp * volume) DESC, competitor) AS rn FROM p_product_lines WHERE product IS NOT NULL GROUP BY 1, 2, 3) WHERE rn = 1) USING (bid_id, product)
LEFT JOIN ({modal('(SELECT * FROM p_product_lines WHERE product IS NOT NULL)', 'tier', 'bid_id, product')}) USING (bid_id, product)"""
CTES["p_products"] = f"""
SELECT *, freight_share - avg_freight AS freight_share_centred, list_rev / nullif(bid_list_rev, 0) AS product_share,
  list_rev / nullif(CASE WHEN product IN {GROUND} THEN ground_list_rev WHEN product IN {AIR} THEN air_list_rev WHEN product IN {TRADE} THEN trade_list_rev END, 0) AS family_share,
  CASE WHEN comp_keyed_flag = 1 THEN {floor0('1.0 - comp_keyed_rev / nullif(freight_rev, 0)')} END AS comp_keyed_incentive
FROM (SELECT *, avg(freight_share) OVER w AS avg_freight, sum(list_rev) OVER w AS bid_list_rev,
    sum(CASE WHEN product IN {GROUND} THEN list_rev ELSE 0.0 END) OVER w AS ground_list_rev,
    sum(CASE WHEN product IN {AIR} THEN list_rev ELSE 0.0 END) OVER w AS air_list_rev,
    sum(CASE WHEN product IN {TRADE} THEN list_rev ELSE 0.0 END) OVER w AS trade_list_rev,
    1.0 - target_high_rev / nullif(freight_rev, 0) AS target_high_inc, 1.0 - target_low_rev / nullif(freight_rev, 0) AS target_low_inc,
    density_rev / nullif(list_rev, 0) AS density, {floor0('1.0 - comp_net_rev / nullif(freight_rev, 0)')} AS comp_incentive,
    CASE WHEN comp_keyed_rev > 0 THEN 1 ELSE 0 END AS comp_keyed_flag, bid_id || '_' || product AS bid_product,
    coalesce((SELECT mode FROM t_modes m WHERE m.product = r.product), 'Unknown') AS mode
  FROM (SELECT *, {RATIOS} FROM p_sums) r WINDOW w AS (PARTITION BY bid_id))"""
BID_SUMS = [k for k in WEEKLY if k != "density_rev"]
CTES["p_bid_summary"] = f"""
SELECT *, CASE WHEN new_volume_share > 0.6 THEN 'CONVERSION_Prod' WHEN new_volume_share <= 0.2 THEN 'RETENTION_Prod' ELSE 'PENETRATION_Prod' END AS volume_reason,
  CASE WHEN ground_share > 0.8 THEN 1 ELSE 0 END AS ground_centric, CASE WHEN air_share > 0.6 THEN 1 ELSE 0 END AS air_centric,
  CASE WHEN residential_share > 0.6 THEN 1 ELSE 0 END AS residential_centric, CASE WHEN trade_share > 0.4 THEN 1 ELSE 0 END AS trade_centric,
  CASE WHEN comp_keyed_rev IS NULL THEN 0 WHEN comp_keyed_rev = 0 AND comp_est_rev > 1 THEN 0 ELSE 1 END AS keyed_flag,
  CASE WHEN comp_keyed_rev > comp_est_rev * 1.2 THEN 1 ELSE 0 END AS keyed_higher, CASE WHEN comp_keyed_rev < comp_est_rev * 0.8 THEN 1 ELSE 0 END AS keyed_lower,
  CASE WHEN list_rev < 200 THEN 1 ELSE 0 END AS below_200
FROM (SELECT *, {RATIOS} FROM (SELECT bid_id, {', '.join(f'sum({c}) AS {c}' for c in BID_SUMS)},
    sum(CASE WHEN product IN {GROUND} THEN product_share ELSE 0.0 END) AS ground_share, sum(CASE WHEN product IN {AIR} THEN product_share ELSE 0.0 END) AS air_share,
    sum(CASE WHEN product IN {RESI} THEN product_share ELSE 0.0 END) AS residential_share, sum(CASE WHEN product IN {TRADE} THEN product_share ELSE 0.0 END) AS trade_share,
    sum(CASE WHEN product = 'Air_CWT' THEN product_share ELSE 0.0 END) AS air_heavy_share, sum(CASE WHEN product = 'GND_CWT' THEN product_share ELSE 0.0 END) AS ground_heavy_share,
    sum(product_share * product_share) AS concentration
  FROM p_products GROUP BY 1))
LEFT JOIN (SELECT bid_id, major_competitor FROM (SELECT bid_id, major_competitor, row_number() OVER (PARTITION BY bid_id ORDER BY sum(list_rev) DESC, major_competitor) AS rn
  FROM p_products GROUP BY 1, 2) WHERE rn = 1) USING (bid_id)"""
CTES["p_features"] = """
SELECT p.* EXCLUDE (prior_incentive, density_rev, avg_freight),
  CASE WHEN p.prior_incentive IS NULL AND reason = 'CONVERSION' THEN 0.0 ELSE p.prior_incentive END AS prior_incentive,
  s.trade_centric AS bid_trade_centric, s.concentration AS bid_concentration, s.volume_reason AS bid_volume_reason,
  s.major_competitor AS bid_major_competitor, s.prior_incentive AS bid_prior_incentive, s.gross_cost_ratio AS bid_gross_cost_ratio,
  b.reason AS bid_reason, b.region AS bid_region, b.district AS bid_district, b.category AS bid_category, b.win_flag_updated AS bid_win_flag_updated,
  b.weeks_since_init AS bid_weeks_since_init
FROM p_products p JOIN p_bid_summary s USING (bid_id) LEFT JOIN p_bids b USING (bid_id)"""

# --- scoring ------------------------------------------------------------------------------
CTES["s_response"] = """
SELECT *, shift + 0.25 + (shift + 0.5) * base_logit AS alpha,
  shift - 6.0 + (shift - 3.0) * gross_cost_ratio + CASE WHEN bid_reason = 'CONVERSION' THEN shift + 0.5 ELSE 0.0 END
    + CASE WHEN bid_reason = 'RETENTION' THEN shift - 0.5 ELSE 0.0 END AS gamma
FROM (SELECT *, CASE WHEN product = 'Export' AND right(bid_id, 1) = '7' THEN NULL ELSE 0.15 + 0.5 * product_share END AS market_inc,
    1.0 - 2.0 * watched_share AS base_logit, CASE mode WHEN 'AIR' THEN 0.0::DOUBLE WHEN 'GND' THEN 0.125::DOUBLE ELSE (-0.125)::DOUBLE END AS shift
  FROM p_features WHERE mode IN ('AIR', 'GND', 'IE'))"""
CTES["s_ceiling"] = "SELECT r.*, b.ceiling FROM s_response r JOIN t_bands b ON b.product = r.product AND r.bid_list_rev > b.min_rev AND r.bid_list_rev <= b.max_rev"
CTES["s_limits"] = """
SELECT c.*, t.* EXCLUDE (mode), t.floor AS l_floor,
  [coalesce(u_price * (1.0 - market_inc) - 1.0, 0.0), -1.0, coalesce(u_market * market_inc, -1.0), coalesce(-ceiling, 0.0)] AS highs,
  [CASE WHEN market_inc IS NULL THEN 0.0 ELSE l_price * (1.0 - market_inc) + 1.0 END,
   CASE WHEN bid_trade_centric <> 1 AND list_rev * (1.0 - new_volume_share) <= 20 AND c.mode = 'IE' THEN 0.0
     WHEN prior_incentive IS NULL THEN 0.0 WHEN bid_reason = 'RETENTION' THEN prior_incentive - prior_slack ELSE prior_incentive END,
   CASE WHEN market_inc IS NULL THEN 0.0 ELSE l_market * market_inc END, t.floor] AS lows
FROM s_ceiling c JOIN t_settings t ON t.mode = c.mode"""
CTES["s_bounds"] = """
SELECT * EXCLUDE (highs, lows, ub, lb), lb < ub AS feasible,
  CASE WHEN lb < ub THEN ['u_MktPR', 'u_Incentive', 'u_MktInc', 'u_Ceiling'][list_position(highs, -ub)] ELSE 'Resetinfeasible' END AS upper_name,
  CASE WHEN lb < ub THEN ['l_MktPR', 'l_Prior', 'l_MktInc', 'l_Floor'][list_position(lows, lb)] ELSE 'Resetinfeasible' END AS lower_name,
  CASE WHEN lb < ub THEN lb ELSE l_floor + 0.001 END AS lower,
  CASE WHEN lb < ub THEN CASE WHEN abs(ub - 1.0) < 0.000001 THEN 0.999 ELSE ub END ELSE 0.999 END AS upper
FROM (SELECT *, -list_max(highs) AS ub, list_max(lows) AS lb FROM s_limits)"""


def obj(x: str) -> dict[str, str]:
    pt = f"(1.0 / (1.0 + exp(-alpha - gamma * ln(CASE WHEN (1.0 - ({x})) / nullif(1.0 - market_inc, 0) > 0 THEN (1.0 - ({x})) / nullif(1.0 - market_inc, 0) END))))"
    profit = f"((list_rev * (1.0 - ({x})) - marg_cost) * {pt})"
    total = f"({profit} - price_discipline / nullif(1.0 - price_discipline, 0) * list_rev * (({x}) - market_inc) * (({x}) - market_inc) + volume_weight * ({pt} * list_rev - {profit}))"
    return {"pt": pt, "profit": profit, "total": total}


S, R = catalog.LADDER_STRICT, {}
R12, R23, R13 = S[("1DA", "2DA")], S[("2DA", "3DA")], S[("1DA", "3DA")]
CTES["s_caps"] = f"""
SELECT *, CASE product
    WHEN '1DA' THEN CASE WHEN u2 IS NOT NULL THEN least(upper, {R12} * cap2 + (1.0 - {R12})) WHEN u3 IS NOT NULL THEN least(upper, {R13} * u3 + (1.0 - {R13})) ELSE upper END
    WHEN '2DA' THEN cap2 ELSE upper END AS cap
FROM (SELECT *, CASE WHEN u3 IS NOT NULL THEN least(u2, {R23} * u3 + (1.0 - {R23})) ELSE u2 END AS cap2 FROM (
  SELECT *, max(CASE WHEN product = '1DA' THEN upper END) OVER w AS u1, max(CASE WHEN product = '2DA' THEN upper END) OVER w AS u2,
    max(CASE WHEN product = '3DA' THEN upper END) OVER w AS u3 FROM s_bounds WINDOW w AS (PARTITION BY bid_id)))"""


POINTS = 200


def grid(points: int, source: str) -> str:
    x = f"lower + (cap - lower) * k / {points}.0::DOUBLE"
    return f"SELECT bid_id, product, mode, k, {x} AS x, {obj(f'({x})')['total']} AS v FROM {source}, range(0, {points + 1}) AS r(k)"


# --- search: every point of every product; along the ladder, each point joins the best point below its limit ---
CTES["s_members"] = f"""
SELECT *, min(CASE WHEN cap > lower THEN 1 ELSE 0 END) OVER m = 1 AS valid, {obj('lower')['total']} IS NOT NULL AS known,
  product IN ('1DA', '2DA', '3DA') AND members >= 2 AS laddered,
  CASE product WHEN '1DA' THEN 1 WHEN '2DA' THEN CASE WHEN u1 IS NOT NULL THEN 2 ELSE 1 END WHEN '3DA' THEN members END AS rank,
  CASE product WHEN '2DA' THEN CASE WHEN u1 IS NOT NULL THEN {R12} END WHEN '3DA' THEN CASE WHEN u2 IS NOT NULL THEN {R23} ELSE {R13} END END AS ratio
FROM (SELECT *, (u1 IS NOT NULL)::INT + (u2 IS NOT NULL)::INT + (u3 IS NOT NULL)::INT AS members FROM s_caps) WINDOW m AS (PARTITION BY bid_id, mode)"""
CTES["s_searched"] = "SELECT * FROM (SELECT *, bool_and(known) OVER (PARTITION BY bid_id, mode, laddered) AS all_known FROM s_members) WHERE valid AND price_discipline <> 1 AND CASE WHEN laddered THEN all_known ELSE known END"
CTES["s_grid"] = grid(POINTS, "s_searched")
CTES["s_ladder"] = "SELECT g.bid_id, g.product, k, x, v, rank, members, ratio FROM s_grid g JOIN s_searched s ON s.bid_id = g.bid_id AND s.product = g.product WHERE laddered"


def _running(source: str) -> str:
    """Largest value up to each point, and the last point that has it."""
    w = "(PARTITION BY bid_id ORDER BY k ROWS UNBOUNDED PRECEDING)"
    return f"SELECT bid_id, x, m, max(CASE WHEN v = m THEN k END) OVER {w} AS best FROM (SELECT *, max(v) OVER {w} AS m FROM {source})"


def _joined(rank: int, below: str) -> str:
    """Each point of a rank with the best point below its limit; best values only grow with the position."""
    points = f"""SELECT bid_id, x AS place, 0 AS asks, m, best, NULL AS k, NULL AS x, NULL AS members, NULL AS v FROM {below}
    UNION ALL SELECT bid_id, ratio * x + (1.0 - ratio) + 1e-9, 1, NULL, NULL, k, x, members, v FROM s_ladder WHERE rank = {rank}"""
    return f"""SELECT bid_id, k, x, members, v + m AS v, best FROM (
  SELECT * REPLACE (max(m) OVER w AS m, max(best) OVER w AS best) FROM ({points}) WINDOW w AS (PARTITION BY bid_id ORDER BY place, asks ROWS UNBOUNDED PRECEDING)) WHERE asks = 1 AND m IS NOT NULL"""


CTES["s_run1"] = _running("(SELECT * FROM s_ladder WHERE rank = 1)")
CTES["s_two"] = _joined(2, "s_run1")
CTES["s_run2"] = _running("s_two")
CTES["s_three"] = _joined(3, "s_run2")
CTES["s_chained"] = """
SELECT bid_id, [best, k] AS ks FROM s_two WHERE members = 2 QUALIFY row_number() OVER (PARTITION BY bid_id ORDER BY v DESC, k DESC) = 1
UNION ALL SELECT h.bid_id, [t.best, t.k, h.k] FROM (SELECT * FROM s_three QUALIFY row_number() OVER (PARTITION BY bid_id ORDER BY v DESC, k DESC) = 1) h JOIN s_two t ON t.bid_id = h.bid_id AND t.k = h.best"""
CTES["s_alone"] = "SELECT g.bid_id, g.product, arg_max(k, (v, k)) AS k FROM s_grid g JOIN s_searched s ON s.bid_id = g.bid_id AND s.product = g.product WHERE NOT laddered GROUP BY 1, 2"
CTES["s_optimum"] = f"""
SELECT *, CASE WHEN best_k IS NOT NULL AND feasible THEN lower + (cap - lower) * best_k / {POINTS}.0::DOUBLE WHEN market_inc IS NOT NULL THEN least(greatest(market_inc, l_floor), ceiling) END AS optimal_inc,
  CASE WHEN price_discipline = 1 THEN 0 WHEN NOT valid THEN 1 WHEN best_k IS NULL THEN -1 ELSE 0 END AS flag
FROM (SELECT m.*, CASE WHEN m.laddered THEN c.ks[m.rank] ELSE a.k END AS best_k FROM s_members m
  LEFT JOIN s_alone a ON a.bid_id = m.bid_id AND a.product = m.product LEFT JOIN s_chained c ON c.bid_id = m.bid_id)"""

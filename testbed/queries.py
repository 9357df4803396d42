"""Registered queries: name -> (Spark plan, check SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline import catalog
from tenderline.functions.objective import objective
from tenderline.functions.scalars import composite_key, logit, weight_band
from tenderline.operators import aggregates as A, joins as J, reshape as H, shares as W
from tenderline.plans import bounds, industry, optimise, post, profile, publish, score, segments, summary, tables
from tenderline.session import materialise, run_folder
from tenderline.sources import contracts, readers, weights
from testbed import formulas, sql as S
from testbed.tables import Tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[Query, str | None]] = {}


def query(check: str | None = None):
    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        REGISTRY[fn.__name__] = (lambda spark, sf_dir: fn(Tables(spark, sf_dir)), None if check is None else S.with_tables(check))
        return fn

    return register


# --- building blocks ------------------------------------------------------------------
def headers(t: Tables) -> DataFrame:
    return tables.bid_headers(t.bids, t.shippers, t.shipper_volumes)


def product_lines(t: Tables) -> DataFrame:
    lines = tables.bid_lines(t.service_groups, t.target_prices, t.shipper_volumes, t.surcharge_services)
    return tables.with_products(lines, t.service_products)


def package_weights(t: Tables) -> DataFrame:
    return weights.package_weights(t.raw_zone_weights)


def by_band(t: Tables, as_coded: bool = False) -> DataFrame:
    return profile.products_by_band(package_weights(t), t.service_groups, t.service_products, as_coded)


def weight_profile(t: Tables) -> DataFrame:
    return profile.zone_weight_profile(package_weights(t), t.service_groups, t.service_products)


def products(t: Tables) -> DataFrame:
    return summary.product_summary(product_lines(t))


def features(t: Tables, with_profile: bool = False) -> DataFrame:
    return summary.feature_table(product_lines(t), headers(t), weight_profile(t) if with_profile else None)


def bounded(t: Tables) -> DataFrame:
    return score.bounded_rows(features(t), formulas.respond, t.bands)


def best(t: Tables) -> DataFrame:
    """Bounded rows with their optimum; read once, so nothing is written."""
    return optimise.optimise(bounded(t))


#: What gap, offer, target range and surcharges read of the optimum.
QUOTED = ["bid_id", "product", "mode", "optimal_inc", "list_rev", "bid_list_rev", "gross_cost_ratio", "marg_cost", "ceiling", "prior_incentive"]


def optimal(t: Tables) -> DataFrame:
    """The optimum with the columns that quotes read; written once, as product and surcharge rows branch from it."""
    return materialise(best(t).select(*QUOTED), "optimum")


def calibration(t: Tables) -> DataFrame:
    """Past bids with labels, written once, as the column means and several fits read it; then imputed."""
    from tenderline.models import preprocess

    rows = materialise(formulas.calibration_rows(features(t)), "calibration")
    return preprocess.preprocess(rows, preprocess.fit_imputer(rows, NUMERIC))


NUMERIC = ["list_rev", "gross_cost_ratio", "comp_incentive", "product_share", "prior_incentive"]
TEXTUAL = ["product", "bid_reason"]


def text_dates(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("string") for n in names})


# --- sources ----------------------------------------------------------------------------
@query("SELECT bid_id, svc_group, zone, unit, weight, packages FROM t_weights")
def package_weights_in_pounds(t):
    return package_weights(t)


@query("SELECT DISTINCT p.bid_id, p.svc_group, recommended, low, high, direction, svc_type, feature FROM t_prior p JOIN t_ceiling USING (bid_id, svc_group) JOIN t_groups USING (bid_id, svc_group)")
def prior_results_with_services(t):
    return weights.prior_results_with_services(t.prior_results, t.ceiling_services, t.service_groups)


@query("SELECT g.bid_id, svc_group, list_pp, volume FROM t_groups g WHERE bid_id IN (SELECT bid_id FROM t_bids WHERE status = 'P')")
def lines_of_wanted_bids(t):
    wanted = t.bids.where("status = 'P'")
    return readers.read_bids({"service_groups": t.service_groups}, wanted)["service_groups"].select("bid_id", "svc_group", "list_pp", "volume")


@query("""SELECT bid_id, source FROM (SELECT bid_id, 'ceiling_services' AS source FROM t_bids WHERE bid_id NOT IN (SELECT bid_id FROM t_ceiling)
  UNION ALL SELECT bid_id, 'surcharge_services' FROM t_bids WHERE bid_id NOT IN (SELECT bid_id FROM t_surcharge)
  UNION ALL SELECT bid_id, 'shipper_volumes' FROM t_bids WHERE bid_id NOT IN (SELECT bid_id FROM t_volumes))""")
def bids_without_source_rows(t):
    sources = {"ceiling_services": t.ceiling_services, "surcharge_services": t.surcharge_services, "shipper_volumes": t.shipper_volumes}
    return contracts.source_counts(sources, t.bids).where("rows = 0").select("bid_id", "source")


@query("SELECT 'proposed_date' AS \"column\", 'bids' AS lookup, 'missing values' AS problem WHERE (SELECT count(*) FROM t_bids WHERE proposed_date IS NULL) > 0")
def lookup_violations(t):
    return contracts.check_lookup(t.bids, "bids")


@query("SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INT)::DOUBLE AS k, TRY_CAST(event_type AS DOUBLE) AS event_type, CAST(value AS VARCHAR) IS NOT NULL AS has_value FROM events")
def recast_by_dictionary(t):
    raw = t.raw("events").select("event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", F.col("value").isNotNull().alias("has_value"))
    return readers.recast(raw, {"k": "int", "event_type": "double"}).withColumn("k", F.col("k").cast("double"))


# --- bid tables --------------------------------------------------------------------------
@query("SELECT bid_id, status, CAST(status_date AS VARCHAR) AS status_date, category, region, district, reason_code, lead_account FROM p_headers")
def bid_headers(t):
    return text_dates(headers(t), "status_date").select("bid_id", "status", "status_date", "category", "region", "district", "reason_code", "lead_account")


@query("SELECT bid_id, min(account) AS lead_account FROM t_volumes GROUP BY 1")
def lead_accounts_as_coded(t):
    return tables.lead_accounts(t.shipper_volumes, as_coded=True)


@query("SELECT bid_id, svc_group, comp_est_pp, target_pp, target_low_pp, target_high_pp FROM p_latest")
def latest_target_prices(t):
    return tables.latest_targets(t.target_prices)


@query("SELECT bid_id, svc_group, factor, count(*) AS n FROM t_targets t WHERE factor = (SELECT max(factor) FROM t_targets u WHERE u.bid_id = t.bid_id) GROUP BY ALL")
def rows_at_largest_factor(t):
    return A.rows_at_top(t.target_prices, ["bid_id"], "factor").groupBy("bid_id", "svc_group", "factor").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT bid_id, svc_group, prior_gross, prior_net, tier FROM p_rollup")
def prior_revenue_and_tier(t):
    return tables.shipper_rollup(t.shipper_volumes)


LINE_COLUMNS = ["bid_id", "svc_group", "direction", "svc_type", "feature", "competitor", "volume", "list_pp", "comp_net_pp", "prior_gross_rev", "prior_net_rev", "target_low_pp", "target_high_pp", "tier"]


@query(f"SELECT {', '.join(LINE_COLUMNS)} FROM p_lines")
def bid_lines(t):
    return tables.bid_lines(t.service_groups, t.target_prices, t.shipper_volumes, t.surcharge_services).select(*LINE_COLUMNS)


@query("SELECT p.bid_id, p.svc_group, list_pp, v.tier FROM p_lines p LEFT JOIN t_volumes v USING (bid_id, svc_group)")
def bid_lines_as_coded(t):
    lines = tables.bid_lines(t.service_groups, t.target_prices, t.shipper_volumes, t.surcharge_services, as_coded=True)
    return lines.select("bid_id", "svc_group", "list_pp", "tier")


@query("SELECT bid_id, svc_group, product, competitor FROM p_product_lines")
def lines_with_products(t):
    return product_lines(t).select("bid_id", "svc_group", "product", "competitor")


@query("""SELECT bid_id, proposed_lag::DOUBLE AS proposed_lag, status_updated, proposal_flag, win_flag, win_flag_updated, reason, weeks_since_init, month_of_bid::INT AS month_of_bid,
  CAST(proposed_date AS VARCHAR) AS proposed_date FROM p_bids""")
def cleaned_bids(t):
    rows = tables.clean_bids(headers(t)).withColumn("proposed_lag", F.col("proposed_lag").cast("double"))
    return text_dates(rows, "proposed_date").select("bid_id", "proposed_lag", "status_updated", "proposal_flag", "win_flag", "win_flag_updated", "reason", "weeks_since_init", "month_of_bid", "proposed_date")


# --- profile -------------------------------------------------------------------------------
@query("SELECT bid_id, product, zone, round(zone_pct, 9) AS zone_pct FROM p_zone_shares")
def zone_shares(t):
    return profile.zone_shares(by_band(t)).select("bid_id", "product", "zone", F.round("zone_pct", 9).alias("zone_pct"))


@query("SELECT bid_id, product, band, band_pct FROM p_band_shares")
def weight_band_shares(t):
    return profile.band_shares(by_band(t)).select("bid_id", "product", "band", "band_pct")


@query("SELECT bid_id, product, band, sum(packages) AS packages FROM p_packed_as_coded WHERE band IS NOT NULL GROUP BY ALL")
def weight_bands_as_coded(t):
    return by_band(t, True).where("band IS NOT NULL").groupBy("bid_id", "product", "band").agg(F.sum("packages").alias("packages"))


@query("SELECT * FROM p_profile")
def zone_weight_profile(t):
    rows = weight_profile(t)
    return rows.withColumns({f"{z}_pct": F.round(f"{z}_pct", 9) for z in catalog.ZONES})


@query("SELECT bid_id, product, " + ", ".join(f"\"{z}_pct\"" for z in catalog.ZONES) + " FROM (SELECT bid_id, product, " + ", ".join(
    f"round(coalesce(sum(zone_pct) FILTER (zone = '{z}'), 0.0), 9) AS \"{z}_pct\"" for z in catalog.ZONES) + " FROM p_zone_shares GROUP BY 1, 2)")
def zones_spread(t):
    rows = profile.zone_profile(by_band(t))
    return rows.withColumns({f"{z}_pct": F.round(f"{z}_pct", 9) for z in catalog.ZONES})


@query("SELECT bid_id, product, " + ", ".join(f"coalesce(sum(band_pct) FILTER (band = '{b}'), 0.0) AS \"{b}_pct\"" for b in catalog.WEIGHT_LABELS) + " FROM p_band_shares GROUP BY 1, 2")
def weight_bands_spread(t):
    return profile.band_profile(by_band(t))


# --- summaries ---------------------------------------------------------------------------------
PRODUCT_COLUMNS = [
    "bid_id", "product", *S.WEEKLY, "watched_share", "prior_incentive", "new_volume_share", "gross_cost_ratio", "freight_share",
    "mostly_watched", "mostly_third_party", "target_high_inc", "target_low_inc", "density", "comp_incentive", "comp_keyed_flag",
    "comp_keyed_incentive", "major_competitor", "tier", "bid_list_rev", "ground_list_rev", "air_list_rev", "trade_list_rev",
    "product_share", "family_share", "mode", "bid_product",
]


@query(f"SELECT {', '.join(PRODUCT_COLUMNS)}, round(freight_share_centred, 9) AS freight_share_centred FROM p_products")
def product_summary(t):
    return products(t).select(*PRODUCT_COLUMNS, F.round("freight_share_centred", 9).alias("freight_share_centred"))


@query(f"""SELECT bid_id, product, round(freight_share - (SELECT avg(freight_share) FROM p_products), 9) AS freight_share_centred,
  list_rev / nullif(CASE WHEN product IN {S.GROUND} THEN ground_list_rev WHEN product IN {S.AIR} THEN air_list_rev ELSE trade_list_rev END, 0) AS family_share FROM p_products""")
def product_summary_as_coded(t):
    lines = product_lines(t)
    return summary.product_summary(lines, as_coded=True).select("bid_id", "product", F.round("freight_share_centred", 9).alias("freight_share_centred"), "family_share")


@query("SELECT bid_id, product, major_competitor, tier, list_rev, watched_rev FROM p_sums")
def open_competitor_ranking(t):
    return summary.product_sums(product_lines(t), any_competitor=True).select("bid_id", "product", "major_competitor", "tier", "list_rev", "watched_rev")


BID_COLUMNS = [
    "bid_id", *S.BID_SUMS, "watched_share", "prior_incentive", "new_volume_share", "gross_cost_ratio", "freight_share", "mostly_watched",
    "mostly_third_party", "major_competitor", "volume_reason", "ground_centric", "air_centric", "residential_centric", "trade_centric",
    "keyed_flag", "keyed_higher", "keyed_lower", "below_200",
]
BID_ROUNDED = ["ground_share", "air_share", "residential_share", "trade_share", "air_heavy_share", "ground_heavy_share", "concentration"]


@query(f"SELECT {', '.join('s.' + c for c in BID_COLUMNS)}, {', '.join(f'round({c}, 9) AS {c}' for c in BID_ROUNDED)}, status, reason FROM p_bid_summary s LEFT JOIN p_bids USING (bid_id)")
def bid_summary(t):
    rows = summary.bid_summary(products(t), headers(t))
    return rows.select(*BID_COLUMNS, *[F.round(c, 9).alias(c) for c in BID_ROUNDED], "status", "reason")


FEATURE_COLUMNS = ["bid_id", "product", "mode", "list_rev", "prior_incentive", "product_share", "bid_list_rev", "bid_trade_centric", "bid_volume_reason", "bid_major_competitor", "bid_prior_incentive", "bid_gross_cost_ratio", "bid_reason", "bid_region", "bid_district", "bid_category", "bid_weeks_since_init"]


@query(f"""SELECT {', '.join('f.' + c for c in FEATURE_COLUMNS)}, round(bid_concentration, 9) AS bid_concentration, "6_10_lbs_pct", "46_pct", 1.0::DOUBLE AS overall_incentive, '1' AS bid_history_count
  FROM p_features f LEFT JOIN p_profile USING (bid_id, product)""")
def feature_table(t):
    rows = features(t, with_profile=True)
    return rows.select(*FEATURE_COLUMNS, F.round("bid_concentration", 9).alias("bid_concentration"), "6_10_lbs_pct", F.round("46_pct", 9).alias("46_pct"), "overall_incentive", "bid_history_count")


@query("SELECT mode, count(*) AS n, round(sum(list_rev), 6) AS list_rev, mode IN ('AIR', 'GND', 'IE') AS priced, mode IN ('AIR_CWT', 'GND_CWT') AS heavy FROM p_products GROUP BY 1")
def rows_by_mode(t):
    return products(t).groupBy("mode").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("list_rev"), 6).alias("list_rev")).select(
        "mode", "n", "list_rev", F.col("mode").isin(catalog.PRICED_MODES).alias("priced"), F.col("mode").isin(catalog.HEAVY_MODES).alias("heavy"))


@query("SELECT bid_product, CAST(ntile(3) OVER (ORDER BY bid_product) - 1 AS INT) AS fold FROM p_products")
def contiguous_folds(t):
    return W.contiguous_folds(products(t).select("bid_product"), ["bid_product"])


@query("""SELECT bid_id, arg_min(tier, (svc_group, qty, account, tier)) AS tier, min(account) FILTER (account IS NOT NULL) AS account FROM (SELECT * FROM t_volumes) GROUP BY 1""")
def first_known_values(t):
    ordered = t.shipper_volumes.withColumn("at", F.struct("svc_group", "qty", "account", "tier"))
    first = A.first_known(ordered, ["bid_id"], ["tier"], "at")
    return first.join(ordered.groupBy("bid_id").agg(F.min("account").alias("account")), "bid_id")


@query("SELECT avg(prior_incentive) AS prior_incentive, avg(target_high_inc) AS target_high_inc FROM (SELECT round(prior_incentive, 6) AS prior_incentive, round(target_high_inc, 6) AS target_high_inc FROM p_products)".replace("SELECT avg(prior_incentive) AS prior_incentive, avg(target_high_inc) AS target_high_inc", "SELECT round(avg(prior_incentive), 6) AS prior_incentive, round(avg(target_high_inc), 6) AS target_high_inc"))
def column_means(t):
    rows = products(t).select(F.round("prior_incentive", 6).alias("prior_incentive"), F.round("target_high_inc", 6).alias("target_high_inc"))
    return A.column_means(rows, rows.columns).select(*[F.round(c, 6).alias(c) for c in rows.columns])


@query("""SELECT bid_id, round(coalesce(CASE WHEN watched_share = 0 THEN ln(0.0001 / (1.0 - 0.0001)) WHEN watched_share = 1 THEN ln(0.9999 / (1.0 - 0.9999)) ELSE ln(watched_share / (1.0 - watched_share)) END, 0), 6) AS base_logit,
  bid_id || '_' || product AS key FROM p_products""")
def logit_of_shares(t):
    return products(t).select("bid_id", F.round(F.coalesce(logit(F.col("watched_share")), F.lit(0.0)), 6).alias("base_logit"), composite_key(F.col("bid_id"), F.col("product")).alias("key"))


WIDE = (list(catalog.PRODUCT_MODES), {"list_rev": None, "major_competitor": ["FedEx", "Other"]}, {"bid_list_rev": None, "bid_reason": ["CONVERSION", "RETENTION"]})


@query("SELECT bid_id, " + ", ".join(
    f"coalesce(max(CASE WHEN product = '{p}' THEN list_rev END), -1000.0) AS \"list_rev_{p}\", "
    + ", ".join(f"coalesce(max(CASE WHEN product = '{p}' THEN CASE WHEN major_competitor = '{c}' THEN 1.0::DOUBLE ELSE 0.0 END END), -1000.0) AS \"major_competitor_{c}_{p}\"" for c in ("FedEx", "Other"))
    for p in WIDE[0]) + ", max(bid_list_rev) AS \"bid_list_rev_ALL\", " + ", ".join(
    f"max(CASE WHEN bid_reason = '{r}' THEN 1.0::DOUBLE ELSE 0.0 END) AS \"bid_reason_{r}_ALL\"" for r in ("CONVERSION", "RETENTION")) + " FROM p_features GROUP BY 1")
def wide_bid_matrix(t):
    return H.wide_by_product(features(t), *WIDE)


@query("SELECT bid_product, CASE WHEN mode = 'AIR' THEN 1.0::DOUBLE ELSE 0.0 END AS \"mode_AIR\", CASE WHEN mode = 'IE' THEN 1.0::DOUBLE ELSE 0.0 END AS \"mode_IE\" FROM p_products")
def indicator_columns(t):
    return products(t).select("bid_product", *H.indicator_columns("mode", ["AIR", "IE"]))


@query("""SELECT bid_id, name, CASE WHEN name = 'list_rev' THEN list_rev ELSE marg_cost END AS value FROM (SELECT bid_id, list_rev, marg_cost FROM p_bid_summary), (VALUES ('list_rev'), ('marg_cost')) AS n(name)""")
def gathered_columns(t):
    return H.gather(summary.bid_summary(products(t)), ["bid_id"], ["list_rev", "marg_cost"], "name", "value")


@query("SELECT bid_id, status FROM t_bids ORDER BY bid_id LIMIT 5")
def first_bids(t):
    return t.bids.select("bid_id", "status").orderBy("bid_id").limit(5)


@query("SELECT bid_id, account, CAST(row_number() OVER (PARTITION BY bid_id ORDER BY account DESC) AS INT) AS place FROM t_shippers")
def shippers_in_order(t):
    from pyspark.sql import Window

    rows = t.shippers.select("bid_id", "account")
    return rows.withColumn("place", F.row_number().over(Window.partitionBy("bid_id").orderBy(F.desc("account")))).orderBy("bid_id", F.desc("account"))


# --- bounds and response ---------------------------------------------------------------------
@query("SELECT f.bid_id, f.product, b.ceiling FROM p_features f JOIN t_bands b ON b.product = f.product AND f.bid_list_rev > b.min_rev AND f.bid_list_rev <= b.max_rev")
def revenue_ceilings(t):
    return bounds.add_ceiling(products(t), t.bands).select("bid_id", "product", "ceiling")


@query("SELECT f.bid_id, f.product, b.ceiling FROM p_products f JOIN t_bands b ON b.product = f.product AND f.bid_list_rev > b.min_rev AND f.bid_list_rev < b.max_rev")
def revenue_ceilings_without_broadcast(t):
    rows = J.range_lookup(products(t), t.bands, ["product"], "bid_list_rev", "min_rev", "max_rev", "none", limit=0)
    return rows.select("bid_id", "product", "ceiling")


@query("SELECT bid_id, product, round(alpha, 9) AS alpha, round(gamma, 9) AS gamma FROM s_response")
def response_terms(t):
    return formulas.respond(score.priced_rows(features(t))).select("bid_id", "product", F.round("alpha", 9).alias("alpha"), F.round("gamma", 9).alias("gamma"))


@query("SELECT bid_id, product, round(lower, 9) AS lower, round(upper, 9) AS upper, lower_name, upper_name, feasible FROM s_bounds")
def binding_bounds(t):
    return bounded(t).select("bid_id", "product", F.round("lower", 9).alias("lower"), F.round("upper", 9).alias("upper"), "lower_name", "upper_name", "feasible")


@query("SELECT bid_id, mode, string_agg(product, ',' ORDER BY product) AS products, string_agg(CAST(CAST(floor(lower * 1000) AS INT) AS VARCHAR), ',' ORDER BY product) AS lowers FROM s_bounds GROUP BY 1, 2")
def bounds_as_lists(t):
    lists = bounds.bound_lists(bounded(t))
    thousandths = F.transform("lowers", lambda v: F.floor(v * 1000).cast("int").cast("string"))
    return lists.select("bid_id", "mode", F.array_join("products", ",").alias("products"), F.array_join(thousandths, ",").alias("lowers"))


_AT_LOWER = S.obj("lower")


@query(f"""SELECT bid_id, product, round({_AT_LOWER['pt']}, 6) AS pull_through, round({_AT_LOWER['profit']}, 6) AS profit, round({_AT_LOWER['total']}, 6) AS total FROM s_bounds""")
def objective_terms(t):
    terms = objective("lower")
    return bounded(t).select("bid_id", "product", F.round(terms.pull_through, 6).alias("pull_through"), F.round(terms.profit, 6).alias("profit"), F.round(terms.total, 6).alias("total"))


@query(f"SELECT bid_id, mode, round(sum({_AT_LOWER['total']}) / nullif(sum(list_rev), 0), 6) AS objective, round(sum({_AT_LOWER['profit']}), 5) AS profit FROM s_bounds GROUP BY 1, 2")
def objective_per_group(t):
    rows = optimise.group_objective(bounded(t), "lower")
    return rows.select("bid_id", "mode", F.round("objective", 6).alias("objective"), F.round("profit", 5).alias("profit"))


# --- search -------------------------------------------------------------------------------------
@query(f"""SELECT bid_id, product, mode, round(optimal_inc, 6) AS optimal_inc, flag, CASE WHEN upper - optimal_inc < 1e-5 THEN 1 ELSE 0 END AS upper_binds,
  CASE WHEN optimal_inc - lower < 1e-5 THEN 1 ELSE 0 END AS lower_binds, CAST(sum(binds) OVER (PARTITION BY bid_id, mode) AS INT) AS ladder_binds,
  round({S.obj('optimal_inc')['profit']}, 4) AS optimal_profit, round({S.obj('coalesce(prior_incentive, 0.1)')['profit']}, 4) AS current_profit
FROM (SELECT *, CASE WHEN rank > 1 AND laddered AND ratio * optimal_inc + (1.0 - ratio) - lag(optimal_inc) OVER w < greatest((lag(cap) OVER w - lag(lower) OVER w) / {S.POINTS}.0, 1e-5)
  THEN CASE rank WHEN 2 THEN 1 ELSE 10 END ELSE 0 END AS binds FROM s_optimum WINDOW w AS (PARTITION BY bid_id, mode ORDER BY rank))""")
def optimum_with_flags(t):
    rows = features(t).withColumn("current_inc", F.coalesce("prior_incentive", F.lit(0.1)))
    best = optimise.optimise(score.bounded_rows(rows, formulas.respond, t.bands), current="current_inc")
    return best.select("bid_id", "product", "mode", F.round("optimal_inc", 6).alias("optimal_inc"), "flag", "upper_binds", "lower_binds", "ladder_binds",
                       F.round("optimal_profit", 4).alias("optimal_profit"), F.round("current_profit", 4).alias("current_profit"))


@query("SELECT bid_id, product, round(optimal_inc, 6) AS optimal_inc FROM s_optimum WHERE NOT laddered")
def optimum_of_single_products(t):
    return optimise.optimise(bounded(t)).where("NOT laddered").select("bid_id", "product", F.round("optimal_inc", 6).alias("optimal_inc"))


def _with_gaps(t: Tables) -> DataFrame:
    """Bounded rows, some of them without a cost or a response."""
    digit = F.right("bid_id", F.lit(1))
    rows = bounded(t).withColumn("marg_cost", F.when(~((digit == "3") & (F.col("product") == "2DA")), F.col("marg_cost")))
    return rows.withColumn("gamma", F.when(~((digit == "5") & (F.col("mode") == "GND")), F.col("gamma")))


_GAPS = S.with_tables("SELECT bid_id, product, round(optimal_inc, 6) AS optimal_inc, flag FROM s_optimum").replace(" FROM s_bounds WINDOW w AS", """ FROM (SELECT * REPLACE (
  CASE WHEN NOT (right(bid_id, 1) = '3' AND product = '2DA') THEN marg_cost END AS marg_cost, CASE WHEN NOT (right(bid_id, 1) = '5' AND mode = 'GND') THEN gamma END AS gamma) FROM s_bounds) WINDOW w AS""")


def optimum_with_unknown_values(t: Tables) -> DataFrame:
    return optimise.optimise(_with_gaps(t)).select("bid_id", "product", F.round("optimal_inc", 6).alias("optimal_inc"), "flag")


REGISTRY["optimum_with_unknown_values"] = (lambda spark, d: optimum_with_unknown_values(Tables(spark, d)), _GAPS)


_SCENARIOS = [(0, 0.0, 0.0), (1, 0.0, 0.5), (2, 0.0, 1.0), (3, 0.5, 0.0), (4, 0.5, 0.5), (5, 0.5, 1.0), (6, 1.0, 0.0)]
_SCENARIO_OBJ = S.obj("x")["total"]


@query(f"""SELECT scenario, bid_id, product, round(coalesce(CASE WHEN price_discipline <> 1 AND feasible THEN arg_max(x, (v, k)) FILTER (WHERE v IS NOT NULL) END,
    CASE WHEN market_inc IS NOT NULL THEN least(greatest(market_inc, l_floor), ceiling) END), 6) AS optimal_inc
FROM (SELECT *, {_SCENARIO_OBJ} AS v FROM (
  SELECT c.* EXCLUDE (price_discipline, volume_weight), z.scenario, z.price_discipline, z.volume_weight, k, lower + (upper - lower) * k / 200.0::DOUBLE AS x
  FROM s_bounds c, ({S.values(_SCENARIOS, 'scenario, price_discipline, volume_weight')}) z, range(0, 201) AS r(k) WHERE mode = 'IE'))
GROUP BY scenario, bid_id, product, price_discipline, feasible, market_inc, l_floor, ceiling""")
def weight_scenarios(t):
    scenarios = optimise.weight_scenarios(t.spark, 0.0, 1.0, 0.5, 0.0, 1.0, 0.5)
    best = score.scan_scenarios(features(t), formulas.respond, t.bands, scenarios, "IE")
    return best.select("scenario", "bid_id", "product", F.round("optimal_inc", 6).alias("optimal_inc"))


# --- after the search ---------------------------------------------------------------------------
_SWEPT = S.obj("x")
_SWEEP = f"""sweep AS (SELECT bid_id, product, mode, step, x, {_SWEPT['pt']} AS pt, {_SWEPT['profit']} AS profit, {_SWEPT['total']} AS total, list_rev
  FROM (SELECT *, optimal_inc + step / 100.0::DOUBLE AS x FROM s_optimum, range(-20, 21) AS r(step)))"""


def _sweep_check(tail: str) -> str:
    return S.with_tables("SELECT 1 FROM s_optimum").rsplit("\n", 1)[0] + ",\n" + _SWEEP + "\n" + tail


def what_if_sweep(t):
    rows = post.labelled_steps(post.sweep(best(t)))
    return rows.select("bid_id", "product", "step", "step_label", *[F.round(c, 5).alias(c) for c in ("swept_inc", "objective", "pull_through", "profit", "net_rev")])


REGISTRY["what_if_sweep"] = (lambda spark, d: what_if_sweep(Tables(spark, d)), _sweep_check("""
SELECT bid_id, product, CAST(step AS INT) AS step, CASE WHEN step = 0 THEN '0' ELSE printf('%.2f', step / 100.0) END AS step_label, round(x, 5) AS swept_inc,
  round(sum(total) OVER w / nullif(sum(list_rev) OVER w, 0), 5) AS objective, round(pt, 5) AS pull_through, round(sum(profit) OVER w, 5) AS profit, round(pt * list_rev * (1.0 - x), 5) AS net_rev
FROM sweep WINDOW w AS (PARTITION BY bid_id, mode, step)"""))


def sweep_side_by_side(t):
    wide = post.sweep_wide(post.sweep(best(t)))
    return wide.select("bid_id", "product", *[F.round(f"`{name}`", 5).alias(name.replace("-", "m").replace(".", "_")) for metric, name, _ in post.sweep_columns()])


REGISTRY["sweep_side_by_side"] = (lambda spark, d: sweep_side_by_side(Tables(spark, d)), _sweep_check(
    "SELECT bid_id, product, " + ", ".join(
        f"round(max(CASE WHEN step = {step} THEN {dict(swept_inc='x', objective='o', profit='p', pull_through='pt', net_rev='pt * list_rev * (1.0 - x)')[metric]} END), 5) AS \"{name.replace('-', 'm').replace('.', '_')}\""
        for metric, name, step in post.sweep_columns())
    + " FROM (SELECT *, sum(total) OVER w / nullif(sum(list_rev) OVER w, 0) AS o, sum(profit) OVER w AS p FROM sweep WINDOW w AS (PARTITION BY bid_id, mode, step)) GROUP BY 1, 2"))


S.CTES["s_offered"] = """SELECT *, CASE WHEN overall_incentive IS NOT NULL THEN greatest(least(overall_incentive - gap, 0.70), 0.05) END AS freight_incentive FROM (
  SELECT *, optimal_inc AS overall_incentive, greatest(least(0.05 - 0.5 * gross_cost_ratio, 0.0), -0.2) AS gap, sum(optimal_inc * list_rev) OVER (PARTITION BY bid_id) / nullif(bid_list_rev, 0) AS bid_overall_incentive FROM s_optimum)"""


def offered_rows(rows: DataFrame) -> DataFrame:
    return post.offered(formulas.gap(post.bid_incentive(rows)))


@query(f"SELECT bid_id, product, round(bid_overall_incentive, 9) AS bid_overall_incentive, round(gap, 9) AS gap, round(freight_incentive, 9) AS freight_incentive FROM s_offered")
def offered_incentives(t):
    return offered_rows(best(t)).select("bid_id", "product", *[F.round(c, 9).alias(c) for c in ("bid_overall_incentive", "gap", "freight_incentive")])


S.CTES["s_targets"] = f"""SELECT *, freight_incentive + 0.01 AS target_high, CASE WHEN freight_incentive >= 0.05 THEN freight_incentive - 0.05 ELSE 0.0 END AS target_low,
  least(ceiling, greatest(freight_incentive + 0.01, least(1.0 - marg_cost / nullif(0.95 * list_rev, 0), prior_incentive))) AS shown_high FROM s_offered"""


@query(f"SELECT bid_id, product, round(target_high, 6) AS target_high, round(target_low, 6) AS target_low, round(shown_high, 6) AS shown_high FROM s_targets")
def target_ranges(t):
    return post.target_range(offered_rows(best(t))).select("bid_id", "product", *[F.round(c, 6).alias(c) for c in ("target_high", "target_low", "shown_high")])


def _tier(kind: str, value: str) -> str:
    return f"coalesce((SELECT arg_min(incentive, break_at) FROM t_breaks WHERE surcharge_type = '{kind}' AND break_at >= {value}), (SELECT arg_max(incentive, break_at) FROM t_breaks WHERE surcharge_type = '{kind}'))"


S.CTES["s_surch"] = f"SELECT *, {_tier('RES', 'optimal_inc')} AS resi, {_tier('GDL', 'bid_list_rev')} AS das FROM (SELECT bid_id, mode, product, bid_list_rev, max(optimal_inc) AS optimal_inc FROM s_optimum WHERE mode IN ('GND', 'AIR') GROUP BY ALL)"


@query(f"SELECT bid_id, product, resi, das FROM s_surch")
def surcharge_incentives(t):
    return post.surcharge_incentives(best(t), t.surcharge_breaks).select("bid_id", "product", "resi", "das")


S.CTES["s_quotes"] = f"""SELECT bid_id, product, mode, c.direction, c.svc_type, c.feature, freight_incentive, target_high, target_low, NULL AS surcharge_type, NULL AS package_type, NULL AS acquisition, NULL AS description, NULL::DOUBLE AS resi, NULL::DOUBLE AS das
FROM s_targets JOIN t_codes c USING (product)
UNION ALL SELECT bid_id, product, 'ACY', m.direction, m.svc_type, m.feature, NULL, NULL, NULL, surcharge_type, package_type, acquisition, description, resi, das FROM s_surch JOIN t_surcharge_map m USING (product)"""


def quote_rows(t: Tables) -> DataFrame:
    return post.quotes(offered_rows(optimal(t)), t.service_products, t.surcharge_breaks, t.surcharge_map)


@query(f"SELECT bid_id, product, mode, direction, svc_type, feature, round(freight_incentive, 6) AS freight_incentive, round(target_low, 6) AS target_low, surcharge_type, description, resi, das FROM s_quotes")
def quotes_per_service(t):
    return quote_rows(t).select("bid_id", "product", "mode", "direction", "svc_type", "feature", F.round("freight_incentive", 6).alias("freight_incentive"),
                                F.round("target_low", 6).alias("target_low"), "surcharge_type", "description", "resi", "das")


S.CTES["s_industry"] = ("SELECT bid_id, " + ", ".join(f"round(count(*) FILTER (name = '{n}')::DOUBLE / count(*), 9) AS ind_{n}_pct" for n in [*catalog.INDUSTRIES.values(), catalog.UNMAPPED_INDUSTRY])
       + """, (SELECT arg_max(s, (n, -i)) FROM (SELECT unnest(list_value(""" + ", ".join(f"count(*) FILTER (name = '{n}')" for n in [*catalog.INDUSTRIES.values(), catalog.UNMAPPED_INDUSTRY])
       + """)) AS n, unnest(range(10)) AS i, unnest(list_value(""" + ", ".join("'" + s.replace("'", "''") + "'" for s in [*catalog.INDUSTRIES, "Unclassified"]) + """)) AS s)) AS dominant_industry
FROM (SELECT bid_id, CASE segment """ + " ".join(f"WHEN '{s}' THEN '{n}'" for s, n in catalog.INDUSTRIES.items()) + f" ELSE '{catalog.UNMAPPED_INDUSTRY}' END AS name FROM t_shippers LEFT JOIN t_industry USING (industry_code)) GROUP BY 1")


@query("SELECT * FROM s_industry")
def industry_profile(t):
    rows = industry.industry_profile(t.shippers, t.industry_map)
    return rows.select("bid_id", *[F.round(c, 9).alias(c) for c in industry.INDUSTRY_COLUMNS], "dominant_industry")


@query("""SELECT f.bid_id, f.product, round(0.4 + coalesce(o.increment, 0.0), 9) AS volume_weight FROM p_features f JOIN s_industry d ON d.bid_id = f.bid_id LEFT JOIN t_overlay o
  ON o.district = TRY_CAST(f.bid_district AS INT) AND o.industry = d.dominant_industry AND o.product = f.product WHERE f.mode IN ('AIR', 'GND', 'IE')""")
def overlay_weights(t):
    rows = score.priced_rows(features(t)).join(industry.industry_profile(t.shippers, t.industry_map), "bid_id")
    return optimise.add_weights(rows, t.overlay).select("bid_id", "product", F.round("volume_weight", 9).alias("volume_weight"))


_SEGMENTS = """SELECT bid_id, p.product, p.mode, i.incentive FROM p_products p JOIN t_seg_tier t ON t.mode = p.mode AND t.tier = coalesce(p.tier, 6)
JOIN t_seg_density d ON d.mode = p.mode AND d.min_value <= coalesce(p.density, 1.0) AND d.max_value > coalesce(p.density, 1.0)
JOIN t_seg_size s ON s.mode = p.mode AND s.min_value <= bid_list_rev AND s.max_value > bid_list_rev
JOIN t_seg_cohort c ON c.mode = p.mode AND c.tier_segment = t.tier_segment AND c.density_segment = d.density_segment AND c.size_segment = s.size_segment
JOIN t_seg_incentive i ON i.mode = p.mode AND i.cohort = c.cohort"""


@query(f"SELECT bid_id, x.product, mode, incentive AS freight_incentive, round(incentive + 0.01, 9) AS target_high, round(incentive - 0.05, 9) AS target_low, c.direction, c.svc_type, c.feature FROM ({_SEGMENTS}) x JOIN t_codes c ON c.product = x.product")
def segment_quotes(t):
    rows = post.per_service(segments.score_segments(score.heavy_rows(products(t)), t.segments), t.service_products)
    return rows.select("bid_id", "product", "mode", "freight_incentive", F.round("target_high", 9).alias("target_high"), F.round("target_low", 9).alias("target_low"), "direction", "svc_type", "feature")


@query(f"SELECT p.bid_id, p.product FROM p_products p LEFT JOIN ({_SEGMENTS}) x ON x.bid_id = p.bid_id AND x.product = p.product WHERE p.mode IN ('AIR_CWT', 'GND_CWT') AND x.incentive IS NULL")
def heavy_rows_without_segment(t):
    return segments.unsegmented(products(t), t.segments).select("bid_id", "product")


# --- publishing ---------------------------------------------------------------------------------
def result_rows(t: Tables) -> DataFrame:
    prior = weights.prior_results_with_services(t.prior_results, t.ceiling_services, t.service_groups)
    return publish.with_prior_results(quote_rows(t), prior)


_PRIOR = "SELECT DISTINCT p.bid_id, p.svc_group, recommended, low, high, direction, svc_type, feature FROM t_prior p JOIN t_ceiling USING (bid_id, svc_group) JOIN t_groups USING (bid_id, svc_group)"
S.CTES["s_results"] = f"""SELECT x.bid_id, product, mode, freight_incentive, target_low, target_high, svc_group, recommended AS prior_target, NULL AS surcharge_type, NULL::DOUBLE AS resi, NULL::DOUBLE AS das, NULL AS description
FROM s_quotes x JOIN ({_PRIOR}) p ON p.bid_id = x.bid_id AND p.direction = x.direction AND p.svc_type = x.svc_type AND p.feature = x.feature WHERE mode <> 'ACY'
UNION ALL SELECT bid_id, product, mode, freight_incentive, target_low, target_high, NULL, NULL, surcharge_type, resi, das, description FROM s_quotes WHERE mode = 'ACY'"""


@query(f"SELECT bid_id, product, mode, svc_group::DOUBLE AS svc_group, round(freight_incentive, 6) AS freight_incentive, prior_target, resi, das FROM s_results")
def results_with_prior(t):
    return result_rows(t).select("bid_id", "product", "mode", F.col("svc_group").cast("double").alias("svc_group"), F.round("freight_incentive", 6).alias("freight_incentive"), "prior_target", "resi", "das")


S.CTES["s_updates"] = f"""SELECT bid_id, svc_group, max(recommended) AS recommended, arg_max(low, recommended) AS low, arg_max(high, recommended) AS high FROM (
  SELECT bid_id, svc_group, freight_incentive AS recommended, target_low AS low, target_high AS high FROM s_results r
  WHERE mode <> 'ACY' AND NOT EXISTS (SELECT 1 FROM t_surcharge s WHERE s.bid_id = r.bid_id AND s.svc_group = r.svc_group)) GROUP BY 1, 2"""
S.CTES["s_surch_updates"] = f"""SELECT s.bid_id, s.svc_group, max(CASE s.surcharge_type WHEN 'RES' THEN resi WHEN 'GDL' THEN das END) AS recommended
FROM s_quotes x JOIN t_surcharge s ON s.bid_id = x.bid_id AND s.direction = x.direction AND s.feature = x.feature AND s.svc_type = x.svc_type AND s.surcharge_type = x.surcharge_type
  AND s.package_type = x.package_type AND s.acquisition = x.acquisition WHERE mode = 'ACY' GROUP BY 1, 2"""


@query(f"SELECT bid_id, svc_group, recommended, recommended AS low, recommended AS high FROM s_surch_updates")
def surcharge_updates(t):
    return publish.surcharge_updates(quote_rows(t), t.surcharge_services)


@query(f"""SELECT p.bid_id, p.svc_group, result_type, round(CASE WHEN result_type = 'P' THEN coalesce(u.recommended, p.recommended) ELSE p.recommended END, 6) AS recommended,
  round(CASE WHEN result_type = 'P' THEN coalesce(u.low, p.low) ELSE p.low END, 6) AS low, round(CASE WHEN result_type = 'P' THEN coalesce(u.high, p.high) ELSE p.high END, 6) AS high
FROM t_prior p LEFT JOIN (SELECT u.* FROM (SELECT * FROM s_updates UNION ALL SELECT bid_id, svc_group, recommended, recommended, recommended FROM s_surch_updates) u
  LEFT JOIN t_holdout h ON h.digit = CAST(right(u.bid_id, 1) AS INT) WHERE coalesce(h.is_on, true)) u ON u.bid_id = p.bid_id AND u.svc_group = p.svc_group""")
def updated_result_table(t):
    prior = weights.prior_results_with_services(t.prior_results, t.ceiling_services, t.service_groups)
    snapshot, _ = publish.publish(quote_rows(t), prior, t.ceiling_services, t.surcharge_services, t.holdout, t.prior_results)
    return snapshot.select("bid_id", "svc_group", "result_type", *[F.round(c, 6).alias(c) for c in ("recommended", "low", "high")])


@query("SELECT bid_id, coalesce(is_on, true) AS update_on FROM t_bids LEFT JOIN t_holdout ON digit = CAST(right(bid_id, 1) AS INT)")
def holdout_gate(t):
    return publish.updates_allowed(F.col("bid_id"), t.holdout, t.bids.select("bid_id"))


@query("""SELECT u.bid_id, u.svc_group, 'UPDATE results SET rec = ' || floor(u.recommended * 1000000 + 0.5) / 1000000 || ', lo = ' || floor(u.low * 1000000 + 0.5) / 1000000
  || ', hi = ' || floor(u.high * 1000000 + 0.5) / 1000000 || ' WHERE bid = ''' || u.bid_id || ''' AND grp = ''' || u.svc_group || ''' AND typ = ''P''' AS statement
FROM (SELECT * FROM s_updates UNION ALL SELECT bid_id, svc_group, recommended, recommended, recommended FROM s_surch_updates) u
  LEFT JOIN t_holdout h ON h.digit = CAST(right(u.bid_id, 1) AS INT)
WHERE coalesce(h.is_on, true) AND u.recommended IS NOT NULL
  AND EXISTS (SELECT 1 FROM t_prior p WHERE p.result_type = 'P' AND p.bid_id = u.bid_id AND p.svc_group = u.svc_group)""")
def update_statements(t):
    prior = weights.prior_results_with_services(t.prior_results, t.ceiling_services, t.service_groups)
    updates, _ = publish.allowed_updates(quote_rows(t), prior, t.ceiling_services, t.surcharge_services, t.holdout)
    # only keys that the sink has in rows of type P; an update without values changes nothing and has no statement
    held = t.prior_results.where("result_type = 'P'").select("bid_id", "svc_group").distinct()
    # Millionths, half up, on the double itself: the same operations in Spark and in the check SQL.
    rounded = updates.withColumns({c: F.floor(F.col(c) * 1000000 + 0.5) / 1000000 for c in ("recommended", "low", "high")})
    return publish.update_statements(rounded.join(held, ["bid_id", "svc_group"], "left_semi"), "results", ("rec", "lo", "hi", "bid", "grp", "typ"))


@query("SELECT bid_id, CASE WHEN bid_id IN (SELECT bid_id FROM s_quotes) THEN 0 ELSE 1 END AS status FROM t_bids")
def scoring_status(t):
    return publish.scoring_status(t.bids, quote_rows(t))


@query(f"""SELECT bid_id, description || ': Inc - ' || CASE surcharge_type WHEN 'RES' THEN resi WHEN 'GDL' THEN das END AS line FROM (SELECT DISTINCT bid_id, description, surcharge_type, resi, das FROM s_quotes WHERE mode = 'ACY')
UNION ALL SELECT bid_id, product || ': Inc - ' || i || ', Low - ' || l || ', High - ' || h FROM (
  SELECT DISTINCT bid_id, product, floor(freight_incentive * 10000 + 0.5) / 10000 AS i, floor(target_low * 10000 + 0.5) / 10000 AS l,
    floor(target_high * 10000 + 0.5) / 10000 AS h FROM s_quotes WHERE mode <> 'ACY' AND freight_incentive IS NOT NULL)""")
def report_lines(t):
    rows = quote_rows(t).where((F.col("mode") == catalog.SURCHARGE_MODE) | F.col("freight_incentive").isNotNull())
    # Ten-thousandths, half up, on the double itself: the same operations in Spark and in the check SQL.
    return publish.report_lines(rows.withColumns({c: F.floor(F.col(c) * 10000 + 0.5) / 10000 for c in ("freight_incentive", "target_low", "target_high")}))


@query()
def scored_bids(t):
    """Production scoring of all bids: features to quotes, both mode families."""
    rows = features(t, with_profile=True)
    scored = score.score_bids(
        rows, formulas.respond, formulas.gap, t.bands, t.service_products, t.surcharge_breaks, t.surcharge_map,
        industry.industry_profile(t.shippers, t.industry_map), t.overlay, t.segments,
    )
    return scored.select("bid_id", "product", "mode", "direction", "svc_type", "feature", F.round("freight_incentive", 6).alias("freight_incentive"), "resi", "das")


@query(f"SELECT x.bid_id, count(*) AS quotes, min(mode) AS first_mode, max(mode) AS last_mode FROM s_quotes x GROUP BY 1")
def streamed_requests(t):
    """Requests (product rows of all bids) arrive as files, are scored by micro-batch, and the
    responses are read back: the same rows as the batch plan gives."""
    from tenderline.streaming import requests as R

    folder, out, bad = (run_folder(t.spark, n) for n in ("requests", "responses", "rejects"))
    rows = best(t)
    rows.select(*[c for c in post.QUOTE_COLUMNS if c in rows.columns]).write.parquet(folder)
    schema = t.spark.read.parquet(folder).schema

    def score_one(rows: DataFrame) -> DataFrame:
        return post.quotes(offered_rows(rows), t.service_products, t.surcharge_breaks, t.surcharge_map)

    handle = R.score_batches(score_one, out, bad, {"bid_list_rev": "double"}, ["bid_id", "product", "mode"])
    R.start(R.request_stream(t.spark, folder, schema), handle, run_folder(t.spark, "checkpoint"), every=None).awaitTermination()
    answers = t.spark.read.parquet(out)
    return answers.groupBy("bid_id").agg(F.count(F.lit(1)).alias("quotes"), F.min("mode").alias("first_mode"), F.max("mode").alias("last_mode"))


@query("SELECT event_id, user_id, event_type FROM events")
def streamed_without_repeats(t):
    from tenderline.streaming import requests as R

    events = t.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))
    again = events.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 HOUR"))
    folder = run_folder(t.spark, "repeated")
    events.unionByName(again).write.parquet(folder)
    once = R.without_repeats(R.request_stream(t.spark, folder, events.schema), ["event_id"], "ts", "1 day")
    out = run_folder(t.spark, "events")
    writer = once.writeStream.format("parquet").option("path", out).option("checkpointLocation", run_folder(t.spark, "checkpoint"))
    writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user_id", "event_type")


@query("SELECT event_id::VARCHAR AS bid_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 30 SECOND AND event_type <> 'error'")
def unanswered_requests(t):
    from tenderline.streaming import requests as R

    rows = t.raw("events").withColumn("bid_id", F.col("event_id").cast("string"))
    return R.unanswered(rows, rows.where("event_type = 'error'"), "2024-01-20 00:00:00").select("bid_id", "event_type")


# --- models (no SQL form: checked by row counts here and by invariants in the tests) -------------
@query()
def market_incentives(t):
    from tenderline.models import pricing

    rows = calibration(t)
    fitted = pricing.fit_market(rows, NUMERIC, TEXTUAL)
    return pricing.predict_by_mode(rows, fitted).select("bid_id", "product", "mode", F.round("market_inc", 6).alias("market_inc"))


@query()
def effective_to_offered_gap(t):
    from tenderline.models import pricing

    rows = calibration(t)
    fitted = pricing.fit_gap(rows, NUMERIC, TEXTUAL)
    return pricing.predict_by_mode(rows, fitted).select("bid_id", "product", F.round("gap", 6).alias("gap"))


MATRIX = ({"list_rev": "float64", "gross_cost_ratio": "float64", "major_competitor": "str"}, {"bid_reason": "str", "bid_list_rev": "float64"})


def bid_matrix(rows: DataFrame) -> DataFrame:
    from tenderline.models import pricing

    return materialise(pricing.learn_layout(rows, *MATRIX, list(catalog.PRODUCT_MODES)).matrix(rows), "matrix")


@query()
def base_pull_through(t):
    from tenderline.models import pricing

    rows = calibration(t)
    matrix = bid_matrix(rows)
    fitted = pricing.fit_base(rows, matrix)
    return pricing.predict_base(rows, matrix, fitted).select("bid_id", "product", F.round("base_pt", 6).alias("base_pt"), F.round("base_logit", 6).alias("base_logit"))


@query()
def win_probabilities(t):
    from tenderline.models import pricing

    rows = calibration(t)
    matrix = bid_matrix(rows)
    return pricing.fit_win(rows, matrix).predict(matrix).select("bid_id", F.round("win_probability", 6).alias("win_probability"))


@query()
def fitted_response(t):
    from tenderline.models import pricing

    rows = formulas.market(calibration(t))
    model = pricing.fit_response(rows, ["gross_cost_ratio"], ["bid_reason"])
    return model.apply(rows).select("bid_id", "product", F.round("alpha", 6).alias("alpha"), F.round("gamma", 6).alias("gamma"))


@query()
def variable_importance(t):
    from tenderline.models import fitted as FM, pricing

    rows = calibration(t)
    variables = catalog.values_frame(t.spark, "variable string", [(v,) for v in NUMERIC + TEXTUAL])
    models = pricing.fit_market(rows, NUMERIC, TEXTUAL)
    return FM.mean_importance([FM.importance_by_variable(FM.importance(m, rows), variables) for m in models.values()])

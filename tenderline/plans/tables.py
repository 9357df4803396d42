"""Bid headers and bid lines from the source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline import catalog
from tenderline.functions.scalars import code_label, if_zero, not_listed
from tenderline.operators.aggregates import modal_int, modal_values, top_label
from tenderline.operators.joins import except_listed, lookup

SERVICE_KEYS = ["direction", "svc_type", "feature"]


def lead_accounts(shipper_volumes: DataFrame, as_coded: bool = False) -> DataFrame:
    """Account with the largest list revenue per bid; as coded, the smallest account."""
    if as_coded:
        return shipper_volumes.groupBy("bid_id").agg(F.min("account").alias("lead_account"))
    return top_label(shipper_volumes, ["bid_id"], "account", F.col("qty") * F.col("price_pp"), "lead_account")


def shipper_rollup(shipper_volumes: DataFrame) -> DataFrame:
    """Per (bid, service group): prior gross and net revenue, and the modal tier, from one scan."""
    qty = F.col("qty")
    per_tier = shipper_volumes.groupBy("bid_id", "svc_group", "tier").agg(
        F.sum(qty * F.col("prior_gross_pp")).alias("gross"),
        F.sum(qty * F.col("prior_net_pp")).alias("net"),
        F.count(F.lit(1)).alias("n"),
    )
    modal = modal_int(F.col("n"), F.col("tier"))
    return per_tier.groupBy("bid_id", "svc_group").agg(
        F.sum("gross").alias("prior_gross"), F.sum("net").alias("prior_net"), modal.alias("tier")
    )


def bid_headers(bids: DataFrame, shippers: DataFrame, shipper_volumes: DataFrame, as_coded: bool = False) -> DataFrame:
    """One row per bid with category label, modal region and district, and lead account.

    Bids without shippers or volumes are dropped, as the joins are inner.
    """
    places = modal_values(shippers, ["bid_id"], ["region", "district"])
    category = code_label(F.concat(F.lit("0"), F.col("category_code")), catalog.CATEGORY_LABELS, "Not known")
    headers = bids
    if as_coded or "reason_code" not in bids.columns:
        headers = headers.withColumn("reason_code", F.lit(1))
    return (
        headers.withColumn("category", category)
        .drop("category_code")
        .join(places.where(F.col("region").isNotNull() & F.col("district").isNotNull()), "bid_id")
        .join(lead_accounts(shipper_volumes, as_coded), "bid_id")
    )


def latest_targets(target_prices: DataFrame) -> DataFrame:
    """Per (bid, service group): largest prices among rows at the bid's largest factor.

    Rows are first combined to (bid, group, factor); the bid's largest factor is then a semi join.
    """
    prices = ["comp_est_pp", "target_pp", "target_low_pp", "target_high_pp"]
    by_factor = target_prices.groupBy("bid_id", "svc_group", "factor").agg(*[F.max(p).alias(p) for p in prices])
    tops = by_factor.groupBy("bid_id").agg(F.max("factor").alias("factor")).where(F.col("factor").isNotNull())
    return by_factor.join(tops, ["bid_id", "factor"], "left_semi").select("bid_id", "svc_group", *prices)


def bid_lines(
    service_groups: DataFrame,
    target_prices: DataFrame,
    shipper_volumes: DataFrame,
    surcharge_services: DataFrame | None = None,
    as_coded: bool = False,
) -> DataFrame:
    """One row per (bid, service group) with prices, competitor, prior revenue per week and tier.

    As coded, lines fan out per shipper row of the group instead of taking its modal tier.
    """
    groups = service_groups
    if surcharge_services is not None:
        groups = except_listed(groups, surcharge_services, ["bid_id", "svc_group"])
    rollup = shipper_rollup(shipper_volumes)
    if as_coded:
        rollup = rollup.drop("tier")
    code = F.col("competitor_code")
    watched = F.coalesce(code.isin(catalog.WATCHED_COMPETITOR_CODES), F.lit(False))
    label = F.when(watched, catalog.WATCHED_COMPETITOR).otherwise(catalog.OTHER_COMPETITOR)
    lines = (
        groups.join(latest_targets(target_prices), ["bid_id", "svc_group"], "left")
        .join(rollup, ["bid_id", "svc_group"], "left")
        .withColumns({
            "competitor": label,
            "comp_net_pp": if_zero(F.col("comp_keyed_pp"), F.col("comp_est_pp")),
            "prior_gross_rev": F.col("prior_gross") / F.lit(13.0),
            "prior_net_rev": F.col("prior_net") / F.lit(13.0),
        })
        .drop("prior_gross", "prior_net")
    )
    if as_coded:
        lines = lines.join(shipper_volumes.select("bid_id", "svc_group", "tier"), ["bid_id", "svc_group"], "left")
    return lines


def with_products(lines: DataFrame, service_products: DataFrame) -> DataFrame:
    """Attach the product of the service code, trim the competitor, drop unreliable products.

    Lines without a product stay here (a missing product is not an unreliable one).
    """
    if "product" in lines.columns:
        return lines
    codes = service_products.select(*SERVICE_KEYS, "product")
    joined = lookup(lines.withColumn("competitor", F.trim("competitor")), codes, SERVICE_KEYS, "left")
    return joined.where(not_listed(F.col("product"), catalog.UNRELIABLE_PRODUCTS))


def clean_bids(headers: DataFrame, as_of: str | None = None) -> DataFrame:
    """Lags, status by age, win flags and reason label.

    ``as_of`` names a date column to count the proposal's age from; by default the bid's own
    status date, which is what a run over one bid uses.
    """
    if "proposed_lag" in headers.columns:
        return headers
    if "reason_code" not in headers.columns:
        headers = headers.withColumn("reason_code", F.lit(1))
    lag = F.datediff(F.col(as_of or "status_date"), F.col("proposed_date"))
    updated = F.when((F.col("status") == "P") & (F.col("proposed_lag") > catalog.REJECT_AFTER_DAYS), "R").otherwise(F.col("status"))
    reason = code_label(F.col("reason_code").cast("string").try_cast("double").cast("int"), catalog.REASON_LABELS, "Other")
    return headers.withColumns({"proposed_lag": lag, "reason": reason}).withColumns({
        "status_updated": updated,
        "proposal_flag": F.coalesce((F.col("status") == "P").cast("int"), F.lit(0)),
        "win_flag": code_label(F.col("status"), catalog.WIN_FLAGS, "Unclassified"),
        "weeks_since_init": F.datediff("status_date", "init_date") / F.lit(7.0),
        "month_of_bid": F.month("init_date"),
    }).withColumn("win_flag_updated", code_label(F.col("status_updated"), catalog.WIN_FLAGS, "Unclassified"))

"""Product summary, bid summary and the joined feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline import catalog
from tenderline.functions.scalars import at_least_zero, composite_key, flag, one_less_ratio, ratio
from tenderline.operators.aggregates import largest_label, modal_int
from tenderline.operators.shares import centred
from tenderline.plans.profile import PROFILE_COLUMNS
from tenderline.plans.tables import clean_bids

# name of the weekly sum -> the line value to add up
WEEKLY_SUMS: dict[str, Callable[[], Column]] = {
    "list_rev": lambda: F.col("list_pp") * F.col("volume"),
    "freight_rev": lambda: F.col("freight_pp") * F.col("volume"),
    "watched_rev": lambda: flag(F.col("competitor") == catalog.WATCHED_COMPETITOR) * F.col("list_pp") * F.col("volume"),
    "marg_cost": lambda: F.col("marg_cost_pp") * F.col("volume"),
    "volume": lambda: F.col("volume"),
    "prior_volume": lambda: F.col("prior_volume"),
    "comp_net_rev": lambda: F.col("comp_net_pp") * F.col("volume"),
    "target_high_rev": lambda: F.col("target_high_pp") * F.col("volume"),
    "target_low_rev": lambda: F.col("target_low_pp") * F.col("volume"),
    "prior_net_rev": lambda: F.col("prior_net_rev"),
    "prior_gross_rev": lambda: F.col("prior_gross_rev"),
    "comp_keyed_rev": lambda: F.col("comp_keyed_pp") * F.col("volume"),
    "comp_est_rev": lambda: F.col("comp_est_pp") * F.col("volume"),
    "density_rev": lambda: F.col("density") * F.col("list_pp") * F.col("volume"),
}
SUMS = list(WEEKLY_SUMS)


KNOWN_COMPETITORS = (catalog.OTHER_COMPETITOR, catalog.WATCHED_COMPETITOR)


def _competitor_sums(labels: tuple[str, ...], name: str, add: Callable[[Column], Column]) -> dict[str, Column]:
    """Revenue per known competitor label; NULL for a label that does not occur."""
    return {label: add(F.when(F.col(name) == label, F.col("list_rev"))) for label in labels}


def line_cells(lines: DataFrame, by: tuple[str, ...] = ("tier",)) -> DataFrame:
    """Lines combined to (bid, product, tier).

    This is the only pass over the lines. A bid is left with products x tiers rows at most, so
    everything after it can work within the bid, hot bids included.
    """
    values = lines.where(F.col("product").isNotNull()).select(
        "bid_id", "product", "competitor", "tier", *[value().alias(name) for name, value in WEEKLY_SUMS.items()]
    )
    per_label = [] if "competitor" in by else [
        column.alias(f"__{label}") for label, column in _competitor_sums(KNOWN_COMPETITORS, "competitor", F.sum).items()
    ]
    return values.groupBy("bid_id", "product", *by).agg(
        *[F.sum(name).alias(name) for name in SUMS], *per_label, F.count("tier").alias("tier_lines")
    )


def product_sums(lines: DataFrame, any_competitor: bool = False) -> DataFrame:
    """Weekly sums, major competitor and modal tier per (bid, product).

    The cells are placed by bid once; the aggregation below, and all later work keyed by bid,
    then need no further exchange. Competitors are the two labels that ``bid_lines`` gives;
    with ``any_competitor`` the labels are open and ranked by a two-level argmax.
    """
    by = ["bid_id", "product"]
    if any_competitor:
        return _product_sums_open(lines)
    cells = line_cells(lines).repartition("bid_id")
    return (
        cells.groupBy(*by)
        .agg(
            *[F.sum(name).alias(name) for name in SUMS],
            *[F.sum(f"__{label}").alias(f"__{label}") for label in KNOWN_COMPETITORS],
            modal_int(F.col("tier_lines"), F.col("tier")).alias("tier"),
        )
        .withColumn("major_competitor", largest_label({label: F.col(f"__{label}") for label in KNOWN_COMPETITORS}))
        .drop(*[f"__{label}" for label in KNOWN_COMPETITORS])
    )


def _product_sums_open(lines: DataFrame) -> DataFrame:
    by = ["bid_id", "product"]
    cells = line_cells(lines, ("competitor", "tier")).repartition("bid_id")
    ranked = cells.withColumn("competitor_rev", F.sum("list_rev").over(Window.partitionBy(*by, "competitor"))).withColumn(
        "tier_total", F.sum("tier_lines").over(Window.partitionBy(*by, "tier"))
    )
    major = F.expr("min(struct(-competitor_rev AS n, competitor AS v)) FILTER (WHERE competitor_rev IS NOT NULL AND competitor IS NOT NULL)")
    return ranked.groupBy(*by).agg(
        *[F.sum(name).alias(name) for name in SUMS],
        modal_int(F.col("tier_total"), F.col("tier")).alias("tier"),
        major["v"].alias("major_competitor"),
    )


def _ratios(sums: DataFrame) -> DataFrame:
    """Ratios and flags shared by the product and the bid grain."""
    c = F.col
    return sums.withColumns({
        "watched_share": ratio(c("watched_rev"), c("list_rev")),
        "prior_incentive": one_less_ratio(c("prior_net_rev"), c("prior_gross_rev")),
        "new_volume_share": at_least_zero(one_less_ratio(c("prior_volume"), c("volume"))),
        "gross_cost_ratio": ratio(c("marg_cost"), c("list_rev")),
        "freight_share": ratio(c("freight_rev"), c("list_rev")),
    }).withColumns({
        "mostly_watched": flag(c("watched_share") > 0.95),
        "mostly_third_party": flag(c("watched_share") < 0.2),
    })


def product_summary(lines: DataFrame, as_coded: bool = False) -> DataFrame:
    """One row per (bid, product) with ratios, shares of the bid and of the product family."""
    c = F.col
    bid = Window.partitionBy("bid_id")
    product = c("product")
    families = {"ground": catalog.GROUND_FAMILY, "air": catalog.AIR_FAMILY, "trade": catalog.TRADE_FAMILY}
    rows = _ratios(product_sums(lines))
    if as_coded:
        overall = rows.agg(F.avg("freight_share").alias("__mean"))
        rows = rows.crossJoin(F.broadcast(overall)).withColumn("freight_share_centred", c("freight_share") - c("__mean")).drop("__mean")
    else:
        rows = rows.withColumn("freight_share_centred", centred(c("freight_share"), "bid_id"))
    keyed = c("comp_keyed_rev") > 0
    family_totals = {
        f"{family}_list_rev": F.sum(F.when(product.isin(members), c("list_rev")).otherwise(0.0)).over(bid)
        for family, members in families.items()
    }
    family_rev = F.when(product.isin(catalog.GROUND_FAMILY), c("ground_list_rev")).when(
        product.isin(catalog.AIR_FAMILY), c("air_list_rev")
    )
    if as_coded:
        family_rev = family_rev.otherwise(c("trade_list_rev"))
    else:
        family_rev = family_rev.when(product.isin(catalog.TRADE_FAMILY), c("trade_list_rev"))
    return rows.withColumns({
        "target_high_inc": one_less_ratio(c("target_high_rev"), c("freight_rev")),
        "target_low_inc": one_less_ratio(c("target_low_rev"), c("freight_rev")),
        "density": ratio(c("density_rev"), c("list_rev")),
        "comp_incentive": at_least_zero(one_less_ratio(c("comp_net_rev"), c("freight_rev"))),
        "comp_keyed_flag": flag(keyed),
        "comp_keyed_incentive": F.when(keyed, at_least_zero(one_less_ratio(c("comp_keyed_rev"), c("freight_rev")))),
        "bid_list_rev": F.sum("list_rev").over(bid),
        **family_totals,
    }).withColumns({
        "product_share": ratio(c("list_rev"), c("bid_list_rev")),
        "family_share": ratio(c("list_rev"), family_rev),
        "mode": catalog.product_mode(product),
        "bid_product": composite_key(c("bid_id"), product),
    })


_BID_SUMS = [name for name in SUMS if name != "density_rev"]


def _bid_shares(add: Callable[[Column], Column]) -> dict[str, Column]:
    share = F.col("product_share")

    def of(members: list[str]) -> Column:
        return add(F.when(F.col("product").isin(members), share).otherwise(0.0))

    return {
        "ground_share": of(catalog.GROUND_FAMILY),
        "air_share": of(catalog.AIR_FAMILY),
        "residential_share": of(catalog.RESIDENTIAL_FAMILY),
        "trade_share": of(catalog.TRADE_FAMILY),
        "air_heavy_share": of(["Air_CWT"]),
        "ground_heavy_share": of(["GND_CWT"]),
        "concentration": add(share * share),
    }


def _bid_flags(sums: DataFrame) -> DataFrame:
    c = F.col
    new = c("new_volume_share")
    keyed, est = c("comp_keyed_rev"), c("comp_est_rev")
    return sums.withColumns({
        "volume_reason": F.when(new > 0.6, "CONVERSION_Prod").when(new <= 0.2, "RETENTION_Prod").otherwise("PENETRATION_Prod"),
        "ground_centric": flag(c("ground_share") > 0.8),
        "air_centric": flag(c("air_share") > 0.6),
        "residential_centric": flag(c("residential_share") > 0.6),
        "trade_centric": flag(c("trade_share") > 0.4),
        "keyed_flag": F.when(keyed.isNull(), 0).when((keyed == 0) & (est > 1), 0).otherwise(1),
        "keyed_higher": flag(keyed > est * 1.2),
        "keyed_lower": flag(keyed < est * 0.8),
        "below_200": flag(c("list_rev") < 200),
    })


def bid_summary(products: DataFrame, bids: DataFrame | None = None, any_competitor: bool = False) -> DataFrame:
    """One row per bid: sums over products, shares, concentration, major competitor and flags."""
    rows = products
    if any_competitor:
        rows = rows.withColumn("competitor_rev", F.sum("list_rev").over(Window.partitionBy("bid_id", "major_competitor")))
        major = F.expr("min(struct(-competitor_rev AS n, major_competitor AS v)) FILTER (WHERE competitor_rev IS NOT NULL AND major_competitor IS NOT NULL)")["v"]
    else:
        major = largest_label(_competitor_sums(KNOWN_COMPETITORS, "major_competitor", F.sum))
    sums = rows.groupBy("bid_id").agg(
        *[F.sum(name).alias(name) for name in _BID_SUMS],
        *[column.alias(name) for name, column in _bid_shares(F.sum).items()],
        major.alias("major_competitor"),
    )
    summary = _bid_flags(_ratios(sums))
    return summary if bids is None else summary.join(clean_bids(bids), "bid_id", "left")


def prior_or_zero(prior: str, reason: str) -> Column:
    """A conversion bid without a prior incentive had none: 0."""
    return F.when(F.col(prior).isNull() & (F.col(reason) == "CONVERSION"), 0.0).otherwise(F.col(prior))


HEADER_COLUMNS = [
    "status", "status_date", "proposed_date", "init_date", "category", "region", "district", "reason_code", "lead_account",
    "proposed_lag", "status_updated", "proposal_flag", "win_flag", "win_flag_updated", "reason", "weeks_since_init", "month_of_bid",
]


def feature_table(lines: DataFrame, bids: DataFrame, profile: DataFrame | None = None, as_coded: bool = False) -> DataFrame:
    """Product rows with their bid's features prefixed ``bid_``, and the zone/weight profile.

    Bid features come from windows over the (few) product rows of the bid rather than from a
    second aggregation joined back, so the lines are scanned and shuffled once. Product columns
    pass the windows one by one, not as a struct, so those that the caller does not read are
    never summed, shuffled or sorted.
    """
    products = product_summary(lines, as_coded)
    bid = Window.partitionBy("bid_id")

    def over_bid(value: Column) -> Column:
        return F.sum(value).over(bid)

    product_columns = [name for name in products.columns if name not in ("bid_id", "bid_list_rev", "density_rev")]
    sums = products.select(
        "bid_id", *[F.col(name).alias(f"__p_{name}") for name in product_columns],
        *[over_bid(F.col(name)).alias(name) for name in _BID_SUMS],
        *[column.alias(name) for name, column in _bid_shares(over_bid).items()],
        *[column.alias(f"__{label}") for label, column in _competitor_sums(KNOWN_COMPETITORS, "major_competitor", over_bid).items()],
    )
    sums = sums.withColumn("major_competitor", largest_label({label: F.col(f"__{label}") for label in KNOWN_COMPETITORS})).drop(
        *[f"__{label}" for label in KNOWN_COMPETITORS]
    )
    ratios = _bid_flags(_ratios(sums))
    bid_columns = [name for name in ratios.columns if name != "bid_id" and not name.startswith("__p_")]
    wide = ratios.select("bid_id", *[F.col(f"__p_{name}").alias(name) for name in product_columns], *[F.col(name).alias(f"bid_{name}") for name in bid_columns])
    headers = clean_bids(bids).select("bid_id", *[F.col(name).alias(f"bid_{name}") for name in HEADER_COLUMNS])
    joined = wide.join(headers, "bid_id", "left")
    if profile is not None:
        joined = joined.join(profile, ["bid_id", "product"], "left")
    else:
        joined = joined.select("*", *[F.lit(None).cast("double").alias(name) for name in PROFILE_COLUMNS])
    placeholders = ["bid_overall_incentive", "bid_freight_incentive", "overall_incentive", "freight_incentive", "offered_rev", "actual_rev", "actual_volume"]
    return joined.withColumns({
        "prior_incentive": prior_or_zero("prior_incentive", "bid_reason"),
        "bid_history_count": F.lit("1"),
        **{name: F.lit(1.0) for name in placeholders},
    })

"""Ceilings, bounds and feasibility of each (bid, product)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tenderline import catalog
from tenderline.functions.scalars import largest_named
from tenderline.operators.joins import range_lookup


def add_ceiling(rows: DataFrame, bands: DataFrame, omit: bool = False, as_coded: bool = False) -> DataFrame:
    """Ceiling of the product's revenue band; rows outside every band are dropped.

    Bands are (min, max]; as coded both ends are open, so a revenue on an edge is lost.
    With ``omit`` the ceiling is 1 for every band.
    """
    table = bands.select("product", F.col("min_rev"), F.col("max_rev"), (F.lit(1.0) if omit else F.col("ceiling")).alias("ceiling"))
    return range_lookup(
        rows, table, ["product"], "bid_list_rev", "min_rev", "max_rev", "none" if as_coded else "right"
    ).drop("min_rev", "max_rev")


def retained_prior() -> Column:
    """Lower bound from the prior incentive.

    Retention bids may fall below it by the mode's slack, others not; none without a prior;
    0 for small import/export rows of bids that are not import/export centric.
    """
    c = F.col
    slack = catalog.by_mode(c("mode"), "prior_slack")
    base = F.when(c("prior_incentive").isNull(), 0.0).when(
        F.coalesce(c("bid_reason") != "RETENTION", F.lit(True)), c("prior_incentive")
    ).otherwise(c("prior_incentive") - slack)
    small_trade = (
        F.coalesce(c("bid_trade_centric") != 1, F.lit(True))
        & (c("list_rev") * (1.0 - c("new_volume_share")) <= 20)
        & (c("mode") == "IE")
    )
    return F.when(small_trade, 0.0).otherwise(base)


def add_bounds(rows: DataFrame) -> DataFrame:
    """Lower and upper bound with the name of the one that binds, and feasibility.

    Needs mode, market_inc, ceiling, prior_incentive, bid_reason, bid_trade_centric,
    new_volume_share, list_rev. Bounds that contradict each other are reset to
    [floor + 0.001, 0.999]; such rows are later given the clamped market incentive.
    """
    c = F.col
    mode, market = c("mode"), c("market_inc")
    unknown = market.isNull()

    def setting(name: str) -> Column:
        return catalog.by_mode(mode, name)

    bounded = rows.withColumns({
        "prior_slack": setting("prior_slack"),
        "l_floor": setting("floor"),
        "u_mkt_price": F.coalesce(setting("u_price") * (1.0 - market) - 1.0, F.lit(0.0)),
        "u_incentive": F.lit(-1.0),
        "u_mkt_inc": F.coalesce(setting("u_market") * market, F.lit(-1.0)),
        "u_ceiling": F.coalesce(-c("ceiling"), F.lit(0.0)),
        "l_prior": retained_prior(),
        "l_mkt_price": F.when(unknown, 0.0).otherwise(setting("l_price") * (1.0 - market) + 1.0),
        "l_mkt_inc": F.when(unknown, 0.0).otherwise(setting("l_market") * market),
    })
    # Names of the bounds, in the order that decides ties
    upper, upper_name = largest_named(
        [("u_MktPR", c("u_mkt_price")), ("u_Incentive", c("u_incentive")), ("u_MktInc", c("u_mkt_inc")), ("u_Ceiling", c("u_ceiling"))]
    )
    lower, lower_name = largest_named(
        [("l_MktPR", c("l_mkt_price")), ("l_Prior", c("l_prior")), ("l_MktInc", c("l_mkt_inc")), ("l_Floor", c("l_floor"))]
    )
    feasible = c("feasible")
    reset = F.lit("Resetinfeasible")
    top = F.when(feasible, c("upper")).otherwise(0.999)
    limits = ["u_mkt_price", "u_incentive", "u_mkt_inc", "u_ceiling", "l_prior", "l_mkt_price", "l_mkt_inc"]
    return (
        bounded.withColumns({"upper": -upper, "lower": lower, "upper_name": upper_name, "lower_name": lower_name})
        .withColumn("feasible", c("lower") < c("upper"))
        .withColumns({
            "upper_name": F.when(feasible, c("upper_name")).otherwise(reset),
            "lower_name": F.when(feasible, c("lower_name")).otherwise(reset),
            "lower": F.when(feasible, c("lower")).otherwise(c("l_floor") + 0.001),
            "upper": F.when(F.abs(top - 1.0) < 0.000001, 0.999).otherwise(top),
        })
        .drop(*limits)
    )


def bound_lists(rows: DataFrame) -> DataFrame:
    """Products and bounds of each (bid, mode) as lists in product order.

    A list holds one entry per product of the mode, so it is as short as the catalog.
    """
    entry = F.struct("product", "lower", "upper")
    return rows.groupBy("bid_id", "mode").agg(F.sort_array(F.collect_list(entry)).alias("bounds")).select(
        "bid_id", "mode",
        F.col("bounds.product").alias("products"), F.col("bounds.lower").alias("lowers"), F.col("bounds.upper").alias("uppers"),
    )


def market_clamped(market: Column, floor: Column, ceiling: Column) -> Column:
    """The market incentive held between floor and ceiling; NULL if there is none."""
    return F.when(market.isNotNull(), F.least(F.greatest(market, floor), ceiling))

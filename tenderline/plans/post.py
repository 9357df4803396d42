"""From optimal to quoted incentives: gap, target range, sweep, surcharges, service fan-out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline import catalog
from tenderline.functions.objective import objective
from tenderline.functions.scalars import clip, ratio, step_label
from tenderline.operators.aggregates import stacked
from tenderline.operators.joins import breaks_to_bands, lookup, range_lookup

SERVICE_COLUMNS = ["direction", "svc_type", "feature"]


def bid_incentive(rows: DataFrame, incentive: str = "optimal_inc") -> DataFrame:
    """Take the optimum as the overall incentive and weigh it to the bid by list revenue."""
    bid = Window.partitionBy("bid_id")
    return rows.withColumn("overall_incentive", F.col(incentive)).withColumn(
        "bid_overall_incentive", ratio(F.sum(F.col(incentive) * F.col("list_rev")).over(bid), F.col("bid_list_rev"))
    )


def offered(rows: DataFrame, gap: str = "gap") -> DataFrame:
    """Offered (freight) incentive: overall less the capped gap, held in the offered range."""
    capped = clip(F.col(gap), F.lit(catalog.GAP_LOW), F.lit(catalog.GAP_HIGH))
    low, high = F.lit(catalog.OFFERED_LOW), F.lit(catalog.OFFERED_HIGH)
    return rows.withColumn(gap, capped).withColumn("freight_incentive", clip(F.col("overall_incentive") - F.col(gap), low, high))


def target_range(rows: DataFrame) -> DataFrame:
    """Target high and low around the offered incentive, and the high that may be shown.

    Shown high = min(ceiling, max(high, min(cost limit, prior))); a missing cost limit or prior
    does not take part.
    """
    c = F.col
    cost_limit = 1.0 - F.try_divide(c("marg_cost"), F.lit(catalog.MAX_COST_RATIO) * c("list_rev"))
    inner = F.least(cost_limit, c("prior_incentive"))
    spread_low = F.lit(catalog.SPREAD_LOW)
    return (
        rows.withColumn("target_high", c("freight_incentive") + catalog.SPREAD_HIGH)
        .withColumn("target_low", F.when(c("freight_incentive") >= spread_low, c("freight_incentive") - spread_low).otherwise(0.0))
        .withColumn("shown_high", F.least(c("ceiling"), F.greatest(c("target_high"), inner)))
    )


def sweep(rows: DataFrame, group: tuple[str, ...] = ("bid_id",), as_coded: bool = False) -> DataFrame:
    """Long what-if table: the optimum moved by -20..20 points, one row per step.

    Objective and profit are those of the (bid, mode) at that step. Steps that reach a price of
    zero or less have no response (NULL). As coded, net revenue adds the step to the price.

    The sums of all steps are taken over the products of a (bid, mode) side by side, before a row
    is repeated per step: the long table is made in a stream and never sorted. Rows are placed by
    group while they are narrow, so neither the sums nor a grouping by product move them again.
    The response of a step is found once and carried along: nothing is computed per step after that.
    """
    c = F.col
    low, high = catalog.SWEEP_STEPS
    own = ["product", "mode", "optimal_inc", "market_inc", "alpha", "gamma", "list_rev", "marg_cost", "price_discipline", "volume_weight"]
    w = Window.partitionBy(*group, "mode")

    def moved(step: Column) -> Column:
        return c("optimal_inc") + step / F.lit(100.0)

    def at_step(step: Column) -> Column:
        terms = objective(moved(step))
        return F.struct(terms.total.alias("total"), terms.profit.alias("profit"), terms.pull_through.alias("pull_through"))

    def summed(i: int, step: int) -> Column:
        total, profit = (F.sum(c("by_step")[i][name]).over(w) for name in ("total", "profit"))
        swept, response = moved(F.lit(step)), c("by_step")[i]["pull_through"]
        priced = 1.0 - c("optimal_inc") + F.lit(step) / F.lit(100.0) if as_coded else 1.0 - swept
        return F.struct(
            F.lit(step).alias("step"), swept.alias("swept_inc"), ratio(total, F.sum("list_rev").over(w)).alias("objective"),
            response.alias("pull_through"), profit.alias("profit"), (response * c("list_rev") * priced).alias("net_rev"),
        )

    by_step = F.transform(F.sequence(F.lit(low), F.lit(high)), at_step)
    steps = F.array(*[summed(i, step) for i, step in enumerate(range(low, high + 1))])
    return (
        rows.select(*group, *own).repartition(*group)
        .select(*group, *own, by_step.alias("by_step"))
        .select(*group, "product", "mode", steps.alias("steps"))
        .select(*group, "product", "mode", F.inline("steps"))
    )


SWEEP_METRICS = {"swept_inc": "optimal_inc", "objective": "obj", "pull_through": "pull_through", "profit": "profit", "net_rev": "net_rev"}


def sweep_columns() -> list[tuple[str, str, int]]:
    """(metric, column, step) of the wide sweep: all steps of the incentive and the objective,
    -5..5 of the others."""
    low, high = catalog.SWEEP_STEPS
    out = []
    for metric, prefix in SWEEP_METRICS.items():
        span = (low, high) if metric in ("swept_inc", "objective") else (-5, 5)
        for step in range(span[0], span[1] + 1):
            label = "0" if step == 0 else f"{step / 100:.2f}"
            out.append((metric, f"{prefix}_{label}", step))
    return out


def sweep_wide(long: DataFrame, group: tuple[str, ...] = ("bid_id",)) -> DataFrame:
    """One row per product with a column per metric and step, by one aggregation."""
    cells = [F.max(F.when(F.col("step") == step, F.col(metric))).alias(name) for metric, name, step in sweep_columns()]
    return long.groupBy(*group, "product").agg(*cells)


def labelled_steps(long: DataFrame) -> DataFrame:
    return long.withColumn("step_label", step_label(F.col("step")))


def surcharge_incentives(rows: DataFrame, breaks: DataFrame) -> DataFrame:
    """Residential and delivery-area incentives of ground and air products.

    Residential depends on the optimum, delivery area on the bid's revenue: the first break at
    or above the value, else the last one.
    """
    best = (
        rows.where(F.col("mode").isin("GND", "AIR"))
        .groupBy("bid_id", "mode", "product", "bid_list_rev")
        .agg(F.max("optimal_inc").alias("optimal_inc"))
    )
    bands = breaks_to_bands(breaks, ["surcharge_type"], "break")
    residential = bands.where("surcharge_type = 'RES'").select(F.col("incentive").alias("resi"), "low", "high")
    delivery = bands.where("surcharge_type = 'GDL'").select(F.col("incentive").alias("das"), "low", "high")
    with_resi = range_lookup(best, residential, [], "optimal_inc", "low", "high", "right", "left").drop("low", "high")
    return range_lookup(with_resi, delivery, [], "bid_list_rev", "low", "high", "right", "left").drop("low", "high")


def surcharge_rows(rows: DataFrame, breaks: DataFrame, surcharge_map: DataFrame) -> DataFrame:
    """Surcharge incentives spread over the mapped surcharge services, labelled as such."""
    priced = surcharge_incentives(rows, breaks)
    return lookup(priced, surcharge_map, ["product"], "inner").withColumn("mode", F.lit(catalog.SURCHARGE_MODE))


QUOTE_COLUMNS = [
    "bid_id", "product", "mode", "bid_region", "bid_district", "bid_reason", "bid_list_rev", "dominant_industry",
    "list_rev", "marg_cost", "alpha", "gamma", "gross_cost_ratio", "comp_incentive", "freight_share", "prior_incentive",
    "overall_incentive", "gap", "freight_incentive", "target_high", "target_low", "shown_high", "optimal_inc",
    "optimal_pull_through", "optimal_profit", "upper", "upper_name", "upper_binds", "lower", "lower_name", "lower_binds",
    "ladder_binds", "flag", "prior_slack", "market_inc", "feasible", "ceiling", "volume_weight", "price_discipline",
]


def per_service(rows: DataFrame, service_products: DataFrame) -> DataFrame:
    """Repeat product rows for each service code of the product, each code once."""
    codes = service_products.select("product", *SERVICE_COLUMNS).distinct()
    return lookup(rows, codes, ["product"], "inner")


def quotes(rows: DataFrame, service_products: DataFrame, breaks: DataFrame, surcharge_map: DataFrame, wide_sweep: bool = False) -> DataFrame:
    """Quotes per service of every offered row, plus the surcharge rows of its products."""
    by_product = target_range(rows)
    columns = [c for c in QUOTE_COLUMNS if c in by_product.columns]
    product_rows = by_product.select(*columns)
    if wide_sweep:
        product_rows = product_rows.join(sweep_wide(sweep(by_product)), ["bid_id", "product"], "left")
    return stacked([per_service(product_rows, service_products), surcharge_rows(rows, breaks, surcharge_map)])

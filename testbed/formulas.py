"""Stand-ins for fitted models, so that everything around them can be checked exactly."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline.plans.response import add_response

# (mode, term, category, value)
COEFFICIENTS = [
    (mode, term, category, value + shift)
    for mode, shift in (("AIR", 0.0), ("GND", 0.125), ("IE", -0.125))
    for term, category, value in (
        ("intercept", None, 0.25), ("base", None, 0.5), ("price", None, -6.0),
        ("gross_cost_ratio", None, -3.0), ("bid_reason", "CONVERSION", 0.5), ("bid_reason", "RETENTION", -0.5),
    )
]


def market(rows: DataFrame) -> DataFrame:
    """A market incentive between 0.15 and 0.65, missing for some import/export rows."""
    unknown = (F.col("product") == "Export") & (F.right("bid_id", F.lit(1)) == "7")
    value = 0.15 + 0.5 * F.col("product_share")
    return rows.withColumn("market_inc", F.when(~unknown, value)).withColumn("base_logit", 1.0 - 2.0 * F.col("watched_share"))


def respond(rows: DataFrame) -> DataFrame:
    return add_response(market(rows), COEFFICIENTS)


def gap(rows: DataFrame) -> DataFrame:
    return rows.withColumn("gap", 0.05 - 0.5 * F.col("gross_cost_ratio"))


def calibration_rows(features: DataFrame) -> DataFrame:
    """Labels of past bids: pull-through, incentive in force, effective-to-offered gap."""
    won = F.col("bid_win_flag_updated") == "1"
    return (
        features.withColumn("pull_through", F.when(won, 0.75 + 0.25 * F.col("product_share")).otherwise(0.5 * F.col("product_share")))
        .withColumn("overall_incentive", 0.1 + 0.5 * F.col("gross_cost_ratio") + 0.1 * F.col("product_share"))
        .withColumn("gap_label", -0.05 - 0.1 * F.col("gross_cost_ratio"))
    )

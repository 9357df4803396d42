"""Sources that are more than a projection: package weights and prior results."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def package_weights(raw: DataFrame, ounce: str = "OZ", all_zones: str = "ALL") -> DataFrame:
    """Weights in pounds per package class; the total row over all zones is left out."""
    pounds = F.col("category_weight").cast("decimal(9,2)").cast("double")
    return raw.where(F.col("zone") != all_zones).select(
        "bid_id", "svc_group", "zone", "unit",
        F.when(F.col("unit") == ounce, pounds / F.lit(16.0)).otherwise(pounds).alias("weight"),
        F.round("package_volume", 10).alias("packages"),
    )


def prior_results_with_services(prior_results: DataFrame, ceiling_services: DataFrame, service_groups: DataFrame) -> DataFrame:
    """Distinct prior results of ceiling services, with the codes of their service group."""
    keys = ["bid_id", "svc_group"]
    return (
        prior_results.select(*keys, "recommended", "low", "high")
        .join(ceiling_services.select(*keys), keys, "inner")
        .join(service_groups.select(*keys, "direction", "svc_type", "feature"), keys, "inner")
        .distinct()
    )

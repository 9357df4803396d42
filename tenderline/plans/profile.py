"""Zone and weight profile of each (bid, product)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline import catalog
from tenderline.functions.scalars import ratio, weight_band
from tenderline.operators.joins import lookup
from tenderline.operators.reshape import spread
from tenderline.operators.shares import share
from tenderline.plans.tables import SERVICE_KEYS

PROFILE_COLUMNS = [f"{label}_pct" for label in catalog.WEIGHT_LABELS] + [f"{zone}_pct" for zone in catalog.ZONES]


def packages_by_band(zone_weights: DataFrame, as_coded: bool = False) -> DataFrame:
    """Per (bid, service group, zone, weight band): packages and weight moved.

    Combined before any join, so a bid or group with very many packages shuffles few rows.
    """
    weight = F.when(F.col("weight") == 0, F.lit(0.01)).otherwise(F.col("weight"))
    return (
        zone_weights.select("bid_id", "svc_group", "zone", "packages", weight.alias("weight"))
        .groupBy("bid_id", "svc_group", "zone", weight_band(F.col("weight"), as_coded).alias("band"))
        .agg(F.sum(F.col("weight") * F.col("packages")).alias("moved"), F.sum("packages").alias("packages"))
    )


def products_by_band(zone_weights: DataFrame, service_groups: DataFrame, service_products: DataFrame, as_coded: bool = False) -> DataFrame:
    """The same with the product in place of the service group; unmapped services drop out."""
    group_products = lookup(
        service_groups.select("bid_id", "svc_group", *SERVICE_KEYS), service_products, SERVICE_KEYS, "inner"
    ).select("bid_id", "svc_group", "product")
    return packages_by_band(zone_weights, as_coded).join(group_products, ["bid_id", "svc_group"])


def zone_shares(by_band: DataFrame) -> DataFrame:
    """Long form: share of moved weight per (bid, product, zone)."""
    moved = by_band.groupBy("bid_id", "product", "zone").agg(F.sum("moved").alias("moved"))
    return moved.withColumn("zone_pct", share(F.col("moved"), "bid_id", "product"))


def band_shares(by_band: DataFrame) -> DataFrame:
    """Long form: share of packages per (bid, product, weight band)."""
    packed = by_band.where(F.col("band").isNotNull()).groupBy("bid_id", "product", "band").agg(F.sum("packages").alias("packages"))
    return packed.withColumn("band_pct", share(F.col("packages"), "bid_id", "product"))


def zone_profile(by_band: DataFrame) -> DataFrame:
    return spread(zone_shares(by_band), ["bid_id", "product"], "zone", F.col("zone_pct"), catalog.ZONES, "_pct")


def band_profile(by_band: DataFrame) -> DataFrame:
    return spread(band_shares(by_band), ["bid_id", "product"], "band", F.col("band_pct"), catalog.WEIGHT_LABELS, "_pct")


def zone_weight_profile(zone_weights: DataFrame, service_groups: DataFrame, service_products: DataFrame, as_coded: bool = False) -> DataFrame:
    """Both profiles in one wide row per (bid, product), from a single aggregation.

    Totals and cells are conditional sums of the same groupBy, so zone and band tables need
    neither their own shuffle nor a join. Zones outside the list count in the total only.
    """
    rows = products_by_band(zone_weights, service_groups, service_products, as_coded)
    banded = F.col("band").isNotNull()
    cells = [F.sum(F.when(F.col("band") == label, F.col("packages"))).alias(f"{label}_pct") for label in catalog.WEIGHT_LABELS]
    cells += [F.sum(F.when(F.col("zone") == zone, F.col("moved"))).alias(f"{zone}_pct") for zone in catalog.ZONES]
    summed = rows.groupBy("bid_id", "product").agg(
        *cells, F.sum("moved").alias("moved"), F.sum(F.when(banded, F.col("packages"))).alias("packages")
    )
    # as a join of two tables, a product needs at least one weight inside the bands
    kept = summed.where(F.col("packages").isNotNull())
    total = {f"{label}_pct": "packages" for label in catalog.WEIGHT_LABELS} | {f"{zone}_pct": "moved" for zone in catalog.ZONES}
    return kept.select(
        "bid_id", "product",
        *[F.coalesce(ratio(F.col(f"`{c}`"), F.col(total[c])), F.lit(0.0)).alias(c) for c in PROFILE_COLUMNS],
    )

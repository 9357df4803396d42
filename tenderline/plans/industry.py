"""Industry profile of a bid and the strategic overlay that depends on it."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline import catalog
from tenderline.functions.scalars import largest_named, ratio
from tenderline.operators.joins import lookup

INDUSTRY_COLUMNS = [f"ind_{name}_pct" for name in [*catalog.INDUSTRIES.values(), catalog.UNMAPPED_INDUSTRY]]


def shipper_industries(shippers: DataFrame, industry_map: DataFrame) -> DataFrame:
    """Industry column of each shipper account; unmapped codes go to 'not available'."""
    joined = lookup(shippers, industry_map, ["industry_code"], "left")
    chosen = None
    for segment, name in catalog.INDUSTRIES.items():
        chosen = (F if chosen is None else chosen).when(F.col("segment") == segment, F.lit(name))
    return joined.withColumn("industry", chosen.otherwise(F.lit(catalog.UNMAPPED_INDUSTRY))).drop("segment")


def industry_profile(shippers: DataFrame, industry_map: DataFrame) -> DataFrame:
    """Share of accounts per industry and the dominant one, a row per bid.

    Counts, shares and the dominant industry all come from one aggregation with a fixed list
    of conditional counts.
    """
    accounts = shipper_industries(shippers, industry_map)
    names = [*catalog.INDUSTRIES.values(), catalog.UNMAPPED_INDUSTRY]
    counts = accounts.groupBy("bid_id").agg(
        *[F.count(F.when(F.col("industry") == name, F.col("account"))).cast("double").alias(f"ind_{name}_pct") for name in names],
        F.count("account").cast("double").alias("accounts"),
    )
    shares = counts.select("bid_id", *[ratio(F.col(c), F.col("accounts")).alias(c) for c in INDUSTRY_COLUMNS])
    labels = {f"ind_{name}_pct": segment for segment, name in catalog.INDUSTRIES.items()}
    labels[f"ind_{catalog.UNMAPPED_INDUSTRY}_pct"] = "Unclassified"
    _, dominant = largest_named([(labels[c], F.col(c)) for c in INDUSTRY_COLUMNS])
    return shares.withColumn("dominant_industry", dominant)


def with_overlay(rows: DataFrame, overlay: DataFrame) -> DataFrame:
    """Raise the volume weight by the overlay of (district, industry, product), 0 where none."""
    side = overlay.dropna().select(
        F.col("district").cast("int").alias("__district"), F.col("industry").alias("dominant_industry"), "product", "increment"
    )
    keyed = rows.withColumn("__district", F.col("bid_district").try_cast("int"))
    joined = lookup(keyed, side, ["__district", "dominant_industry", "product"], "left")
    return joined.withColumn("increment", F.coalesce("increment", F.lit(0.0))).withColumn(
        "volume_weight", F.col("volume_weight") + F.col("increment")
    ).drop("__district")

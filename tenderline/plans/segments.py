"""Lookup pricing of heavy-freight products: tier, density and size segments to a cohort."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline import catalog
from tenderline.operators.joins import lookup, range_lookup


@dataclass(frozen=True)
class SegmentTables:
    """Segment bundle; each table holds both modes in a ``mode`` column."""

    tiers: DataFrame
    densities: DataFrame
    sizes: DataFrame
    cohorts: DataFrame
    incentives: DataFrame

    def save(self, folder: str) -> None:
        for field in fields(self):
            getattr(self, field.name).write.mode("overwrite").parquet(f"{folder}/{field.name}")

    @staticmethod
    def load(spark: SparkSession, folder: str) -> SegmentTables:
        return SegmentTables(*[spark.read.parquet(f"{folder}/{field.name}") for field in fields(SegmentTables)])


def segment_rows(rows: DataFrame, tables: SegmentTables) -> DataFrame:
    """Heavy-freight rows with their segments, cohort and incentive; NULL where a table has no match."""
    heavy = (
        rows.where(F.col("mode").isin(catalog.HEAVY_MODES))
        .withColumn("density", F.coalesce("density", F.lit(catalog.DEFAULT_DENSITY)))
        .withColumn("tier", F.coalesce("tier", F.lit(catalog.DEFAULT_TIER)))
    )
    tiered = lookup(heavy, tables.tiers, ["mode", "tier"], "left")
    sized = range_lookup(tiered, tables.sizes, ["mode"], "bid_list_rev", "min_value", "max_value", "left", "left").drop("min_value", "max_value")
    dense = range_lookup(sized, tables.densities, ["mode"], "density", "min_value", "max_value", "left", "left").drop("min_value", "max_value")
    cohorts = lookup(dense, tables.cohorts, ["mode", "tier_segment", "density_segment", "size_segment"], "left")
    return lookup(cohorts, tables.incentives, ["mode", "cohort"], "left")


def score_segments(rows: DataFrame, tables: SegmentTables) -> DataFrame:
    """Quoted incentive and target range per heavy (bid, product); rows without a segment drop out."""
    priced = segment_rows(rows, tables).where(F.col("incentive").isNotNull())
    return priced.select(
        "bid_id", "product", "mode", F.col("incentive").alias("freight_incentive"),
        (F.col("incentive") + catalog.SPREAD_HIGH).alias("target_high"),
        (F.col("incentive") - catalog.SPREAD_LOW).alias("target_low"),
    )


def unsegmented(rows: DataFrame, tables: SegmentTables) -> DataFrame:
    """Heavy-freight rows that no segment covers."""
    return segment_rows(rows, tables).where(F.col("incentive").isNull())

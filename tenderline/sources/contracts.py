"""Checks of what a run needs, as DataFrames of violations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline.operators.aggregates import missing_counts, stacked

REQUIRED = ["bids", "shippers", "service_groups", "ceiling_services", "shipper_volumes", "target_prices", "prior_results"]
OPTIONAL = ["zone_weights"]


def source_counts(tables: dict[str, DataFrame], wanted: DataFrame) -> DataFrame:
    """Rows per (wanted bid, table), zeros included, combined map-side per table."""
    counted = stacked([
        df.groupBy("bid_id").agg(F.count(F.lit(1)).alias("rows")).withColumn("source", F.lit(name)) for name, df in tables.items()
    ])
    grid = wanted.select("bid_id").distinct().select("bid_id", F.explode(F.array(*[F.lit(n) for n in tables])).alias("source"))
    return grid.join(counted, ["bid_id", "source"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def check_sources(tables: dict[str, DataFrame], wanted: DataFrame, testing: bool = False) -> DataFrame:
    """Wanted bids whose required source has no rows; in a test run prior results may be absent."""
    required = [n for n in REQUIRED if n in tables and not (testing and n == "prior_results")]
    return source_counts({n: tables[n] for n in required}, wanted).where(F.col("rows") == 0).select("bid_id", "source")


def check_lookup(df: DataFrame, name: str) -> DataFrame:
    """Violations of 'not empty and without missing values' of a lookup table."""
    empty = df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit(name).alias("lookup"), F.lit("*").alias("column"), F.lit("empty").alias("problem"))
    missing = missing_counts(df).where("missing > 0").select(F.lit(name).alias("lookup"), F.col("name").alias("column"), F.lit("missing values").alias("problem"))
    return empty.unionByName(missing)


def split_rejects(requests: DataFrame, typed: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected) rows of a re-typed request: a required value that did not fit rejects the row."""
    good = F.lit(True)
    for name in required:
        good = good & F.col(name).isNotNull()
    return typed.where(good), typed.where(~good)

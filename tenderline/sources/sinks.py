"""Writers. Every one is a plain distributed write; none collects."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tenderline.plans.publish import stamped


def write_results(results: DataFrame, folder: str, kind: str = "parquet") -> None:
    """Stamped results, a folder per bid bucket so that files stay few at many bids."""
    bucketed = stamped(results).withColumn("bid_bucket", F.pmod(F.xxhash64("bid_id"), F.lit(64)))
    bucketed.write.mode("append").partitionBy("bid_bucket").format(kind).option("header", True).save(folder)


def write_by_mode(results: DataFrame, folder: str, kind: str = "csv") -> None:
    """One folder per mode."""
    results.write.mode("overwrite").partitionBy("mode").format(kind).option("header", True).save(folder)


def write_once(df: DataFrame, folder: str, kind: str = "csv") -> None:
    """Fails if the output is already there."""
    df.write.mode("errorifexists").format(kind).option("header", True).save(folder)


def write_snapshot(df: DataFrame, folder: str) -> None:
    """A new version of a table; the old one stays until readers move on."""
    df.write.mode("errorifexists").parquet(folder)


def write_statements(statements: DataFrame, folder: str) -> None:
    """Dry-run statements as text files."""
    statements.select("statement").write.mode("errorifexists").text(folder)


def dump(frames: dict[str, DataFrame], folder: str) -> None:
    """Inputs and results of a run, a table each."""
    for name, df in frames.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}")


def counted(df: DataFrame, name: str) -> DataFrame:
    """The frame with its row count observed while it is written, at no extra pass."""
    return df.observe(name, F.count(F.lit(1)).alias("rows"))

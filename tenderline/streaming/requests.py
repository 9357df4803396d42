"""Requests as a stream: files in, scored responses and rejects out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tenderline.operators.aggregates import first_known
from tenderline.sources.contracts import split_rejects
from tenderline.sources.readers import recast


def request_stream(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int = 1000) -> DataFrame:
    """New request files of a folder. Spark tracks what it has read in its checkpoint, so no
    high-water mark is kept; writers must rename complete files into the folder."""
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def without_repeats(requests: DataFrame, key: list[str], at: str, delay: str) -> DataFrame:
    """Drop repeats of a request that arrive within the delay."""
    return requests.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def one_row_per_product(requests: DataFrame, order_by: str) -> DataFrame:
    """First known value of every column per (bid, product), in request order."""
    values = [c for c in requests.columns if c not in ("bid_id", "product", order_by)]
    return first_known(requests, ["bid_id", "product"], values, order_by)


def score_batches(score: Callable[[DataFrame], DataFrame], responses: str, rejects: str, types: dict, required: list[str]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: re-type, set bad rows aside, score the rest.

    Output goes to a folder per batch id and is overwritten on a replay, so a batch that runs
    twice leaves one result.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        usable, rejected = split_rejects(batch, recast(batch, types), required)
        rejected.write.mode("overwrite").parquet(f"{rejects}/batch_id={batch_id}")
        score(usable).write.mode("overwrite").parquet(f"{responses}/batch_id={batch_id}")

    return handle


def start(requests: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = "1 second") -> StreamingQuery:
    """Run continuously at an interval, or with ``every=None`` take what is there and stop."""
    writer = requests.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def unanswered(requests: DataFrame, responses: DataFrame, now, seconds: int = 30, at: str = "ts") -> DataFrame:
    """Requests without a response after the time limit."""
    late = requests.where(F.col(at).cast("timestamp") < F.lit(now).cast("timestamp") - F.make_interval(secs=F.lit(float(seconds))))
    return late.join(responses.select("bid_id"), "bid_id", "left_anti")

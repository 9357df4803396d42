"""What the operators share: tables, the shared folder, word counts, small hash helpers."""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space that ends a word: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE = r"\x20\x09-\x0D"
SPACES = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; on a local master without it, a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here.

    The shuffle files behind it are then of no use; a collection on the driver lets Spark drop them.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    gc.collect()
    df.sparkSession._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a table made by ``written`` that nothing reads any more."""
    spark = df.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if "/llm/" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACE}]+"))


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, as texts can be long; and let Python workers of a local session import
    this package from where the driver has it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{known}".rstrip(":")


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on uint64: spreads the bits of a weak hash."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(max(n, 1), dtype=np.uint64)
    done, step = 1, np.uint64(base & 0xFFFFFFFFFFFFFFFF)
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * step
        done += more
        step = step * step
    return out

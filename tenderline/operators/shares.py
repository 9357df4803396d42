"""Shares and centring over groups whose size the data model bounds.

The windows here run on already aggregated rows (zones of a product, products of a bid), so
a group never grows with the line data. For unbounded groups use ``share_of_total_joined``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline.functions.scalars import ratio


def share(value: Column, *keys: str) -> Column:
    """value / sum(value) within the keys."""
    return ratio(value, F.sum(value).over(Window.partitionBy(*keys)))


def centred(value: Column, *keys: str) -> Column:
    """value - mean(value) within the keys."""
    return value - F.avg(value).over(Window.partitionBy(*keys))


def share_of_total_joined(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """The same share by map-side combined totals joined back; safe for any group size."""
    totals = df.groupBy(*keys).agg(F.sum(value).alias("__total"))
    return df.join(totals, keys, "left").withColumn(name, ratio(F.col(value), F.col("__total"))).drop("__total")


def fold_of(key: Column, folds: int = 3) -> Column:
    """Fold of a key: all rows of a key share it, whatever their number or order."""
    return F.pmod(F.xxhash64(key), F.lit(folds)).cast("int")


def contiguous_folds(df: DataFrame, order_by: list[str], folds: int = 3, name: str = "fold") -> DataFrame:
    """Contiguous, equally sized folds in the given order, without a single-task sort.

    Rows are range-partitioned and sorted; each partition numbers its rows and adds the count
    of the partitions before it, which is a table with one row per partition.
    """
    from tenderline.session import materialise

    ordered = materialise(
        df.repartitionByRange(*[F.col(c) for c in order_by])
        .withColumn("__part", F.spark_partition_id()), "folds",
    )
    sizes = ordered.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    total = sizes.agg(F.sum("__n").alias("__total"))
    within = Window.partitionBy("__part").orderBy(*order_by)
    big = F.col("__total") % folds
    base = F.floor(F.col("__total") / folds)
    at = F.col("__before") + F.row_number().over(within) - 1
    edge = big * (base + 1)
    fold = F.when(at < edge, F.floor(at / (base + 1))).otherwise(big + F.floor((at - edge) / F.greatest(base, F.lit(1))))
    return (
        ordered.join(F.broadcast(before), "__part")
        .crossJoin(F.broadcast(total))
        .withColumn(name, fold.cast("int"))
        .drop("__part", "__before", "__total")
    )

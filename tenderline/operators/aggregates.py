"""Group results built from partial aggregates, so that no group is ever held whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tenderline.functions.scalars import ratio


def least_first(count: Column, value: Column) -> Column:
    """Aggregate: the value with the largest count, the smallest value on ties."""
    return F.min(F.struct((-count).alias("n"), value.alias("v")))["v"]


def modal_int(count: Column, value: Column) -> Column:
    """Aggregate: the same for an integer value, packed with its count into one long.

    A fixed-width buffer keeps the aggregation hash-based and compiled.
    """
    packed = F.min(F.when(value.isNotNull(), F.shiftleft(-count.cast("long"), 32) + value.cast("long") + 2147483648))
    return (packed.bitwiseAND(F.lit(4294967295)) - 2147483648).cast("int")


def largest_label(totals: dict[str, Column]) -> Column:
    """Label with the largest total among a known, short list; ties go to the smallest label.

    A label whose total is NULL does not take part.
    """
    labels = sorted(totals)
    top = F.greatest(*[totals[label] for label in labels])
    chosen = None
    for label in labels:
        chosen = (F if chosen is None else chosen).when(totals[label] == top, F.lit(label))
    return chosen


def modal_values(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Most frequent value per key for several columns of one type; ties go to the smallest.

    All columns are counted in one pass: (column, value) pairs are counted first (map-side
    combined), then the best pair per column is kept.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(v).alias("name"), F.col(v).alias("value")) for v in values]))
    counts = (
        df.select(*keys, pairs.alias("p"))
        .where(F.col("p.value").isNotNull())
        .groupBy(*keys, F.col("p.name").alias("name"), F.col("p.value").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = [
        F.expr(f"min(struct(-n AS n, value AS v)) FILTER (WHERE name = '{v}')")["v"].alias(v) for v in values
    ]
    return counts.groupBy(*keys).agg(*best)


def top_label(df: DataFrame, keys: list[str], label: str, weight: Column, name: str) -> DataFrame:
    """Label with the largest total weight per key (two-level argmax); ties go to the smallest label."""
    totals = df.groupBy(*keys, label).agg(F.sum(weight).alias("__w")).where(F.col("__w").isNotNull() & F.col(label).isNotNull())
    return totals.groupBy(*keys).agg(least_first(F.col("__w"), F.col(label)).alias(name))


def weighted_mean(value: Column, weight: Column) -> Column:
    """Aggregate: sum(w*x)/sum(w); NULL for zero weight."""
    return ratio(F.sum(value * weight), F.sum(weight))


def first_known(df: DataFrame, keys: list[str], values: list[str], order_by: str) -> DataFrame:
    """First non-null value of every column per key, in the order of ``order_by``."""
    picks = [F.expr(f"min_by(`{v}`, `{order_by}`) FILTER (WHERE `{v}` IS NOT NULL)").alias(v) for v in values]
    return df.groupBy(*keys).agg(*picks)


def rows_at_top(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Rows at their key's largest value; the maximum is combined map-side and semi-joined."""
    tops = df.groupBy(*keys).agg(F.max(value).alias(value)).where(F.col(value).isNotNull())
    return df.join(tops, [*keys, value], "left_semi")


def largest_of_each(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def conditional_sum(condition: Column, value: Column, otherwise: float | None = 0.0) -> Column:
    """Aggregate: sum over the rows that meet the condition."""
    other = F.lit(None).cast("double") if otherwise is None else F.lit(otherwise)
    return F.sum(F.when(condition, value).otherwise(other))


def concentration(share: Column) -> Column:
    """Aggregate: sum of squared shares."""
    return F.sum(share * share)


def column_means(df: DataFrame, values: list[str]) -> DataFrame:
    return df.agg(*[F.avg(v).alias(v) for v in values])


def missing_counts(df: DataFrame) -> DataFrame:
    """Missing cells per column, in one pass, as (column, missing) rows."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(f"`{c}`").alias("missing")) for c in df.columns])).alias("r")).select("r.*")


def stacked(frames: list[DataFrame]) -> DataFrame:
    """Union by name; columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)

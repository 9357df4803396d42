"""Join shapes that need more than a plain equi join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BROADCAST_LIMIT = 64 * 1024 * 1024
SALTS = 64


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimiser's size estimate, None where the session does not show it."""
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return None


def is_small(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    size = estimated_bytes(df)
    return size is not None and size <= limit


def lookup(facts: DataFrame, dim: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_LIMIT) -> DataFrame:
    """Equi join to a lookup table, broadcast only if its estimated size is below the limit.

    A larger table is joined by a shuffle, where AQE splits skewed keys.
    """
    return facts.join(F.broadcast(dim) if is_small(dim, limit) else dim, on, how)


def _inside(value: Column, low: Column, high: Column, closed: str) -> Column:
    above = value >= low if closed == "left" else value > low
    below = value <= high if closed == "right" else value < high
    return above & below


def range_lookup(
    facts: DataFrame,
    bands: DataFrame,
    on: list[str],
    value: str,
    low: str,
    high: str,
    closed: str = "right",
    how: str = "inner",
    limit: int = BROADCAST_LIMIT,
    salts: int = SALTS,
) -> DataFrame:
    """Join each row to the band that holds its value.

    ``closed`` names the end that belongs to the band: 'right' is (low, high],
    'left' is [low, high), 'none' is (low, high). A NULL ``high`` is an open end.

    Bands below the size limit are broadcast. Larger ones are joined on the equality
    columns plus a salt computed from the row, so that a value of ``on`` that holds a
    large part of the facts is spread over ``salts`` tasks; bands are repeated per salt.
    """
    renamed = bands.select(*[F.col(c).alias(f"__{c}" if c in on else c) for c in bands.columns])
    match = [facts[c] == renamed[f"__{c}"] for c in on]
    top = F.coalesce(renamed[high], F.lit(float("inf")))
    within = _inside(facts[value], renamed[low], top, closed)
    if is_small(bands, limit):
        joined = facts.join(F.broadcast(renamed), reduce(Column.__and__, match + [within]), how)
        return joined.drop(*[f"__{c}" for c in on])
    salted = facts.withColumn("__salt", F.pmod(F.xxhash64(*facts.columns), F.lit(salts)))
    spread = renamed.withColumn("__band_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    match = [salted[c] == spread[f"__{c}"] for c in on] + [salted["__salt"] == spread["__band_salt"]]
    top = F.coalesce(spread[high], F.lit(float("inf")))
    within = _inside(salted[value], spread[low], top, closed)
    joined = salted.join(spread, reduce(Column.__and__, match + [within]), how)
    return joined.drop("__salt", "__band_salt", *[f"__{c}" for c in on])


def breaks_to_bands(breaks: DataFrame, keys: list[str], at: str, low: str = "low", high: str = "high") -> DataFrame:
    """Turn ordered breaks into bands for 'first break >= value, else the last break'.

    Each break becomes (previous break, break]; the last one is open-ended. The window is
    over the break table only, which is a small lookup.
    """
    order = Window.partitionBy(*keys).orderBy(at)
    return (
        breaks.withColumn(low, F.coalesce(F.lag(at).over(order), F.lit(float("-inf"))))
        .withColumn(high, F.when(F.lead(at).over(order).isNull(), F.lit(None)).otherwise(F.col(at)).cast("double"))
    )


def only_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in the list, each once."""
    return df.join(listed.select(*on).distinct() if not is_small(listed) else F.broadcast(listed.select(*on)), on, "left_semi")


def except_listed(df: DataFrame, listed: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is not in the list; rows with a missing key stay."""
    return df.join(F.broadcast(listed.select(*on)) if is_small(listed) else listed.select(*on), on, "left_anti")


def known_or_predicted(rows: DataFrame, known: DataFrame, on: list[str], name: str, predicted: Column) -> DataFrame:
    """Left join a table of known values by key and use the prediction where there is none."""
    side = known.select(*on, F.col(name).alias("__known"))
    return rows.join(side, on, "left").withColumn(name, F.coalesce("__known", predicted)).drop("__known")

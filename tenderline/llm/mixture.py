"""Mixing sources to target weights by weighted fair queueing.

Every document stands in its source's shuffled queue, once per pass over the source. Its
virtual finish time is the source's words up to and including it, divided by the source's
target. All queues are merged by finish time, and the merged order is cut at the budget.

No source is gathered in one task. Running sums come from 4096 hash buckets per source: sums
per bucket, their running total (small rows), and a window inside each bucket. The cut is found
by two histograms of finish times, of bounded size, and one window over the rows of a single
histogram cell.

Defined cases: a null text has size 0 and takes 0; a null source is a source of its own, last in
order; null ids are shuffled together; repeated rows are separate documents, each with its own
place; an empty table gives an empty result. Columns of other names are ignored unless ``keep``
names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline.llm.common import words, written

#: Cells per unit of finish time, cells in all, and cells that split the cell of the cut.
CELLS, LAST_CELL, FINE = 1024, 16383, 4096
_ORDER = ["finish", "source_rank", "key", "id_order", "lap"]


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2) -> DataFrame:
    """Words to take of each source: (source, source_size, source_rank, target).

    ``sizes`` has one row per source. The budget, ``share`` of all words, is dealt by weight;
    where that exceeds ``most`` times a source, the source stops there and the rest is dealt
    again. With sources ordered by cap per weight, those before the first that stays under its
    cap are capped.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    before = Window.orderBy("fill", "source_rank").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.orderBy("fill", "source_rank").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    weight = F.get(F.array(*[F.lit(w) for w in weights]), ((F.col("source_rank") - 1) % len(weights)).cast("int"))
    level = (F.lit(share) * F.col("total") - F.coalesce(F.col("capped"), F.lit(0))) / F.col("weight_left")
    return (
        sizes.withColumn("source_rank", F.row_number().over(by_name))
        .withColumn("weight", weight)
        .withColumn("fill", (F.lit(most) * F.col("source_size")).cast("double") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("capped", F.sum(F.lit(most) * F.col("source_size")).over(before))
        .withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("fill") > F.col("level"), F.struct("fill", "source_rank", "level"))).over(everything)["level"])
        .withColumn("target", F.least((F.lit(most) * F.col("source_size")).cast("double"), F.coalesce(F.col("weight") * F.col("level"), F.lit(float("inf")))))
        .select("source", "source_size", "source_rank", "target")
    )


def _place(finish: Column) -> Column:
    return F.least(F.floor(finish * CELLS), F.lit(LAST_CELL)).cast("int")


def _within(finish: Column) -> Column:
    """Which part of its cell a finish time lies in; the open last cell is one part."""
    cell = F.floor(finish * CELLS)
    return F.when(cell >= LAST_CELL, F.lit(0)).otherwise(F.floor((finish * CELLS - cell) * FINE)).cast("int")


def _first_over(cells: DataFrame, room: int) -> tuple[int | None, int]:
    """First cell whose running total passes ``room``, and what the cells before it leave."""
    for cell, size in sorted(cells.collect()):
        if size > room:
            return cell, room
        room -= size
    return None, room


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2, seed: str = "mix", keep: list[str] | None = None) -> DataFrame:
    """Documents with ``size``, ``source_size``, ``target`` and the words the mix takes, ``taken``.

    ``taken`` is 0, 1 or up to ``most`` times the size. ``keep`` names the columns of ``docs`` to
    carry along (default doc_id only).
    """
    keep = ["doc_id"] if keep is None else keep
    carried = [F.col(c).alias(f"kept_{i}") for i, c in enumerate(keep)]
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sized = docs.select(
        *carried, F.col("source").alias("source"), F.coalesce(F.col("doc_id"), F.lit(-1)).cast("bigint").alias("id_order"),
        F.size(words(F.col("text"))).cast("bigint").alias("size"), key.alias("key"),
    ).withColumn("bucket", F.substring("key", 1, 3))
    sized = written(sized, "mix-sized")
    per_bucket = written(sized.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size")), "mix-buckets")
    plan = targets(per_bucket.groupBy("source").agg(F.sum("bucket_size").alias("source_size")), weights, share, most)
    plan = written(plan, "mix-targets")
    ahead = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.withColumn("ahead", F.coalesce(F.sum("bucket_size").over(ahead), F.lit(0)))
    offsets = offsets.join(plan, offsets["source"].eqNullSafe(plan["source"])).select(
        offsets["source"].alias("of_source"), F.col("bucket").alias("of_bucket"), "ahead", "source_size", "source_rank", "target"
    )
    queue = Window.partitionBy("source", "bucket").orderBy("key", "id_order", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    queued = sized.withColumn("cum", F.sum("size").over(queue))
    queued = queued.join(offsets, queued["source"].eqNullSafe(F.col("of_source")) & (F.col("bucket") == F.col("of_bucket")))
    queued = queued.withColumn("cum", F.col("cum") + F.col("ahead")).drop("of_source", "of_bucket", "ahead", "bucket")
    queued = written(queued, "mix-queued")

    laps = range(most)
    finish = [F.try_divide((F.col("source_size") * lap + F.col("cum")).cast("double"), F.col("target")) for lap in laps]
    items = queued.where("size > 0").select(
        "source_rank", "key", "id_order", "size", F.explode(F.array(*[F.struct(F.lit(lap).alias("lap"), finish[lap].alias("finish")) for lap in laps])).alias("at")
    ).select("source_rank", "key", "id_order", "size", "at.lap", "at.finish")
    total = plan.agg(F.sum("source_size")).first()[0] or 0
    room = int(share * total)
    cell, room = _first_over(items.groupBy(_place(F.col("finish")).alias("cell")).agg(F.sum("size").alias("size")), room)
    last = None
    part = None
    if cell is not None:
        there = items.where(_place(F.col("finish")) == cell)
        part, room = _first_over(there.groupBy(_within(F.col("finish")).alias("part")).agg(F.sum("size").alias("size")), room)
        merged = Window.orderBy(*_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        there = there.where(_within(F.col("finish")) == part).withColumn("run", F.sum("size").over(merged))
        last = there.where(F.col("run") <= room).agg(F.max(F.struct(*_ORDER)).alias("last")).first()["last"]

    def taken(lap: int) -> Column:
        if cell is None:
            return F.lit(True)
        own = F.struct(finish[lap].alias("finish"), "source_rank", "key", "id_order", F.lit(lap).alias("lap"))
        up_to = F.lit(False) if last is None else own <= F.struct(F.lit(last.finish), F.lit(last.source_rank), F.lit(last.key), F.lit(last.id_order).cast("bigint"), F.lit(last.lap))
        place, within = _place(finish[lap]), _within(finish[lap])
        return (place < cell) | ((place == cell) & ((within < part) | ((within == part) & up_to)))

    times = sum((F.coalesce(taken(lap), F.lit(False)).cast("bigint") for lap in laps), F.lit(0))
    back = [F.col(f"kept_{i}").alias(c) for i, c in enumerate(keep)]
    return queued.select(*back, "size", "source_size", "target", (F.col("size") * times).alias("taken"))


#: DuckDB SQL of the same mix over the table documents.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(doc_id, -1) AS id_order, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS key,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS source_rank FROM sources),
weighted AS (SELECT *, [5, 2, 1][(source_rank - 1) % 3 + 1] AS weight FROM ranked),
filled AS (SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS fill, sum(source_size) OVER () AS total FROM weighted),
levels AS (
  SELECT *, (1.5::DOUBLE * total - coalesce(sum(2 * source_size) OVER (ORDER BY fill, source_rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(weight) OVER (ORDER BY fill, source_rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM filled),
chosen AS (SELECT level FROM levels WHERE fill > level ORDER BY fill, source_rank LIMIT 1),
planned AS (
  SELECT source, source_size, source_rank, least(CAST(2 * source_size AS DOUBLE), coalesce(weight * (SELECT level FROM chosen), 'inf'::DOUBLE)) AS target
  FROM levels),
queued AS (
  SELECT s.doc_id, s.id_order, s.key, s.size, p.source_size, p.source_rank, p.target,
         sum(s.size) OVER (PARTITION BY p.source_rank ORDER BY s.key, s.id_order, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum,
         row_number() OVER () AS row
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
items AS (
  SELECT row, source_rank, key, id_order, size, lap, CAST(source_size * lap + cum AS DOUBLE) / target AS finish
  FROM queued, (VALUES (0), (1)) AS laps(lap) WHERE size > 0),
merged AS (
  SELECT row, size, sum(size) OVER (ORDER BY finish, source_rank, key, id_order, lap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run
  FROM items),
taken AS (
  SELECT row, sum(size) AS taken FROM merged WHERE run <= floor(1.5::DOUBLE * (SELECT sum(size) FROM sized)) GROUP BY row)
SELECT doc_id, size, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queued LEFT JOIN taken USING (row)
"""

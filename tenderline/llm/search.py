"""Ranked lexical search: top documents per query item, pruned LEMP-style by norm buckets.

Scoring (all integers but the term weight). Terms are the maximal runs of ASCII letters and digits
and non-ASCII characters, only A-Z lower-cased. N counts documents with a term, L all their terms,
n one document's terms, df the documents holding a term, tf its count in a document.

    w(t)   = floor(1000 * ln((2N + 2) / (2 df + 1)))                     (double, then floored)
    m(d)   = 10 + (90 n N) div L
    imp    = (10^9 tf) div (1000 tf + 8 m)                                (a document's impact)
    score  = sum over the item's distinct terms of w * imp

So a score is the inner product of the item's weight vector with the document's impact vector.

Method. Documents are ordered by the length (norm) of their impact vector restricted to the terms
that any item uses and cut into buckets: a geometric norm class (ratio ``GROWTH``) split by a
hash into slices of about ``BUCKET_ROWS`` rows, so no bucket is hot whatever the data. For each
bucket the largest norm and, per term, the largest impact are kept. An (item, bucket) pair has
two bounds on any score inside: Cauchy-Schwarz, |q| * max |d|, and the coordinate bound,
sum_t w_t * max imp_t; the smaller counts. First round: per item, its ``FIRST_BUCKETS`` buckets
of largest bound are scored exactly, which gives theta, the item's 10th best score so far (1 if
fewer than 10 are positive). Second round: every other pair whose bound reaches theta is scored
exactly; all others cannot enter the top 10 (a bound below theta is below 10 known scores), so
the result is exact. Exact scoring scans the bucket's inverted lists of the item's terms and sums
w * imp in 64-bit integers per (item, document).

Scale: occurrences of terms that no item uses are dropped by a semi join with the items'
vocabulary (a stated query set) before any shuffle; postings are then built by one aggregate and
written, which also fixes row numbers; df is a map-side combined count; texts are read once, as every
document also has a posting of ``MARK``, whose term counts give N and L; the term join of
items with bucket maxima is salted over ``SALT`` slices, so a term in every bucket and every item
is spread; every exact join is placed by bucket, at most a bucket of rows, where scores below theta
and those behind a bucket's 10 best for an item are dropped at once; the top 10 per item are then
taken in two steps (per item and hash slice, then per item) so no item's candidates meet in one
task. The norm classes (a few dozen rows) are the only rows on the driver.

Defined cases: a null or term-less text has no terms (not counted in N); queries are item_ids,
with the distinct terms of all their rows (a null item_id is one item); an item without terms, or
with terms that no document holds, has no rows; repeated documents are ranked each, equal scores
by ascending doc_id (then by row); fewer than 10 documents above 0 give fewer rows; an empty
table gives no rows; other columns do not matter.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline.llm.common import written

TOP = 10
BUCKET_ROWS = 4096
GROWTH = 1.25
FIRST_BUCKETS = 4
SALT = 64
#: Fixed value: the characters that end a term (ASCII but letters and digits).
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Posting of every document, with or without terms; no term is empty.
MARK = ""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """The terms of a text, in order, with repeats; empty for null."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), 0)


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("doc_id").asc_nulls_first(), F.col("row").asc()]


def _top(scored: DataFrame, key: str) -> DataFrame:
    """The TOP rows per ``key`` by score descending, doc_id, row; in two steps."""
    first = scored.withColumn("slice", F.pmod(F.xxhash64("row"), F.lit(SALT)))
    first = first.withColumn("r", F.row_number().over(Window.partitionBy(key, "slice").orderBy(*_order()))).where(f"r <= {TOP}").drop("r", "slice")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*_order()))).where(f"rank <= {TOP}")


def _exact(pairs: DataFrame, weights: DataFrame, postings: DataFrame) -> DataFrame:
    """Exact scores of the (q, bucket, theta) pairs that reach theta, at most TOP per pair.

    Scans the bucket's lists of the item's terms. Lists and postings are placed by bucket, and a row
    is in one bucket, so the parts of its score are summed and ranked where they are made: they
    outnumber everything else and are never shuffled.
    """
    lists = pairs.join(weights, "q").select("q", "bucket", "theta", "term", "w").repartition("bucket")
    placed = postings.select("bucket", "term", "row", "doc_id", "imp").repartition("bucket")
    hits = lists.join(placed, ["bucket", "term"])
    scored = hits.groupBy("bucket", "q", "theta", "row", "doc_id").agg(F.sum(F.col("w") * F.col("imp")).alias("score")).where("score >= theta")
    own = Window.partitionBy("bucket", "q").orderBy(*_order())
    return scored.withColumn("r", F.row_number().over(own)).where(f"r <= {TOP}").select("q", "row", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame) -> DataFrame:
    """item_id, rank (1..10), doc_id, score: each item's best documents with score above 0."""
    found_terms = docs.select(F.col("doc_id"), terms(F.col("text")).alias("terms"))
    keyed = written(items.select("item_id").distinct().withColumn("q", F.monotonically_increasing_id()), "search-keys")
    found = items.select(F.col("item_id").alias("key"), F.explode(terms(F.col("text"))).alias("term"))
    queries = written(found.join(keyed, F.col("key").eqNullSafe(keyed["item_id"])).select("item_id", "q", "term").distinct(), "search-items")
    # joins by bucket and term then use that rows are placed by bucket (see _exact)
    docs.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    # Only terms that some item uses matter for df, tf and impacts: they are kept before any shuffle.
    vocabulary = queries.select("term").unionByName(docs.sparkSession.range(1).select(F.lit(MARK).alias("term"))).distinct()
    occurrences = found_terms.withColumn("row", F.monotonically_increasing_id()).select(
        "row", "doc_id", F.size("terms").cast("long").alias("n"), F.explode(F.concat(F.array(F.lit(MARK)), "terms")).alias("term")
    ).join(vocabulary, "term", "left_semi")
    counts = written(occurrences.groupBy("row", "doc_id", "n", "term").agg(F.count(F.lit(1)).alias("tf")), "search-counts")
    totals = counts.where(F.col("term") == MARK).agg(F.count(F.when(F.col("n") > 0, 1)).alias("n_docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_terms")).first()
    big_n, big_l = int(totals["n_docs"]), int(totals["n_terms"])
    if big_n == 0:
        return queries.select("item_id", F.lit(0).alias("rank"), F.lit(None).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    counts = counts.where(F.col("term") != MARK)
    frequency = counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weights = written(
        queries.join(frequency, "term", "left").select(
            "q", "term",
            F.floor(F.lit(1000.0) * F.log((2.0 * big_n + 2.0) / (2.0 * F.coalesce(F.col("df"), F.lit(0)).cast("double") + 1.0))).cast("long").alias("w"),
        ),
        "search-weights",
    )
    m = F.lit(10) + F.expr(f"(90 * n * {big_n}) div {big_l}")
    impacts = counts.select("row", "doc_id", "term", "tf", m.alias("m"))
    impacts = impacts.select("row", "doc_id", "term", F.expr("(1000000000 * tf) div (1000 * tf + 8 * m)").alias("imp"))
    norms = impacts.groupBy("row").agg(F.sqrt(F.sum(F.col("imp").cast("double") * F.col("imp"))).alias("norm"))
    norms = norms.withColumn("class", F.coalesce(F.floor(F.log(GROWTH, F.col("norm"))).cast("long"), F.lit(-1000)))
    classes = {r["class"]: r["count"] for r in norms.groupBy("class").count().collect()}
    slices = F.lit(1)
    for c, count in classes.items():
        slices = F.when(F.col("class") == c, F.lit(max(1, math.ceil(count / BUCKET_ROWS)))).otherwise(slices)
    norms = norms.withColumn("bucket", F.col("class") * F.lit(1 << 20) + F.pmod(F.xxhash64("row"), slices))
    postings = written(impacts.join(norms.select("row", "bucket", "norm"), "row"), "search-postings")
    buckets = postings.groupBy("bucket").agg(F.max("norm").alias("top_norm"))
    maxima = postings.groupBy("bucket", "term").agg(F.max("imp").alias("top_imp"))
    length = weights.groupBy("q").agg(F.sqrt(F.sum(F.col("w").cast("double") * F.col("w"))).alias("q_norm"))
    salted = weights.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    coordinate = salted.join(maxima.withColumn("salt", F.pmod(F.col("bucket"), F.lit(SALT))), ["term", "salt"])
    bounds = coordinate.groupBy("q", "bucket").agg(F.sum(F.col("w") * F.col("top_imp")).alias("coord"))
    bounds = written(
        bounds.join(buckets, "bucket").join(length, "q").select(
            "q", "bucket", F.least(F.col("coord").cast("double"), F.col("q_norm") * F.col("top_norm")).alias("bound")
        ),
        "search-bounds",
    )
    order = Window.partitionBy("q", "slice").orderBy(F.col("bound").desc(), "bucket")
    best = bounds.withColumn("slice", F.pmod(F.col("bucket"), F.lit(SALT))).withColumn("r", F.row_number().over(order)).where(f"r <= {FIRST_BUCKETS}")
    best = best.withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.col("bound").desc(), "bucket"))).where(f"r <= {FIRST_BUCKETS}").select("q", "bucket")
    least = F.lit(1).cast("long")  # of a score above 0
    first = written(_top(_exact(best.withColumn("theta", least), weights, postings), "q").drop("rank"), "search-first")
    theta = first.groupBy("q").agg(F.count(F.lit(1)).alias("found"), F.min("score").alias("tenth"))
    theta = theta.select("q", F.when(F.col("found") >= TOP, F.col("tenth")).otherwise(least).alias("theta"))
    rest = bounds.join(best, ["q", "bucket"], "left_anti").join(theta, "q", "left").withColumn("theta", F.coalesce("theta", least))
    rest = rest.where(F.col("bound") >= F.col("theta")).select("q", "bucket", "theta")
    top = _top(first.unionByName(_exact(rest, weights, postings)), "q")
    return top.join(keyed, "q").select(keyed["item_id"], F.col("rank").cast("int"), "doc_id", F.col("score").cast("long"))


def oracle(terms_sql: str = "regexp_extract_all(translate(coalesce(text, ''), '{u}', '{l}'), '{p}')") -> str:
    """DuckDB SQL of the same ranking by brute force."""
    t = terms_sql.format(u=UPPER, l=LOWER, p=TERM)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {t} AS terms FROM documents),
s AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS big_n, sum(len(terms)) AS big_l FROM d),
p AS (SELECT r, t AS term, count(*) AS tf FROM (SELECT r, unnest(terms) AS t FROM d) GROUP BY r, t),
f AS (SELECT term, count(*) AS df FROM p GROUP BY term),
q AS (SELECT DISTINCT item_id, t AS term FROM (SELECT item_id, unnest({t}) AS t FROM benchmark)),
w AS (SELECT q.item_id, q.term, CAST(floor(1000 * ln((2.0 * s.big_n + 2) / (2.0 * coalesce(f.df, 0) + 1))) AS BIGINT) AS w
      FROM q CROSS JOIN s LEFT JOIN f ON q.term = f.term),
m AS (SELECT d.r, d.doc_id, 10 + (90 * len(d.terms) * s.big_n) // s.big_l AS m FROM d CROSS JOIN s WHERE len(d.terms) > 0),
sc AS (SELECT w.item_id, m.doc_id, m.r, sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * m.m))) AS score
       FROM w JOIN p ON w.term = p.term JOIN m ON m.r = p.r GROUP BY w.item_id, m.doc_id, m.r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS FIRST, r) AS rank
      FROM sc WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= {TOP}
"""

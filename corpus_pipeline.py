"""A training-data pipeline over documents: quality rules, near duplicates, personal data, mixture, encoding.

Each stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept; all but
the last return the columns of documents. ``run`` writes every stage's result to the shared folder
and reads it back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tenderline.llm import mixture, near, personal, pieces, quality
from tenderline.llm.common import prepare, table, written
from tenderline.llm.queries import piece_model


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the outlier rule accept."""
    return quality.judge(docs, docs.columns).where("kept").select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    prepare(spark)
    return near.one_of_each_group(docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with every span of personal data replaced by its kind."""
    prepare(spark)
    found = personal.find(docs, [c for c in docs.columns if c != "text"], personal.fit(docs))
    return found.withColumnRenamed("redacted", "text").withColumn("n_chars", F.char_length("text").cast("bigint")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them."""
    named = docs.withColumn("mixed_row", F.xxhash64("doc_id", "source", "text"))
    times = mixture.mix(named, keep=["mixed_row"]).where("taken > 0").groupBy("mixed_row").agg(F.sum(F.expr("taken div size")).alias("times"))
    taken = named.dropDuplicates(["mixed_row"]).join(times, "mixed_row")
    return taken.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("times")))).select(docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, lang, source, ids, n_tokens): token ids with an end id."""
    prepare(spark)
    return pieces.encode(docs, piece_model(), ["doc_id", "lang", "source"]).withColumn("n_tokens", F.size("ids").cast("bigint"))


STAGES = [
    ("quality", keep_good),
    ("near duplicates", keep_one_of_each_group),
    ("personal data", hide_personal_data),
    ("mixture", mix_sources),
    ("pieces", encode_texts),
]

#: SQL can express neither the tagger nor the piece model; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs

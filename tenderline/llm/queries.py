"""Registered queries of this subpackage: each operator over its whole table, with check SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tenderline.llm import bytepairs, language, manifest, merkle, mixture, near, personal, pieces, quality, repeats, search, template, warc
from tenderline.llm.common import fresh_path, prepare, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return language.predict_held_out(table(spark, sf_dir, "documents"))


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return merkle.compare_with_next(table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    return judged.drop("distance")


def op4_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return warc.round_trip(table(spark, sf_dir, "pages"), fresh_path(spark, "archive"))


def op5_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op6_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return personal.digests(table(spark, sf_dir, "documents"))


def op7_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near.components(table(spark, sf_dir, "documents"))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return pieces.digests(table(spark, sf_dir, "documents"), piece_model())


def op9_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return template.extract(table(spark, sf_dir, "pages"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return repeats.digests(table(spark, sf_dir, "documents"))


def op11_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return manifest.manifest(table(spark, sf_dir, "documents"))


def byte_pair_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op13_bytepairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return bytepairs.digests(table(spark, sf_dir, "documents"), byte_pair_model())


def registry() -> dict[str, tuple[Query, str | None]]:
    import corpus_pipeline

    return {
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
        "op1_language": (op1_language, None),
        "op2_fingerprints": (op2_fingerprints, None),
        "op3_quality": (op3_quality, quality.judge_sql()),
        "op4_archive": (op4_archive, warc.WARC_SQL),
        "op5_mixture": (op5_mixture, mixture.MIX_SQL),
        "op6_personal": (op6_personal, None),
        "op7_near": (op7_near, near.NEAR_SQL),
        "op8_pieces": (op8_pieces, None),
        "op9_extract": (op9_extract, None),
        "op10_repeats": (op10_repeats, repeats.REPEATS_SQL),
        "op11_search": (op11_search, search.oracle()),
        "op12_manifest": (op12_manifest, None),
        "op13_bytepairs": (op13_bytepairs, None),
    }

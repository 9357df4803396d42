import hashlib
import re
from collections import Counter

import duckdb
import pandas as pd
import pytest
from pyspark.sql import types as T

import corpus_pipeline
from tenderline.llm import mixture, personal, quality
from tests.llm.test_near import by_brute_force

sentencepiece = pytest.importorskip("sentencepiece")


def rows_of(frame, table, sql):
    con = duckdb.connect()
    con.register(table, frame)
    return con.execute(sql).df()


def test_stages_against_plain_versions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plain = docs.toPandas()
    verdict = rows_of(plain, "documents", quality.judge_sql())
    kept = set(verdict[verdict["kept"]]["doc_id"])
    step = corpus_pipeline.keep_good(spark, docs, "")
    assert step.columns == docs.columns
    assert {r.doc_id for r in step.select("doc_id").collect()} == kept
    step = spark.createDataFrame(plain[plain["doc_id"].isin(kept)], docs.schema)
    rows = [(r.doc_id, r.text) for r in step.select("doc_id", "text").collect()]
    first = {c for _, n, c in by_brute_force(rows) if n}
    step2 = corpus_pipeline.keep_one_of_each_group(spark, step, "")
    assert step2.columns == docs.columns and {r.doc_id for r in step2.select("doc_id").collect()} == first
    frame = plain[plain["doc_id"].isin(first)].reset_index(drop=True)
    step = spark.createDataFrame(frame, docs.schema)
    tagger = personal.fit(step)
    both = personal.all_spans(list(frame["text"]), tagger)
    frame["text"] = [personal.redacted(t, spans) for t, (_, spans) in zip(frame["text"], both)]
    frame["n_chars"] = frame["text"].str.len()
    step3 = corpus_pipeline.hide_personal_data(spark, step, "")
    assert step3.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars, r.lang, r.source) for r in step3.collect()}
    assert got == {r.doc_id: (r.text, r.n_chars, r.lang, r.source) for r in frame.itertuples()}
    assert not any(personal.base_spans(t) for t in frame["text"])
    mixed = rows_of(frame, "documents", mixture.MIX_SQL)
    want = Counter({r.doc_id: r.taken // r.size for r in mixed.itertuples() if r.taken})
    step = spark.createDataFrame(frame, docs.schema)
    step4 = corpus_pipeline.mix_sources(spark, step, "")
    assert step4.columns == docs.columns and Counter(r.doc_id for r in step4.select("doc_id").collect()) == want
    library = sentencepiece.SentencePieceProcessor(model_file=corpus_pipeline.piece_model())
    texts = dict(zip(frame["doc_id"], frame["text"]))
    last = corpus_pipeline.encode_texts(spark, step4, "").collect()
    assert len(last) == sum(want.values())
    assert all(list(r.ids) == library.encode(texts[r.doc_id], add_eos=True) and r.n_tokens == len(r.ids) for r in last)
    # all of it in one run
    whole = Counter((r.doc_id, hashlib.sha256(str(list(r.ids)).encode()).hexdigest()) for r in corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect())
    assert whole == Counter((r.doc_id, hashlib.sha256(str(list(r.ids)).encode()).hexdigest()) for r in last)


def test_odd_rows_go_through_every_stage(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
    good = " ".join(f"word{i} of{i % 7} text{i % 11}" for i in range(60))
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, good, "en", "a", 1), (3, good, "en", "a", 1), (4, good + " x", None, None, 2), (None, good.upper() + " other ending of it", "de", None, 3), (6, " ".join(f"k{i}" for i in range(70)), None, "b", 0)]
    docs = spark.createDataFrame(rows, schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns, name
        out.collect()
        assert stage(spark, docs.limit(0), "").count() == 0
    assert len(corpus_pipeline.encode_texts(spark, docs, "").collect()) == len(rows)
    assert [re.sub(r"\s", "", name) for name, _ in corpus_pipeline.STAGES] == ["quality", "nearduplicates", "personaldata", "mixture", "pieces"]
    assert isinstance(docs.toPandas(), pd.DataFrame)

import duckdb
import pandas as pd
import pytest

from tenderline.llm import search

DOCS = "doc_id bigint, text string, lang string"
ITEMS = "item_id bigint, text string"


def brute(docs, items):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text", "lang"]).astype({"doc_id": "Int64"}))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]).astype({"item_id": "Int64"}))
    rows = con.sql(search.oracle()).fetchall()
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def got(spark, docs, items, extra=False):
    d = spark.createDataFrame(docs, DOCS)
    q = spark.createDataFrame(items, ITEMS)
    if extra:
        d = d.selectExpr("*", "1 AS row", "2 AS terms", "3 AS bucket", "4 AS imp", "5 AS q", "6 AS score")
        q = q.selectExpr("*", "1 AS q", "2 AS term", "3 AS w")
    rows = [tuple(r) for r in search.search(d, q).collect()]
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


WORDS = ["alpha", "Beta", "gamma", "delta", "épée", "x1", "Zeta", "eta", "theta", "iota", "kappa", "lambda"]


def corpus(n):
    import random

    rng = random.Random(3)
    docs = []
    for i in range(n):
        k = rng.randrange(0, 40)
        docs.append((i % 97 if i % 13 else None, " ".join(rng.choice(WORDS) for _ in range(k)) + rng.choice(["", ".", ", THETA!"]), "en"))
    docs += [docs[5], docs[5], (None, None, None), (1000, "", "de"), (1001, "...,,,", "de")]
    items = [(1, "alpha beta"), (2, "THETA kappa kappa"), (3, "nothing here"), (None, "gamma"), (4, None), (5, "épée, x1; lambda"), (1, "iota")]
    return docs, items


def test_matches_brute_force_with_small_buckets(spark, monkeypatch):
    monkeypatch.setattr(search, "BUCKET_ROWS", 7)
    monkeypatch.setattr(search, "FIRST_BUCKETS", 1)
    docs, items = corpus(300)
    want = brute(docs, items)
    assert got(spark, docs, items) == want
    assert got(spark, docs, items, extra=True) == want
    assert {r[0] for r in want} >= {1, 2, None}


def test_ties_order_by_doc_id(spark):
    docs = [(9, "same words here", "en"), (3, "same words here", "en"), (3, "same words here", "en"), (7, "other", "en")]
    items = [(1, "same")]
    result = got(spark, docs, items)
    assert [r[2] for r in result] == [3, 3, 9]
    assert result == brute(docs, items)


def test_empty_tables(spark):
    assert got(spark, [], [(1, "a")]) == []
    assert got(spark, [(1, "a b", "en")], []) == []
    assert got(spark, [(1, None, "en")], [(1, "a")]) == []


def test_documents_are_read_once(spark):
    docs, items = corpus(60)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    d = spark.createDataFrame(docs, DOCS).mapInArrow(counted, DOCS)
    rows = [tuple(r) for r in search.search(d, spark.createDataFrame(items, ITEMS)).collect()]
    assert sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])) == brute(docs, items)
    assert read.value == len(docs)


def test_real_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert got(spark, docs, items) == brute(docs, items)

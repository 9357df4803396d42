import duckdb
import pytest

from tenderline.llm import quality


def compared(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    names = ["doc_id", *quality._BASE, "base_failed", "kept"]
    want = sorted((tuple(None if v != v or str(v) == "<NA>" else v for v in r) for r in con.execute(quality.judge_sql()).df()[names].itertuples(index=False)), key=str)
    got = sorted((tuple(r[n] for n in names) for r in quality.judge(docs).collect()), key=str)
    assert [tuple(map(str, g[1:])) for g in got] == [tuple(map(str, w[1:])) for w in want]
    return got


def plain(text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            for i in places:
                covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


TEXTS = [None, "", " \n\t", "a", "a b", "a b c", "a b c a b c", "a a a a a", "x y z x y z x y", "l\nl\n l\n\nl\r\n", "é 語 😀 #*$%&|<>", "w " * 300, "a\x0bb\x0cc d", "\xa0 nbsp\xa0word"]


def test_base_counts_equal_plain_python(spark):
    docs = spark.createDataFrame([(i, t, "en", "s", "own") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, lang string, source string, the_text string")
    for row in quality.judge(docs).collect():
        assert tuple(row[n] for n in quality._BASE) == plain(TEXTS[row.doc_id]), TEXTS[row.doc_id]
        assert row.base_failed == (row.n_words < 50 or 100 * row.n_repeat_words > 50 * row.n_words)
    assert quality.judge(docs.limit(0)).count() == 0


def test_outliers_go_and_clean_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = quality.judge(docs).join(labels, "doc_id").where("NOT base_failed").groupBy("quality", "kept").count().collect()
    counts = {(r.quality, r.kept): r["count"] for r in rows}
    assert counts.get((1, True)) > 3000 and counts.get((1, False), 0) <= 3
    assert counts.get((0, False)) > 250 and counts.get((0, True), 0) <= 3


def test_verdicts_equal_the_check_sql(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    odd = docs.selectExpr("CASE WHEN doc_id % 7 = 0 THEN NULL ELSE doc_id END AS doc_id", "CASE WHEN doc_id % 50 = 0 THEN NULL ELSE text END AS text", "CASE WHEN doc_id % 9 = 0 THEN NULL ELSE lang END AS lang", "CASE WHEN doc_id % 11 < 2 THEN NULL ELSE source END AS source")
    got = compared(spark, odd)
    assert len(got) == 1000 and any(g[-1] for g in got)


@pytest.mark.parametrize("rows", [3, 20])
def test_small_tables_reject_by_base_limits_only(spark, rows):
    text = " ".join(f"word{i}" for i in range(80))
    docs = spark.createDataFrame([(i, text if i else text.replace("w", "#w"), None, None) for i in range(rows)], "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert all(kept[i] for i in range(1, rows)) and (rows > 3 or kept[0])

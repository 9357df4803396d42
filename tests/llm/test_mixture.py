import duckdb

from tenderline.llm import mixture


def check(spark, docs):
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    names = ["doc_id", "size", "source_size", "target", "taken"]
    clean = lambda v: None if v is None or v != v or str(v) == "<NA>" else round(float(v), 6)
    want = sorted((tuple(clean(v) for v in r) for r in con.execute(mixture.MIX_SQL).df()[names].itertuples(index=False)), key=str)
    got = sorted((tuple(clean(r[n]) for n in names) for r in mixture.mix(docs).collect()), key=str)
    assert got == want
    return got


def rows(spark, data):
    return spark.createDataFrame([(i, t, s, 0) for i, t, s in data], "doc_id bigint, text string, source string, size int")


def test_mix_equals_the_check_sql(spark):
    data = [(i, "w " * (1 + i * 37 % 50), "abcdefg"[i % 7 if i % 3 else 0]) for i in range(400)]
    got = check(spark, rows(spark, data))
    assert sum(g[4] for g in got) <= 1.5 * sum(g[1] for g in got)
    assert all(g[4] in (0, g[1], 2 * g[1]) for g in got)


def test_odd_rows(spark):
    data = [(1, None, "a"), (2, "", None), (3, "x y", None), (None, "x y z", "b"), (None, "x y z", "b"), (4, "q", "b"), (4, "q", "b"), (5, "x " * 90, "c"), (6, " ", "empty")]
    check(spark, rows(spark, data))
    assert mixture.mix(rows(spark, data).limit(0)).count() == 0
    check(spark, rows(spark, [(1, None, "a"), (2, "", None)]))


def test_targets_share_out_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), ("d", 5), (None, 100)], "source string, source_size bigint")
    got = {r.source: r.target for r in mixture.targets(sizes).collect()}
    assert got["a"] == 20 and got["d"] == 10 and abs(sum(got.values()) - 1.5 * 2115) < 1e-6
    assert all(got[s] <= 2 * n + 1e-9 for s, n in (("a", 10), ("b", 1000), ("c", 1000), ("d", 5), (None, 100)))


def test_cells_and_parts_find_the_same_cut(spark, monkeypatch):
    data = [(i, "w " * (1 + i * 37 % 50), "ab"[i % 2]) for i in range(200)]
    want = check(spark, rows(spark, data))
    monkeypatch.setattr(mixture, "CELLS", 2)
    monkeypatch.setattr(mixture, "FINE", 3)
    assert check(spark, rows(spark, data)) == want

from pyspark.sql import functions as F

from tenderline.operators import aggregates as A, joins as J, reshape as R, shares as W


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_modes_and_argmax_with_ties_and_nulls(frame):
    df = frame("k string, v string, u string, w double", [("a", "y", "1", 1.0), ("a", "x", "2", 1.0), ("a", None, None, 9.0), ("b", None, None, 1.0), ("c", "z", "3", None)])
    assert rows(A.modal_values(df, ["k"], ["v", "u"])) == [("a", "x", "1"), ("c", "z", "3")]
    assert rows(A.top_label(df, ["k"], "v", F.col("w"), "top")) == [("a", "x")]


def test_packed_mode_handles_negative_and_missing(frame):
    df = frame("k int, n int, v int", [(1, 2, 7), (1, 2, -3), (1, 1, 0), (2, 5, None), (3, 1, 2147483647)])
    assert rows(df.groupBy("k").agg(A.modal_int(F.col("n"), F.col("v")).alias("m")).where("k <> 2")) == [(1, -3), (3, 2147483647)]
    assert df.where("k = 2").groupBy("k").agg(A.modal_int(F.col("n"), F.col("v")).alias("m")).first().m is None


def test_first_known_takes_each_column_on_its_own(frame):
    df = frame("k int, at int, a string, b string", [(1, 2, "late", "x"), (1, 1, None, "y"), (1, 3, "later", None)])
    assert rows(A.first_known(df, ["k"], ["a", "b"], "at")) == [(1, "late", "y")]


BANDS = [("p", 0.0, 10.0, "low"), ("p", 10.0, 20.0, "mid"), ("q", 0.0, None, "open")]


def banded(frame, closed, **how):
    facts = frame("id int, p string, v double", [(1, "p", 0.0), (2, "p", 10.0), (3, "p", 9.999), (4, "p", 20.0), (5, "q", 1e9), (6, "r", 1.0), (7, "p", None)])
    bands = frame("p string, lo double, hi double, name string", BANDS)
    return rows(J.range_lookup(facts, bands, ["p"], "v", "lo", "hi", closed, **how).select("id", "name"))


def test_range_lookup_edges(frame):
    assert banded(frame, "right") == [(2, "low"), (3, "low"), (4, "mid"), (5, "open")]
    assert banded(frame, "left") == [(1, "low"), (2, "mid"), (3, "low"), (5, "open")]
    assert banded(frame, "none") == [(3, "low"), (5, "open")]


def test_range_lookup_without_broadcast_is_the_same(frame):
    for closed in ("right", "left", "none"):
        assert banded(frame, closed) == banded(frame, closed, limit=0, salts=5)
    inner, outer = banded(frame, "right"), J.range_lookup
    facts = frame("id int, p string, v double", [(1, "p", -5.0), (2, "p", 5.0)])
    bands = frame("p string, lo double, hi double, name string", BANDS)
    for limit in (0, J.BROADCAST_LIMIT):
        left = outer(facts, bands, ["p"], "v", "lo", "hi", how="left", limit=limit).select("id", "name")
        assert sorted(left.collect(), key=lambda r: r.id) == [(1, None), (2, "low")]
    assert inner


def test_first_break_at_or_above_else_the_last(frame):
    breaks = frame("kind string, break double, inc double", [("r", 0.1, 1.0), ("r", 0.2, 2.0), ("r", 0.3, 3.0)])
    bands = J.breaks_to_bands(breaks, ["kind"], "break")
    facts = frame("id int, v double", [(1, -1.0), (2, 0.1), (3, 0.11), (4, 0.3), (5, 99.0), (6, None)])
    got = J.range_lookup(facts, bands, [], "v", "low", "high", how="left").select("id", "inc")
    assert sorted((r.id, r.inc) for r in got.collect() if r.inc is not None) == [(1, 1.0), (2, 1.0), (3, 2.0), (4, 3.0), (5, 3.0)]


def test_listed_and_not_listed_with_missing_keys(frame):
    df, listed = frame("k string", [("a",), ("b",), (None,)]), frame("k string", [("a",), ("a",)])
    assert [r.k for r in J.only_listed(df, listed, ["k"]).collect()] == ["a"]
    assert {r.k for r in J.except_listed(df, listed, ["k"]).collect()} == {"b", None}


def test_shares_two_ways(frame):
    df = frame("k int, v double", [(1, 1.0), (1, 3.0), (2, 0.0)])
    a = df.withColumn("s", W.share(F.col("v"), "k"))
    b = W.share_of_total_joined(df, ["k"], "v", "s")
    key = lambda r: (r.k, r.v)
    assert sorted(a.collect(), key=key) == sorted(b.collect(), key=key) == [(1, 1.0, 0.25), (1, 3.0, 0.75), (2, 0.0, None)]


def test_contiguous_folds_are_even_and_in_order(spark):
    df = spark.range(100, 117).withColumnRenamed("id", "k")
    got = {r.k: r.fold for r in W.contiguous_folds(df, ["k"]).collect()}
    assert [got[k] for k in range(100, 117)] == [0] * 6 + [1] * 6 + [2] * 5


def test_folds_keep_a_key_together(spark):
    df = spark.range(1000).select(F.concat(F.lit("B"), (F.col("id") % 50).cast("string")).alias("bid_id"))
    assert df.withColumn("f", W.fold_of(F.col("bid_id"))).groupBy("bid_id").agg(F.countDistinct("f").alias("n")).where("n > 1").count() == 0


def test_wide_rows_and_unseen_categories(frame):
    df = frame("bid_id string, product string, x double, c string, r string", [("1", "A", 5.0, "new", "k"), ("1", "B", None, "u", "k"), ("2", "B", 1.0, None, "l")])
    wide = R.wide_by_product(df, ["A", "B"], {"x": None, "c": ["u"]}, {"r": ["k"]})
    assert rows(wide) == [("1", 5.0, 0.0, -1000.0, 1.0, 1.0), ("2", -1000.0, -1000.0, 1.0, 0.0, 0.0)]


def test_stacked_fills_missing_columns(frame):
    got = A.stacked([frame("a int", [(1,)]), frame("b int", [(2,)])])
    assert {tuple(r) for r in got.collect()} == {(1, None), (None, 2)}

"""What the queries on lines shuffle and write."""

import re

import pytest

from testbed import queries as Q
from testbed.tables import Tables

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SMALL)


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_readers_of_lines_share_a_shuffle(t):
    """Volumes (twice), target prices (twice) and surcharges read one shuffle; service groups have their own."""
    text = final_plan(Q.features(t))
    assert len(re.findall(r"Scan parquet .*l_orderkey", text)) == 2
    assert text.count("ReusedExchange") >= 4


def test_places_of_shippers_are_counted_where_the_bid_is(t):
    from tenderline.operators.aggregates import modal_values

    text = modal_values(t.shippers, ["bid_id"], ["region", "district"])._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    assert [k for k in keys if "bid_id" in k] == [k for k in keys if re.fullmatch(r"bid_id#\d+", k)] and sum("bid_id" in k for k in keys) == 1


def test_an_optimum_that_is_read_once_is_not_written(t, monkeypatch):
    def written(df, label):
        raise AssertionError(f"{label} written")

    monkeypatch.setattr(Q, "materialise", written)
    for query in (Q.what_if_sweep, Q.sweep_side_by_side, Q.offered_incentives, Q.target_ranges, Q.surcharge_incentives):
        assert query(t).columns


def test_the_optimum_of_quotes_is_written_narrow(t):
    assert Q.optimal(t).columns == Q.QUOTED


def test_the_sweep_repeats_rows_after_its_sums(t):
    """The long table (a row per step) is neither sorted nor summed over."""
    text = Q.sweep_side_by_side(t)._jdf.queryExecution().executedPlan().toString()
    assert text.index("Generate inline") < min(text.index("Window"), text.index("Sort"), text.index("Exchange"))


def test_the_sweep_sums_the_products_of_a_bid_and_mode(spark):
    from math import exp, log

    from tenderline.plans import post

    rows = [("B1", "1DA", "AIR", 0.3, 0.25, 1.0, 4.0, 900.0, 500.0), ("B1", "2DA", "AIR", 0.9, 0.35, 0.5, 3.0, 400.0, 200.0), ("B1", "GND", "GND", 0.2, None, 1.0, 4.0, 100.0, 50.0)]
    schema = "bid_id string, product string, mode string, optimal_inc double, market_inc double, alpha double, gamma double, list_rev double, marg_cost double"
    known = spark.createDataFrame(rows, schema).selectExpr("*", "0.2D AS price_discipline", "0.4D AS volume_weight")
    long = {(r["product"], r.step): r for r in post.sweep(known).collect()}
    assert len(long) == 3 * 41

    def terms(row, step):
        _, _, _, best, m, alpha, gamma, rev, cost = row
        x = best + step / 100.0
        if m is None or x >= 1.0:
            return None
        pt = 1.0 / (1.0 + exp(-alpha - gamma * log((1.0 - x) / (1.0 - m))))
        profit = (rev * (1.0 - x) - cost) * pt
        return profit - 0.25 * rev * (x - m) ** 2 + 0.4 * (pt * rev - profit), profit

    for (product, step), r in long.items():
        parts = [p for row in rows if row[2] == r["mode"] and (p := terms(row, step))]
        if not parts:
            assert r.objective is None and r.profit is None
            continue
        rev = sum(row[7] for row in rows if row[2] == r["mode"])
        assert abs(r.objective - sum(p[0] for p in parts) / rev) < 1e-9 and abs(r.profit - sum(p[1] for p in parts)) < 1e-9

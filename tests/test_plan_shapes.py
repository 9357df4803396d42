"""What the physical plans must keep to at scale."""

import re

import pytest

from testbed import queries as Q
from testbed.tables import Tables

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def t(spark):
    return Tables(spark, SMALL)


def test_filters_and_columns_reach_the_scan(t):
    from tenderline.sources.readers import projected

    df = projected(t.raw("lineitem").where("l_quantity > 49"), ["l_orderkey", "l_quantity"])
    text = df._jdf.queryExecution().toString()
    assert "GreaterThan(l_quantity,49.0)" in text and "ReadSchema: struct<l_orderkey:bigint,l_quantity:double>" in text


def test_product_summary_scans_lines_once_per_source(t):
    text = plan(Q.products(t))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text and "Python" not in text
    # service groups, target prices (twice: rows and their maximum), volumes, surcharge services
    assert len(re.findall(r"Scan parquet .*l_orderkey", text)) <= 5


def test_bid_features_add_no_exchange_to_products(t):
    products, features = plan(Q.products(t)), plan(Q.features(t))
    headers = plan(Q.headers(t))
    count = lambda s: len(re.findall(r"(?<!Broadcast)Exchange hashpartitioning", s))
    assert count(features) <= count(products) + count(headers) + 1


def test_lines_are_placed_by_bid_once_and_stay_there(spark):
    """Groupings and joins of lines by bid and more shuffle nothing again; as at scale, nothing is broadcast."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        text = plan(Q.products(Tables(spark, SMALL)))
    finally:
        spark.conf.set(key, before)
    placed = re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", text)
    # service groups, surcharge services, target prices twice, volumes and their orders
    assert len(placed) == 6 and all(re.fullmatch(r"bid_id#\d+", keys) for keys in placed)


def test_features_that_nobody_reads_are_not_summed(t):
    text = plan(Q.feature_table(t))
    assert "sum(list_rev" in text and "sum(target_high_rev" not in text and "sum(density_rev" not in text


def test_entry_and_registry_agree(spark):
    import __spark_entry__ as E

    assert set(E.oracle_sql()) <= set(E.queries())
    assert E.entry(spark).count() > 0


def test_a_hot_bid_leaves_few_rows_to_place(spark):
    """A third of the lines in one bid: combined to products x tiers rows, with the plain sums."""
    from pyspark.sql import functions as F

    from tenderline.plans import summary

    n = F.col("id")
    one = F.lit(1.0)
    lines = spark.range(30000).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("B"), (n % 500).cast("string"))).alias("bid_id"),
        F.when(n % 2 == 0, "1DA").otherwise("GND_Com").alias("product"), F.when(n % 5 == 0, "FedEx").otherwise("Other").alias("competitor"),
        (n % 4).cast("int").alias("tier"), (n % 7 + 1).cast("double").alias("volume"), (n % 11).cast("double").alias("list_pp"),
        *[one.alias(c) for c in ("freight_pp", "marg_cost_pp", "prior_volume", "comp_net_pp", "target_high_pp", "target_low_pp", "prior_net_rev", "prior_gross_rev", "comp_keyed_pp", "comp_est_pp", "density")],
    )
    assert summary.line_cells(lines).where("bid_id = 'hot'").count() <= 2 * 4
    got = {(r.bid_id, r["product"]): r.list_rev for r in summary.product_sums(lines).collect()}
    plain = lines.groupBy("bid_id", "product").agg(F.sum(F.col("list_pp") * F.col("volume")).alias("v")).collect()
    want = {(r.bid_id, r["product"]): r.v for r in plain}
    assert got == want

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F, types as T

from tenderline.plans import publish
from tenderline.plans.segments import SegmentTables, score_segments, unsegmented
from tenderline.sources import contracts, readers, sinks, weights


@pytest.fixture
def csv(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_text_csv_keeps_leading_zeros_and_gets_types(spark, csv):
    path = csv("b.csv", "NVP_BID_NR,NVP_BID_CGY_TYP_CD,NVP_BID_STS_CD,BID_STS_EFF_DT,NVP_BID_PRP_DT,NVP_BID_RQT_RSN_CD\n007,2,P,18-Jul-17,12-Dec-99,3\n008,2,P,nonsense,1-Mar-17,x\n")
    rows = readers.read_source(spark, path, "bids", "csv", fillers=("12-Dec-99",)).orderBy("bid_id").collect()
    assert rows[0].bid_id == "007" and str(rows[0].status_date) == "2017-07-18" and rows[0].proposed_date is None and rows[0].reason_code == 3
    assert rows[1].status_date is None and rows[1].reason_code is None and str(rows[1].proposed_date) == "2017-03-01"


def test_carrier_prefix_of_a_column_code_is_free(spark):
    raw = spark.sql("SELECT 'B' AS NVP_BID_NR, '1' AS SVC_GRP_NR, '12.5' AS BID_XYZ_PJT_WVL_QY, ' 3 ' AS XYZ_PRJ_GRS_RPP_A, '15' AS CPE_CRR_NR")
    row = readers.canonical(raw, "service_groups").first()
    assert (row.volume, row.freight_pp, row.competitor_code) == (12.5, 3.0, 15)


def test_null_markers_and_dictionary_types(spark, csv):
    marked = readers.read_marked_csv(spark, csv("m.csv", "a,b\n  x, NA\nNULL,2\n")).collect()
    assert [tuple(r) for r in marked] == [("x", None), (None, "2")]
    dictionary = spark.createDataFrame([("n", "int64"), ("v", "float64"), ("s", "str")], "feature string, type string")
    df = readers.read_by_dictionary(spark, csv("d.csv", "s,n,v,extra\n01,5,1.5,q\n"), dictionary)
    assert [f.dataType for f in df.schema.fields] == [T.StringType(), T.LongType(), T.DoubleType(), T.StringType()]
    assert tuple(df.first()) == ("01", 5, 1.5, "q")
    cast = readers.recast(spark.sql("SELECT 'x' AS n, '2' AS v"), readers.dictionary_types(dictionary)).first()
    assert (cast.n, cast.v) == (None, 2.0)


def test_variable_lists(spark, csv, tmp_path):
    csv("one.csv", "Feature,Type\nx,str\n")
    csv("two.csv", "Feature,Type\ny,float64\n")
    assert [tuple(r) for r in readers.read_variable_lists(spark, str(tmp_path), ["one"]).collect()] == [("one", "x", "str")]


def test_ounces_and_total_rows(frame):
    raw = frame("bid_id string, svc_group int, zone string, unit string, category_weight double, package_volume double",
                [("1", 1, "2", "OZ", 8.0, 1.00000000004), ("1", 1, "ALL", "LB", 5.0, 1.0), ("1", 1, "3", "LB", 5.005, 2.0)])
    assert [tuple(r)[4:] for r in weights.package_weights(raw).collect()] == [(0.5, 1.0), (5.01, 2.0)]


def test_contracts(frame):
    wanted = frame("bid_id string", [("1",), ("2",)])
    sources = {"bids": wanted, "shippers": frame("bid_id string", [("1",)]), "prior_results": frame("bid_id string", [("1",)])}
    assert {tuple(r) for r in contracts.check_sources(sources, wanted).collect()} == {("2", "shippers"), ("2", "prior_results")}
    assert {tuple(r) for r in contracts.check_sources(sources, wanted, testing=True).collect()} == {("2", "shippers")}
    assert [tuple(r) for r in contracts.check_lookup(wanted.where("false"), "w").collect()] == [("w", "*", "empty")]


def test_outputs(spark, frame, tmp_path):
    df = frame("bid_id string, mode string, v double", [("1", "AIR", 1.0), ("2", "GND", 2.0)])
    sinks.write_once(df, str(tmp_path / "once"))
    with pytest.raises(AnalysisException):
        sinks.write_once(df, str(tmp_path / "once"))
    sinks.write_by_mode(df, str(tmp_path / "modes"))
    assert sorted(p.name for p in (tmp_path / "modes").glob("mode=*")) == ["mode=AIR", "mode=GND"]
    sinks.write_results(df, str(tmp_path / "results"))
    assert spark.read.parquet(str(tmp_path / "results")).where("scored_at IS NOT NULL").count() == 2


def test_updates_touch_only_their_key_and_type(frame):
    target = frame("bid_id string, svc_group int, result_type string, recommended double, low double, high double",
                   [("1", 1, "P", 0.1, 0.1, 0.1), ("1", 1, "T", 0.1, 0.1, 0.1), ("1", 2, "P", 0.1, 0.1, 0.1)])
    updates = frame("bid_id string, svc_group int, recommended double, low double, high double", [("1", 1, 0.3, 0.2, 0.4)])
    got = sorted((r.svc_group, r.result_type, r.recommended, r.high) for r in publish.apply_updates(target, updates).collect())
    assert got == [(1, "P", 0.3, 0.4), (1, "T", 0.1, 0.1), (2, "P", 0.1, 0.1)]
    text = publish.update_statements(updates, "t", ("r", "l", "h", "b", "g", "k")).first().statement
    assert text == "UPDATE t SET r = 0.3, l = 0.2, h = 0.4 WHERE b = '1' AND g = '1' AND k = 'P'"


def test_holdout_digit_that_is_unknown_is_on(frame):
    bids = frame("bid_id string", [("x1",), ("x3",), ("x8",), ("xy",)])
    table = frame("digit int, is_on boolean", [(1, True), (3, False)])
    got = {r.bid_id: r.update_on for r in publish.updates_allowed(F.col("bid_id"), table, bids).collect()}
    assert got == {"x1": True, "x3": False, "x8": True, "xy": True}


def test_segments_default_and_round_trip(spark, frame, tmp_path):
    from testbed.tables import Tables

    tables = Tables(spark, "")
    tables.segments.save(str(tmp_path / "seg"))
    loaded = SegmentTables.load(spark, str(tmp_path / "seg"))
    rows = frame("bid_id string, product string, mode string, density double, tier int, bid_list_rev double",
                 [("1", "Air_CWT", "AIR_CWT", None, None, 2000.0), ("2", "GND_CWT", "GND_CWT", 10.0, 0, 1999.99), ("3", "GND_CWT", "GND_CWT", 10.0, 99, 10.0), ("4", "1DA", "AIR", 1.0, 1, 1.0)])
    got = {r.bid_id: r for r in score_segments(rows, loaded).collect()}
    # tier 6 -> T2, density 1 -> D0, size 2000 -> S1: cohort C3; tier 0 -> T0, density 10 -> D1, size -> S0: cohort C1
    assert got["1"].freight_incentive == 0.16 and got["2"].freight_incentive == 0.09
    assert [r.bid_id for r in unsegmented(rows, loaded).collect()] == ["3"]

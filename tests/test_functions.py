import datetime
import math

from pyspark.sql import functions as F

from tenderline import catalog
from tenderline.functions import scalars as S
from tenderline.functions.objective import objective, slope


def one(df):
    return [r[0] for r in df.collect()]


def test_weight_bands_on_every_edge(frame):
    weights = [0.0, 0.01, 0.5, 0.51, 1.0, 2.0, 3.0, 4.0, 5.0, 5.01, 10.0, 15.0, 20.0, 25.0, 30.0, 40.0, 50.0, 75.0, 100.0, 100.01, None]
    df = frame("w double", [(w,) for w in weights])
    got = one(df.select(S.weight_band(F.col("w"))))
    L = catalog.WEIGHT_LABELS
    assert got == [None, L[0], L[0], L[1], L[1], L[2], L[3], L[4], L[5], L[6], L[6], L[7], L[8], L[9], L[10], L[11], L[12], L[13], L[14], L[15], None]
    coded = dict(zip(weights, one(df.select(S.weight_band(F.col("w"), True)))))
    assert coded[5.01] == L[6] and coded[10.0] == L[7] and coded[100.0] == L[15] and coded[100.01] is None


def test_source_dates(frame):
    df = frame("d string", [("12-Dec-99",), ("22-Jun-47",), ("31-JUL-17",), ("garbage",), (None,)])
    assert one(df.select(S.source_date(F.col("d")))) == [datetime.date(1999, 12, 12), datetime.date(2047, 6, 22), datetime.date(2017, 7, 31), None, None]
    assert one(df.select(S.source_date(F.col("d"), fillers=("12-Dec-99",))))[0] is None


def test_ratios_keep_missing_values(frame):
    df = frame("a double, b double", [(1.0, 2.0), (1.0, 0.0), (0.0, 0.0), (None, 1.0), (3.0, 2.0)])
    assert one(df.select(S.one_less_ratio(F.col("a"), F.col("b")))) == [0.5, None, None, None, -0.5]
    assert one(df.select(S.at_least_zero(S.one_less_ratio(F.col("a"), F.col("b"))))) == [0.5, None, None, None, 0.0]
    assert one(df.select(S.flag(F.col("a") > 0.5))) == [1, 1, 0, 0, 1]


def test_first_of_equal_bounds_wins(frame):
    df = frame("a double, b double", [(1.0, 1.0), (0.0, 2.0)])
    top, name = S.largest_named([("a", F.col("a")), ("b", F.col("b"))])
    assert [tuple(r) for r in df.select(top, name).collect()] == [(1.0, "a"), (2.0, "b")]


def test_unlisted_keeps_null_and_labels_have_defaults(frame):
    df = frame("p string", [("Unknown",), (None,), ("1DA",)])
    assert one(df.where(S.not_listed(F.col("p"), catalog.UNRELIABLE_PRODUCTS))) == [None, "1DA"]
    assert one(df.select(S.code_label(F.col("p"), {"1DA": "x"}, "other"))) == ["other", "other", "x"]
    assert one(df.select(catalog.product_mode(F.col("p")))) == ["Unknown", "Unknown", "AIR"]


def test_logit_clip_and_step_label(frame):
    df = frame("p double, k int", [(0.0, -20), (1.0, 0), (0.5, 7), (None, 20)])
    got = one(df.select(S.logit(F.col("p"))))
    assert math.isclose(got[0], math.log(0.0001 / 0.9999)) and math.isclose(got[1], math.log(0.9999 / (1 - 0.9999))) and got[2] == 0 and got[3] is None
    assert one(df.select(S.step_label(F.col("k")))) == ["-0.20", "0", "0.07", "0.20"]
    assert one(df.select(S.clip(F.col("p"), F.lit(0.2), F.lit(0.7)))) == [0.2, 0.7, 0.5, None]


def test_objective_and_slope_against_python(frame):
    row = dict(x=0.3, market_inc=0.25, alpha=0.4, gamma=-5.0, list_rev=1000.0, marg_cost=450.0, price_discipline=0.3, volume_weight=0.4)

    def value(x):
        pt = 1 / (1 + math.exp(-row["alpha"] - row["gamma"] * math.log((1 - x) / (1 - row["market_inc"]))))
        profit = (row["list_rev"] * (1 - x) - row["marg_cost"]) * pt
        return profit - 0.3 / 0.7 * row["list_rev"] * (x - row["market_inc"]) ** 2 + 0.4 * (pt * row["list_rev"] - profit)

    df = frame(", ".join(f"{k} double" for k in row), [tuple(row.values())])
    total, d = df.select(objective("x").total, slope("x")).first()
    assert math.isclose(total, value(0.3), rel_tol=1e-12)
    assert math.isclose(d, (value(0.3 + 1e-6) - value(0.3 - 1e-6)) / 2e-6, rel_tol=1e-5)


def test_price_of_zero_or_less_has_no_response(frame):
    df = frame("x double, market_inc double, alpha double, gamma double, list_rev double, marg_cost double, price_discipline double, volume_weight double",
               [(1.0, 0.2, 0.0, -1.0, 1.0, 1.0, 0.3, 0.4), (1.1, 0.2, 0.0, -1.0, 1.0, 1.0, 0.3, 0.4), (0.5, None, 0.0, -1.0, 1.0, 1.0, 0.3, 0.4)])
    assert one(df.select(objective("x").total)) == [None, None, None]

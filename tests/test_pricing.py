"""Bounds, ladder search, scenarios and what follows the search."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from tenderline import catalog
from tenderline.plans import bounds, optimise, post, score

SCHEMA = (
    "bid_id string, product string, mode string, market_inc double, alpha double, gamma double, list_rev double, marg_cost double, "
    "prior_incentive double, bid_reason string, bid_trade_centric int, new_volume_share double, ceiling double, bid_list_rev double"
)


def row(bid, product, market=0.3, alpha=0.0, gamma=-6.0, rev=1000.0, cost=400.0, prior=None, reason="RETENTION", centric=0, new=0.0, ceiling=0.6):
    return (bid, product, catalog.PRODUCT_MODES[product], market, alpha, gamma, rev, cost, prior, reason, centric, new, ceiling, rev)


def bounded(frame, rows):
    return optimise.add_weights(bounds.add_bounds(frame(SCHEMA, rows)))


def test_bounds_by_hand(frame):
    got = {r.bid_id: r for r in bounded(frame, [
        row("plain", "GND_Com"), row("nomarket", "GND_Com", market=None), row("prior", "GND_Com", prior=0.4),
        row("pushed", "GND_Com", prior=0.4, reason="PENETRATION"), row("clash", "GND_Com", prior=0.9), row("open", "GND_Com", market=0.99, ceiling=1.0),
        row("small", "Import", prior=0.5, rev=20.0), row("centric", "Import", prior=0.5, rev=20.0, centric=1),
    ]).collect()}
    # market 0.3: upper min(1-0.7*0.7, 0.45, 0.6) = 0.45; lower max(1-1.3*0.7, 0, 0.09, 0.1) = 0.1
    assert (round(got["plain"].lower, 9), round(got["plain"].upper, 9)) == (0.1, 0.45)
    assert (got["plain"].lower_name, got["plain"].upper_name) == ("l_Floor", "u_MktInc")
    assert not got["nomarket"].feasible and (got["nomarket"].lower, got["nomarket"].upper) == (0.101, 0.999)
    assert got["prior"].lower_name == "l_Prior" and math.isclose(got["prior"].lower, 0.38)
    assert math.isclose(got["pushed"].lower, 0.4)
    assert got["clash"].upper_name == got["clash"].lower_name == "Resetinfeasible" and not got["clash"].feasible
    assert got["open"].upper == pytest.approx(1 - 0.7 * 0.01)
    assert got["small"].lower_name != "l_Prior" and got["centric"].lower_name == "l_Prior"


def value(r, x):
    pt = 1 / (1 + math.exp(-r.alpha - r.gamma * math.log((1 - x) / (1 - r.market_inc))))
    profit = (r.list_rev * (1 - x) - r.marg_cost) * pt
    w = r.price_discipline
    return profit - w / (1 - w) * r.list_rev * (x - r.market_inc) ** 2 + r.volume_weight * (pt * r.list_rev - profit)


def brute(group, n, ratios):
    """Best total over all combinations that keep the ladder."""
    order = sorted(group, key=lambda r: r["product"])
    names = [r["product"] for r in order]
    grids = [[r.lower + (r.cap - r.lower) * k / n for k in range(n + 1)] for r in order]
    values = [[value(r, x) for x in grid] for r, grid in zip(order, grids)]
    best = -math.inf
    for ks in itertools.product(range(n + 1), repeat=len(order)):
        xs = [g[k] for g, k in zip(grids, ks)]
        ok = all(
            xs[i] <= ratios[names[i], names[i + 1]] * xs[i + 1] + 1 - ratios[names[i], names[i + 1]] + 1e-9 for i in range(len(order) - 1)
        )
        if ok:
            best = max(best, sum(v[k] for v, k in zip(values, ks)))
    return best


def test_ladder_search_equals_brute_force_for_every_subset(frame):
    random.seed(3)
    rows = []
    subsets = [s for n in (1, 2, 3) for s in itertools.combinations(catalog.AIR_FAMILY, n)]
    for i, subset in enumerate(subsets * 4):
        for p in subset:
            rows.append(row(f"B{i}", p, market=random.uniform(0.2, 0.5), alpha=random.uniform(-1, 1), gamma=random.uniform(-12, -2), rev=random.uniform(100, 3000), cost=random.uniform(20, 900), ceiling=random.uniform(0.45, 0.7)))
    n = 20
    best = optimise.optimise(bounded(frame, rows), n).collect()
    groups = {}
    for r in best:
        groups.setdefault(r.bid_id, []).append(r)
    checked = 0
    for group in groups.values():
        if all(r.valid for r in group) and all(r.feasible for r in group):
            got = sum(value(r, r.optimal_inc) for r in group)
            want = brute(group, n, catalog.LADDER_STRICT)
            assert math.isclose(got, want, rel_tol=1e-9), (group, got, want)
            checked += 1
    assert checked >= 20
    assert any(r.ladder_binds for r in best)


def test_free_optimum_is_where_the_slope_changes_sign(frame):
    best = optimise.optimise(bounded(frame, [row("a", "GND_Com", gamma=-9.0), row("b", "Export", gamma=-7.0)]), 400).collect()
    for r in best:
        assert r.flag == 0
        if not (r.upper_binds or r.lower_binds):
            assert abs(r.optimal_slope) < 0.02 * r.list_rev


def test_fallbacks(frame):
    rows = bounded(frame, [row("clash", "GND_Com", prior=0.9), row("clash", "GND_Resi"), row("none", "GND_Com", market=None)])
    got = {(r.bid_id, r["product"]): r for r in optimise.optimise(rows, 50).collect()}
    assert got["clash", "GND_Com"].optimal_inc == pytest.approx(0.3)  # the market incentive, inside floor and ceiling
    assert got["clash", "GND_Resi"].feasible and got["clash", "GND_Resi"].optimal_inc != pytest.approx(0.3)
    assert got["none", "GND_Com"].optimal_inc is None
    full = optimise.optimise(rows.withColumn("price_discipline", F.lit(1.0)), 50).collect()
    assert {r.optimal_inc for r in full} == {0.3, None}


def test_ladder_as_coded(frame):
    rows = bounded(frame, [row("x", "1DA"), row("x", "3DA"), row("y", "1DA"), row("y", "2DA")])
    sound = {(r.bid_id, r["product"]): r for r in optimise.add_ladder(rows).collect()}
    coded = {(r.bid_id, r["product"]): r for r in optimise.add_ladder(rows, as_coded=True).collect()}
    assert sound["x", "3DA"].ratio == 0.51308 and sound["y", "2DA"].ratio == 0.78928
    assert not coded["x", "3DA"].laddered and coded["y", "2DA"].ratio == 0.51308


def test_scenarios(frame, spark):
    table = optimise.weight_scenarios(spark, 0.0, 1.0, 0.5, 0.0, 1.0, 0.5)
    assert [tuple(r)[1:] for r in table.orderBy("scenario").collect()] == [(0.0, 0.0), (0.0, 0.5), (0.0, 1.0), (0.5, 0.0), (0.5, 0.5), (0.5, 1.0), (1.0, 0.0)]
    assert optimise.with_scenarios(bounded(frame, [row("a", "Import")]), table).count() == 7


def test_target_range_with_missing_prior(frame):
    df = frame("freight_incentive double, marg_cost double, list_rev double, prior_incentive double, ceiling double",
               [(0.30, 500.0, 1000.0, None, 0.6), (0.04, 500.0, 1000.0, 0.2, 0.6), (0.30, 100.0, 1000.0, 0.55, 0.5), (0.3, 1.0, 0.0, None, 0.6)])
    got = [tuple(round(v, 6) for v in (r.target_high, r.target_low, r.shown_high)) for r in post.target_range(df).collect()]
    assert got == [(0.31, 0.25, round(1 - 500 / 950, 6)), (0.05, 0.0, 0.2), (0.31, 0.25, 0.5), (0.31, 0.25, 0.31)]


def test_gap_caps(frame):
    df = frame("overall_incentive double, gap double", [(0.3, 0.1), (0.3, -0.5), (0.69, -0.1), (0.01, 0.0)])
    assert [round(r.freight_incentive, 6) for r in post.offered(df).collect()] == [0.3, 0.5, 0.7, 0.05]


def test_calibration_needs_priced_rows(frame):
    with pytest.raises(ValueError):
        score.calibrate(frame("mode string", [("AIR_CWT",)]), lambda d: d, None)


def test_rows_without_an_objective_get_the_clamped_market(frame):
    rows = bounded(frame, [row("a", "GND_Com"), row("b", "GND_Com", gamma=None), row("c", "1DA"), row("c", "2DA", alpha=None), row("c", "3DA"), row("d", "Import", market=None)])
    got = {(r.bid_id, r["product"]): r for r in optimise.optimise(rows, 50).collect()}
    assert got["a", "GND_Com"].flag == 0
    for key in (("b", "GND_Com"), ("c", "1DA"), ("c", "2DA"), ("c", "3DA"), ("d", "Import")):
        r = got[key]
        want = None if r.market_inc is None else min(max(r.market_inc, r.l_floor), r.ceiling)
        assert r.flag == -1 and r.optimal_inc == want, key


def test_search_makes_no_rows_of_grid_points_and_places_rows_once(frame):
    rows = bounded(frame, [row("a", "1DA"), row("a", "2DA"), row("a", "GND_Com")])
    text = optimise.optimise(rows)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in text and "Join" not in text and text.count("Exchange") == 1


def test_ties_on_the_grid_go_to_the_last_points(frame):
    # no revenue and no cost: every point is worth 0
    rows = bounded(frame, [row("a", p, rev=0.0, cost=0.0) for p in catalog.AIR_FAMILY] + [row("b", "GND_Com", rev=0.0, cost=0.0)])
    got = {(r.bid_id, r["product"]): r for r in optimise.optimise(rows, 50).collect()}
    assert got["b", "GND_Com"].best_k == got["a", "3DA"].best_k == 50
    for low, high in (("1DA", "2DA"), ("2DA", "3DA")):
        a, b = got["a", low], got["a", high]
        limit = b.ratio * b.optimal_inc + 1 - b.ratio + 1e-9
        x = [a.lower + (a.cap - a.lower) * k / 50 for k in range(51)]
        assert a.best_k == max(k for k in range(51) if x[k] <= limit)


def test_rows_without_a_key_have_no_result(frame):
    rows = bounded(frame, [row("a", "GND_Com"), row(None, "GND_Com")])
    assert [r.bid_id for r in optimise.optimise(rows, 20).collect()] == ["a"]


def test_objective_on_arrays_is_the_column_objective(frame):
    import numpy as np

    from tenderline.functions.objective import NUMBERS, objective, objective_at

    random.seed(5)
    rows = bounded(frame, [row(f"B{i}", "GND_Com", random.uniform(0.1, 0.9), random.uniform(-3, 3), random.uniform(-12, 2), random.uniform(1, 1e5), random.uniform(0, 9e4)) for i in range(50)])
    for r in rows.withColumn("x", F.lit(0.37)).withColumn("v", objective("x").total).withColumn("out", objective(F.lit(1.5)).total).collect():
        numbers = [np.array([[r[name]]]) for name in NUMBERS]
        assert objective_at(np.array([[0.37]]), *numbers)[0, 0] == pytest.approx(r.v, rel=1e-12)
        assert r.out is None and np.isnan(objective_at(np.array([[1.5]]), *numbers)[0, 0])

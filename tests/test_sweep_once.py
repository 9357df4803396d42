"""The sweep finds the response of a step once."""

import math

from tenderline.plans import post

SCHEMA = "bid_id string, product string, mode string, optimal_inc double, market_inc double, alpha double, gamma double, list_rev double, marg_cost double, price_discipline double, volume_weight double"


def test_nothing_is_computed_per_step_after_the_sums(spark):
    rows = spark.createDataFrame([("B1", "1DA", "AIR", *[0.4] * 8)], SCHEMA)
    plan = post.sweep(rows)._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate inline", 1)
    assert "EXP(" not in above and "EXP(" in below


def test_response_and_net_revenue_of_odd_rows(spark):
    rows = spark.createDataFrame(
        [
            ("B1", "1DA", "AIR", 0.3, 0.4, 0.2, -3.0, 100.0, 40.0, 0.5, 0.4),
            ("B1", "2DA", "AIR", 0.9, 0.4, 0.2, -3.0, 200.0, 40.0, 0.5, 0.4),
            ("B1", "2DA", "AIR", 0.9, 0.4, 0.2, -3.0, 200.0, 40.0, 0.5, 0.4),  # a row that comes twice
            ("B2", "GND_Com", "GND", None, 0.4, None, -3.0, 100.0, None, 0.5, 0.4),
            (None, "GND_Com", "GND", 0.1, None, 0.1, -3.0, 0.0, 10.0, 0.5, 0.4),
        ],
        SCHEMA,
    )
    for as_coded in (False, True):
        got = post.sweep(rows, as_coded=as_coded).collect()
        assert len(got) == 5 * 41 and post.sweep(rows).columns == ["bid_id", "product", "mode", "step", "swept_inc", "objective", "pull_through", "profit", "net_rev"]
        for r in got:
            best, rev = {"1DA": (0.3, 100.0), "2DA": (0.9, 200.0)}.get(r["product"], (None, None))
            x = None if best is None else best + r.step / 100.0
            if x is None or x >= 1.0:
                assert r.pull_through is None and r.net_rev is None
                continue
            pt = 1.0 / (1.0 + math.exp(-0.2 + 3.0 * math.log((1.0 - x) / (1.0 - 0.4))))
            priced = 1.0 - best + r.step / 100.0 if as_coded else 1.0 - x
            assert abs(r.swept_inc - x) < 1e-12 and abs(r.pull_through - pt) < 1e-12 and abs(r.net_rev - pt * rev * priced) < 1e-9

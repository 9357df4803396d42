"""What the registered queries hand to the library."""

import inspect

import pytest

from tenderline import catalog
from tenderline.models import pricing
from testbed import queries as Q


class Called(Exception):
    pass


def called_with(monkeypatch, name, run):
    signature = inspect.signature(getattr(pricing, name))

    def stop(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        raise Called(bound.arguments)

    monkeypatch.setattr(pricing, name, stop)
    with pytest.raises(Called) as found:
        run()
    return found.value.args[0]


@pytest.mark.parametrize("name, query, sizes", [
    ("fit_market", "market_incentives", {"trees": 500, "depth": 30}),
    ("fit_market", "variable_importance", {"trees": 500, "depth": 30}),
    ("fit_gap", "effective_to_offered_gap", {"rounds": 500, "depth": 5}),
    ("fit_base", "base_pull_through", {"trees": 500, "depth": 30}),
    ("fit_win", "win_probabilities", {"trees": 500, "depth": 30}),
])
def test_model_queries_fit_whole_models(monkeypatch, name, query, sizes):
    monkeypatch.setattr(Q, "calibration", lambda t: None)
    monkeypatch.setattr(Q, "bid_matrix", lambda rows: None)
    monkeypatch.setattr(catalog, "values_frame", lambda *a: None)

    class T:
        spark = None

    given = called_with(monkeypatch, name, lambda: getattr(Q, query)(T()))
    assert {k: given[k] for k in sizes} == sizes


def test_bid_matrix_has_all_products(monkeypatch):
    given = called_with(monkeypatch, "learn_layout", lambda: Q.bid_matrix(None))
    assert given["products"] == list(catalog.PRODUCT_MODES)


def test_calibration_rows_are_made_once(spark, monkeypatch):
    from tenderline.models import preprocess
    from testbed.tables import Tables

    given, fit = [], preprocess.fit_imputer
    monkeypatch.setattr(preprocess, "fit_imputer", lambda rows, numeric: given.append(rows) or fit(rows, numeric))
    rows = Q.calibration(Tables(spark, "/root/testdata/sf0.001"))
    for df in (given[0], rows):
        assert df.inputFiles() and all("/calibration-" in f for f in df.inputFiles())

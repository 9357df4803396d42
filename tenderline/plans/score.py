"""Production and calibration scoring over all bids at once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tenderline import catalog
from tenderline.operators.aggregates import stacked
from tenderline.operators.ladder import GRID
from tenderline.plans.bounds import add_bounds, add_ceiling
from tenderline.plans.optimise import SCENARIO, add_weights, optimise, with_scenarios
from tenderline.plans.post import bid_incentive, offered, per_service, quotes
from tenderline.plans.segments import SegmentTables, score_segments

Step = Callable[[DataFrame], DataFrame]


def priced_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("mode").isin(catalog.PRICED_MODES))


def heavy_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("mode").isin(catalog.HEAVY_MODES))


def bounded_rows(features: DataFrame, respond: Step, bands: DataFrame, overlay: DataFrame | None = None, omit_ceiling: bool = False, as_coded: bool = False) -> DataFrame:
    """Priced rows with market incentive and response (from ``respond``), ceiling, bounds, weights."""
    scored = respond(priced_rows(features))
    return add_weights(add_bounds(add_ceiling(scored, bands, omit_ceiling, as_coded)), overlay)


def score_bids(
    features: DataFrame,
    respond: Step,
    gap: Step,
    bands: DataFrame,
    service_products: DataFrame,
    breaks: DataFrame,
    surcharge_map: DataFrame,
    industry: DataFrame | None = None,
    overlay: DataFrame | None = None,
    segments: SegmentTables | None = None,
    points: int = GRID,
    as_coded: bool = False,
    wide_sweep: bool = False,
) -> DataFrame:
    """Quotes for all bids: priced modes through the optimiser, heavy modes through segments.

    Without ``industry`` the industry step is skipped. If no row is in a priced mode the priced
    part is empty with its full schema.
    """
    rows = features if industry is None else features.join(industry, "bid_id")
    bounded = bounded_rows(rows, respond, bands, overlay, as_coded=as_coded)
    best = optimise(bounded, points, as_coded=as_coded)
    priced = quotes(offered(gap(bid_incentive(best))), service_products, breaks, surcharge_map, wide_sweep)
    if segments is None:
        return priced
    return stacked([priced, per_service(score_segments(heavy_rows(features), segments), service_products)])


def calibrate(features: DataFrame, respond: Step, bands: DataFrame, gap: Step | None = None, points: int = GRID) -> DataFrame:
    """Optimum against the incentive in force; with ``gap`` also the offered incentive.

    Raises if there is nothing to calibrate on.
    """
    if priced_rows(features).isEmpty():
        raise ValueError("no row in a priced mode to calibrate on")
    best = optimise(bounded_rows(features, respond, bands), points, current="overall_incentive")
    return best if gap is None else offered(gap(best))


def scan_scenarios(features: DataFrame, respond: Step, bands: DataFrame, scenarios: DataFrame, mode: str, points: int = GRID) -> DataFrame:
    """Optimum of one mode under every weight scenario."""
    only = features.where(F.col("mode") == mode)
    if only.isEmpty():
        raise ValueError(f"no row in mode {mode} to calibrate on")
    bounded = with_scenarios(bounded_rows(only, respond, bands), scenarios)
    return optimise(bounded, points, group=("bid_id", SCENARIO), current="overall_incentive")

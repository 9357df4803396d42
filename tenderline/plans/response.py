"""Intercept and slope of the response curve from fitted coefficients."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# (mode, term, category, value); term 'intercept', 'base' or 'price', or a feature that
# interacts with the price ratio; category is None for a numeric feature
Coefficient = tuple[str, str, str | None, float]


def _sum(parts: list[Column]) -> Column:
    total = F.lit(0.0)
    for part in parts:
        total = total + part
    return total


def add_response(rows: DataFrame, coefficients: Iterable[Coefficient], base: str = "base_logit") -> DataFrame:
    """alpha = intercept + b*base; gamma = the rest of the linear part per unit of ln(price ratio).

    The coefficients are a few literals per mode, so they become column arithmetic in place of
    a join. A category that was not in the fit contributes nothing.
    """
    by_mode: dict[str, list[Coefficient]] = {}
    for coefficient in coefficients:
        by_mode.setdefault(coefficient[0], []).append(coefficient)
    alpha = gamma = None
    for mode, terms in by_mode.items():
        level = [F.lit(v) for _, term, _, v in terms if term == "intercept"]
        level += [F.lit(v) * F.col(base) for _, term, _, v in terms if term == "base"]
        slope = [F.lit(v) for _, term, _, v in terms if term == "price"]
        for _, term, category, value in terms:
            if term in ("intercept", "base", "price"):
                continue
            if category is None:
                slope.append(F.lit(value) * F.col(term))
            else:
                slope.append(F.when(F.col(term) == category, value).otherwise(0.0))
        here = F.col("mode") == mode
        alpha = (F if alpha is None else alpha).when(here, _sum(level))
        gamma = (F if gamma is None else gamma).when(here, _sum(slope))
    return rows.withColumn("alpha", alpha).withColumn("gamma", gamma)

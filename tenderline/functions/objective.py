"""Response curve and pricing objective as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, functions as F


def _c(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


@dataclass(frozen=True)
class Terms:
    """Columns of the objective at one incentive."""

    pull_through: Column
    profit: Column
    discipline: Column
    volume: Column

    @property
    def total(self) -> Column:
        return self.profit - self.discipline + self.volume


def price_ratio(incentive: Column, market: Column) -> Column:
    """(1 - x)/(1 - m): net price relative to the market's."""
    return F.try_divide(F.lit(1.0) - incentive, F.lit(1.0) - market)


def pull_through(incentive, market="market_inc", alpha="alpha", gamma="gamma") -> Column:
    """Logistic response 1/(1 + exp(-alpha - gamma*ln r)); NULL where r is not positive."""
    r = price_ratio(_c(incentive), _c(market))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-_c(alpha) - _c(gamma) * F.ln(r)))


def discipline_factor(weight="price_discipline") -> Column:
    """w/(1 - w); NULL at w = 1, where the objective is not used."""
    w = _c(weight)
    return F.try_divide(w, F.lit(1.0) - w)


#: The numbers of a row that its objective is made of, in the order of ``objective_at``.
NUMBERS = ["market_inc", "alpha", "gamma", "list_rev", "marg_cost", "price_discipline", "volume_weight"]


def objective_at(x: np.ndarray, market, alpha, gamma, rev, cost, weight, volume_weight) -> np.ndarray:
    """The total of ``objective`` by the same operations on arrays; NaN where it is NULL.

    The numbers must be known, with a market incentive and a price discipline other than 1.
    """
    with np.errstate(divide="ignore", invalid="ignore", over="ignore", under="ignore"):
        r = (1.0 - x) / (1.0 - market)
        pt = 1.0 / (1.0 + np.exp(-alpha - gamma * np.log(np.where(r > 0.0, r, np.nan))))
        profit = (rev * (1.0 - x) - cost) * pt
        gap = x - market
        discipline = weight / (1.0 - weight) * rev * gap * gap
        return profit - discipline + volume_weight * (pt * rev - profit)


def objective(
    incentive,
    market="market_inc",
    alpha="alpha",
    gamma="gamma",
    revenue="list_rev",
    cost="marg_cost",
    price_discipline="price_discipline",
    volume_weight="volume_weight",
) -> Terms:
    """Expected profit, price-discipline penalty and volume reward of one row."""
    x, m, rev = _c(incentive), _c(market), _c(revenue)
    pt = pull_through(x, m, alpha, gamma)
    profit = (rev * (F.lit(1.0) - x) - _c(cost)) * pt
    gap = x - m
    discipline = discipline_factor(price_discipline) * rev * gap * gap
    volume = _c(volume_weight) * (pt * rev - profit)
    return Terms(pt, profit, discipline, volume)


def slope(
    incentive,
    market="market_inc",
    alpha="alpha",
    gamma="gamma",
    revenue="list_rev",
    cost="marg_cost",
    price_discipline="price_discipline",
    volume_weight="volume_weight",
) -> Column:
    """Analytic derivative of the row's objective by the incentive, as a check column."""
    x, m, rev, g, w = _c(incentive), _c(market), _c(revenue), _c(gamma), _c(volume_weight)
    pt = pull_through(x, m, alpha, gamma)
    dpt = -g / (F.lit(1.0) - x) * pt * (F.lit(1.0) - pt)
    dprofit = -rev * pt + (rev * (F.lit(1.0) - x) - _c(cost)) * dpt
    ddiscipline = F.lit(2.0) * discipline_factor(price_discipline) * rev * (x - m)
    return dprofit - ddiscipline + w * (rev * dpt - dprofit)

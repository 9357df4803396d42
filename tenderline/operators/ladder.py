"""Bounded maximisation on a grid, with and without price ladders between products.

The objective is a sum over products and only neighbouring products constrain each other, so
the best combination is found by a running maximum along the ladder instead of by trying
combinations: cost is products x grid points per group, never their power.

The points of a row are made, valued and compared as one array inside a batch of rows (a numpy
column function); they are never rows of a table, so nothing is sorted, shuffled or spilled for
them. Every row brings the numbers of its whole ladder, three members at most.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, functions as F

GRID = 200
SLACK = 1e-9
#: Members of the longest ladder, and rows whose points are held at a time.
MEMBERS = 3
CHUNK = 1024

#: Values of points x (rows x points) from the numbers of each row (rows x 1); NaN: no value.
Value = Callable[..., np.ndarray]


def grid_of(low: np.ndarray, high: np.ndarray, points: int) -> np.ndarray:
    """Rows of the grid points 0..points between two columns of bounds."""
    return low + (high - low) * np.arange(points + 1, dtype=np.float64) / float(points)


def last_best(value: np.ndarray) -> np.ndarray:
    """Index of each row's largest value, the last one on ties; -1 where no point has a value."""
    at = value.shape[1] - 1 - np.argmax(value[:, ::-1], axis=1)
    return np.where(np.take_along_axis(value, at[:, None], axis=1)[:, 0] > -np.inf, at, -1)


def points_below(x: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Per limit, the last index of the row's ascending points x that is not above it; -1 if none."""
    last = x.shape[1] - 1
    span = x[:, -1:] - x[:, :1]
    guess = np.where(span > 0.0, (limit - x[:, :1]) / np.where(span > 0.0, span, 1.0) * last, 0.0)
    at = np.clip(np.floor(guess), -1, last).astype(np.int64)
    while True:  # rounding leaves the guess a point off at most; equal points are walked over
        above = (at >= 0) & (np.take_along_axis(x, np.maximum(at, 0), axis=1) > limit)
        room = (at < last) & (np.take_along_axis(x, np.minimum(at + 1, last), axis=1) <= limit)
        if not (above.any() or room.any()):
            return at
        at = at - above + room


def best_path(x: list[np.ndarray], value: list[np.ndarray], ratio: list[np.ndarray]) -> np.ndarray:
    """Best grid index of every member (rows x members) of ladders of one length; -1 if there is none.

    A member's point may be used with any point of the member below that is at most
    ratio*x + (1-ratio): the best of those is a running maximum. On ties the last points win.
    """
    total, partner = value[0], []
    for r in range(1, len(x)):
        top = np.maximum.accumulate(total, axis=1)
        where = np.maximum.accumulate(np.where(total == top, np.arange(total.shape[1]), 0), axis=1)
        below = points_below(x[r - 1], ratio[r] * x[r] + (1.0 - ratio[r]) + SLACK)
        held = np.maximum(below, 0)
        partner.append(np.take_along_axis(where, held, axis=1))
        total = np.where(below >= 0, value[r] + np.take_along_axis(top, held, axis=1), -np.inf)
    path = [last_best(total)]
    for step in reversed(partner):
        path.insert(0, np.where(path[0] >= 0, np.take_along_axis(step, np.maximum(path[0], 0)[:, None], axis=1)[:, 0], -1))
    return np.stack(path, axis=1)


def best_on_ladder(members: list[dict[str, Column]], names: list[str], value: Value, points: int = GRID) -> Column:
    """Column of structs (k1, k2, k3): best grid index of each member of the row's ladder.

    ``members`` holds the columns lower, cap, ratio and ``names`` (the numbers that ``value``
    takes) of the members 1, 2, 3 of the row's ladder. A row whose first ``lower`` is NULL is not
    searched; a member whose ``lower`` is NULL is not there. A row on its own is a ladder of one.
    """
    fields = ["lower", "cap", "ratio", *names]

    def search(rows):
        import pandas as pd

        columns = {name: rows[name].to_numpy(dtype=np.float64) for name in rows.columns}
        length = np.zeros(len(rows), dtype=np.int64)
        for r in range(1, MEMBERS + 1):
            length += (length == r - 1) & ~np.isnan(columns[f"lower_{r}"])
        found = np.full((len(rows), MEMBERS), -1, dtype=np.int64)
        for n in range(1, MEMBERS + 1):
            chosen = np.flatnonzero(length == n)
            for at in (chosen[i : i + CHUNK] for i in range(0, len(chosen), CHUNK)):
                own = [{f: columns[f"{f}_{r}"][at][:, None] for f in fields} for r in range(1, n + 1)]
                x = [grid_of(m["lower"], m["cap"], points) for m in own]
                values = [value(p, *[m[f] for f in names]) for p, m in zip(x, own)]
                values = [np.where(np.isnan(v), -np.inf, v) for v in values]
                found[at, :n] = best_path(x, values, [m["ratio"] for m in own])
        best = pd.DataFrame(found, columns=[f"k{r}" for r in range(1, MEMBERS + 1)])
        return best.astype("Int32").where(best >= 0)

    schema = ", ".join(f"k{r} int" for r in range(1, MEMBERS + 1))
    given = [m[f].cast("double").alias(f"{f}_{r}") for r, m in enumerate(members, 1) for f in fields]
    return F.pandas_udf(search, schema)(F.struct(*given))

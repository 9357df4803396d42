"""Column expressions. NULL is the only missing value; a division by zero gives NULL."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tenderline import catalog


def ratio(num: Column, den: Column) -> Column:
    return F.try_divide(num, den)


def one_less_ratio(num: Column, den: Column) -> Column:
    """1 - num/den."""
    return F.lit(1.0) - F.try_divide(num, den)


def at_least_zero(value: Column) -> Column:
    """max(value, 0) that keeps NULL (``greatest`` alone would turn NULL into 0)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(0.0)))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def code_label(code: Column, labels: dict, default: str) -> Column:
    """Label of a code, the default for unknown and missing codes."""
    chosen = None
    for key, label in labels.items():
        chosen = (F if chosen is None else chosen).when(code == key, F.lit(label))
    return chosen.otherwise(F.lit(default))


def not_listed(value: Column, listed: list) -> Column:
    """True unless the value is listed; NULL counts as not listed."""
    return ~F.coalesce(value.isin(listed), F.lit(False))


def if_zero(value: Column, alternative: Column) -> Column:
    """The value, or the alternative where it is exactly 0."""
    return F.when(value == 0, alternative).otherwise(value)


def clip(value: Column, low: Column, high: Column) -> Column:
    """min(max(value, low), high), NULL if the value is NULL."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, low), high))


def logit(p: Column) -> Column:
    """ln(p / (1 - p)) with 0 and 1 moved just inside the open interval."""
    inside = F.when(p == 0, F.lit(0.0001)).when(p == 1, F.lit(0.9999)).otherwise(p)
    return F.ln(inside / (F.lit(1.0) - inside))


def largest_named(candidates: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """Largest value and the name of the first candidate that reaches it."""
    top = F.greatest(*[c for _, c in candidates]) if len(candidates) > 1 else candidates[0][1]
    name = None
    for label, value in candidates:
        name = (F if name is None else name).when(value == top, F.lit(label))
    return top, name


def weight_band(weight: Column, as_coded: bool = False) -> Column:
    """Label of the right-closed weight band; NULL outside all bands."""
    edges = catalog.WEIGHT_EDGES_AS_CODED if as_coded else catalog.WEIGHT_EDGES
    chosen = F.when(weight <= edges[0], F.lit(None).cast("string"))
    for high, label in zip(edges[1:], catalog.WEIGHT_LABELS):
        chosen = chosen.when(F.lit(True) if high is None else weight <= high, F.lit(label))
    return F.when(weight.isNotNull(), chosen)


def source_date(text: Column, pivot_year: int = 2068, fillers: tuple[str, ...] = ()) -> Column:
    """Date from ``d-MMM-yy`` text, NULL if it does not parse or is a known filler.

    Two-digit years are read as 20yy; those after ``pivot_year`` belong to the century before.
    """
    trimmed = F.trim(text)
    parsed = F.to_date(F.try_to_timestamp(trimmed, F.lit("d-MMM-yy")))
    dated = F.when(F.year(parsed) > pivot_year, F.add_months(parsed, -1200)).otherwise(parsed)
    return F.when(F.upper(trimmed).isin([f.upper() for f in fillers]), None).otherwise(dated) if fillers else dated


def number_or_null(text: Column, kind: str = "double") -> Column:
    return text.try_cast(kind)


def step_label(step: Column) -> Column:
    """Sweep step in hundredths as text: -0.20 … 0 … 0.20."""
    return F.when(step == 0, F.lit("0")).otherwise(F.format_string("%.2f", step / F.lit(100.0)))


def composite_key(*cols: Column) -> Column:
    """Parts joined by '_'; NULL if any part is missing."""
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.concat_ws("_", *cols))

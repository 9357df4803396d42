"""Best incentive per (bid, product), alone or along the air ladder; weight scenarios."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tenderline import catalog
from tenderline.catalog import values_frame
from tenderline.functions.objective import NUMBERS, objective, objective_at, slope
from tenderline.functions.scalars import flag
from tenderline.operators.ladder import GRID, MEMBERS, best_on_ladder
from tenderline.plans.bounds import market_clamped

SCENARIO = "scenario"


def ladder_ratios(strict: bool = True, as_coded: bool = False) -> dict[str, float | None]:
    """Ratio per set of air products: full ladder uses 12 and 23, a pair its own.

    As coded, the pair of the 1st and 2nd product gets the ratio of 1st and 3rd, and the pair
    of the 1st and 3rd is left free.
    """
    table = catalog.LADDER_STRICT if strict else catalog.LADDER_RELAXED
    r12, r23, r13 = table[("1DA", "2DA")], table[("2DA", "3DA")], table[("1DA", "3DA")]
    return {"r12": r12, "r23": r23, "pair12": r13 if as_coded else r12, "pair13": None if as_coded else r13}


def add_weights(rows: DataFrame, overlay: DataFrame | None = None) -> DataFrame:
    """Objective weights by mode, the volume weight raised by the strategic overlay if given."""
    from tenderline.plans.industry import with_overlay

    mode = F.col("mode")
    weighted = rows.withColumn("price_discipline", catalog.by_mode(mode, "price_discipline")).withColumn(
        "volume_weight", catalog.by_mode(mode, "volume_weight")
    )
    return weighted if overlay is None else with_overlay(weighted, overlay)


def weight_scenarios(spark, low_p: float, high_p: float, step_p: float, low_v: float, high_v: float, step_v: float) -> DataFrame:
    """All (price discipline, volume) weights on stepped ranges; discipline 1 is a single case."""

    def steps(low: float, high: float, step: float) -> list[float]:
        start, stop = max(low, 0.0), min(high + 0.1, 1.1)
        count = max(0, -int(-(stop - start) // step))
        return [round(start + i * step, 10) for i in range(count) if start + i * step < stop - 1e-12]

    rows = []
    for p in steps(low_p, high_p, step_p):
        for v in [0.0] if p == 1 else steps(low_v, high_v, step_v):
            rows.append((len(rows), p, v))
    return values_frame(spark, "scenario int, price_discipline double, volume_weight double", rows)


def with_scenarios(rows: DataFrame, scenarios: DataFrame) -> DataFrame:
    """Every row under every weight scenario (a short literal list, sent to all tasks)."""
    return rows.drop("price_discipline", "volume_weight").crossJoin(F.broadcast(scenarios))


def add_ladder(rows: DataFrame, strict: bool = True, as_coded: bool = False, group: tuple[str, ...] = ("bid_id",)) -> DataFrame:
    """Rank along the air ladder, ratio to the rank below, and the reachable upper bound.

    The windows hold the air rows of one bid, three at most. ``cap`` is the upper bound under
    the ladder; ``valid`` tells whether every laddered row has room below it.
    """
    ratios = ladder_ratios(strict, as_coded)
    air = F.when(F.col("mode") == "AIR", F.col("product"))
    w = Window.partitionBy(*group, "mode")

    def upper_of(product: str) -> Column:
        return F.max(F.when(air == product, F.col("upper"))).over(w)

    known = rows.withColumn("u1", upper_of("1DA")).withColumn("u2", upper_of("2DA")).withColumn("u3", upper_of("3DA"))
    has1, has2, has3 = F.col("u1").isNotNull(), F.col("u2").isNotNull(), F.col("u3").isNotNull()
    r12 = F.when(has3, ratios["r12"]).otherwise(ratios["pair12"])
    r23 = F.lit(ratios["r23"])
    tied13 = ratios["pair13"] is not None
    r13 = F.lit(ratios["pair13"] if tied13 else 1.0)

    def capped(own: Column, ratio: Column, above: Column) -> Column:
        return F.least(own, ratio * above + (1.0 - ratio))

    cap2 = F.when(has3, capped(F.col("u2"), r23, F.col("u3"))).otherwise(F.col("u2"))
    cap1 = F.when(has2, capped(F.col("u1"), r12, cap2))
    if tied13:
        cap1 = cap1.when(has3, capped(F.col("u1"), r13, F.col("u3")))
    cap1 = cap1.otherwise(F.col("u1"))
    members = has1.cast("int") + has2.cast("int") + has3.cast("int")
    laddered = (F.col("mode") == "AIR") & (members >= 2)
    if not tied13:
        laddered = laddered & has2
    product = F.col("product")
    rank = F.when(product == "1DA", F.lit(1)).when(product == "2DA", F.when(has1, 2).otherwise(1)).when(product == "3DA", members)
    ratio = F.when(product == "2DA", F.when(has1, r12)).when(product == "3DA", F.when(has2, r23).otherwise(r13))
    return (
        known.withColumn("laddered", laddered)
        .withColumn("cap", F.when(laddered, F.when(product == "1DA", cap1).when(product == "2DA", cap2).otherwise(F.col("u3"))).otherwise(F.col("upper")))
        .withColumn("rank", F.when(laddered, rank))
        .withColumn("ratio", F.when(laddered, ratio))
        .withColumn("valid", F.min((F.col("cap") > F.col("lower")).cast("int")).over(w) == 1)
        .drop("u1", "u2", "u3")
    )


def row_objective(x: str) -> Column:
    return objective(x).total


#: What a ladder tells each of its members about every member.
_MEMBER = ["lower", "cap", "ratio", *NUMBERS, "feasible", "l_floor", "ceiling"]


def optimise(rows: DataFrame, points: int = GRID, strict: bool = True, as_coded: bool = False, group: tuple[str, ...] = ("bid_id",), current: str | None = None) -> DataFrame:
    """Add the optimal incentive and what it yields to bounded rows.

    ``rows`` is one row per (group, product) with bounds, response, weights and market
    incentive; rows without a group or product are left out. Windows over the products of one
    (group, mode) give each row the numbers of its ladder, so search, flags and results are
    columns of the row itself: rows are placed by group once (not at all if they already are)
    and nothing is written or joined back. ``current`` names an incentive column to evaluate
    alongside.

    A row whose objective is unknown (a missing response, cost, revenue or market incentive) is
    not searched, nor is a laddered group with such a member: they get the clamped market
    incentive and flag -1. Flag 1 marks groups without room under the ladder, 0 all others.
    """
    keys = [*group, "product"]
    c = F.col
    together = Window.partitionBy(*group, "mode")
    ladder = add_ladder(rows.dropna(subset=keys), strict, as_coded, group)
    known = row_objective("lower").isNotNull()
    member = F.struct(*[c(name) for name in _MEMBER])
    ladder = ladder.withColumns({
        "known": F.when(c("laddered"), F.min(known).over(together)).otherwise(known),
        **{f"m{r}": F.max(F.when(c("rank") == r, member)).over(together) for r in range(1, MEMBERS + 1)},
    })
    searched = c("valid") & c("known") & ~(c("price_discipline") == 1)
    members = []
    for r in range(1, MEMBERS + 1):
        own = {name: F.when(c("laddered"), c(f"m{r}")[name]) for name in ["lower", "cap", "ratio", *NUMBERS]}
        if r == 1:  # a row without a ladder is the only member of its own
            own = {name: column.otherwise(c(name)) for name, column in own.items()}
            own["lower"] = F.when(searched, own["lower"])
        members.append(own)
    found = ladder.withColumn("path", best_on_ladder(members, NUMBERS, objective_at, points))
    others = [name for name in rows.columns if name not in keys]
    return results_at_optimum(optimum_of(found, points).select(*keys, *others, *_OUTCOME), current)


_OUTCOME = ["laddered", "rank", "ratio", "cap", "valid", "best_k", "optimal_inc", "flag", "upper_binds", "lower_binds", "ladder_binds"]


def _chosen(member: Callable[[str], Column], k: Column, points: int) -> Column:
    """A member's incentive: its best grid point, else the clamped market incentive."""
    on_grid = member("lower") + (member("cap") - member("lower")) * k / F.lit(float(points))
    clamped = market_clamped(member("market_inc"), member("l_floor"), member("ceiling"))
    return F.when(k.isNotNull() & member("feasible"), on_grid).otherwise(clamped)


def optimum_of(rows: DataFrame, points: int) -> DataFrame:
    """Optimal incentive with its flags, from rows with their ladder (m1..m3) and its best path."""
    c = F.col
    best_k = F.when(c("rank") == 2, c("path.k2")).when(c("rank") == 3, c("path.k3")).otherwise(c("path.k1"))

    def binds(r: int) -> Column:
        low, own = (lambda name: c(f"m{r - 1}")[name]), (lambda name: c(f"m{r}")[name])
        step = F.greatest((low("cap") - low("lower")) / F.lit(float(points)), F.lit(1e-5))
        here, below = _chosen(own, c(f"path.k{r}"), points), _chosen(low, c(f"path.k{r - 1}"), points)
        return flag(own("ratio") * here + (1.0 - own("ratio")) - below < step)

    # ladder digits: the k-th constraint of the group adds 10^k where it binds
    ladder_binds = F.when(c("laddered"), binds(2) + 10 * binds(3)).otherwise(0)
    return (
        rows.withColumn("best_k", best_k)
        .withColumn("optimal_inc", _chosen(c, c("best_k"), points))
        .withColumn("flag", F.when(F.coalesce(c("price_discipline") == 1, F.lit(False)), 0).when(~c("valid"), 1).when(c("best_k").isNull(), -1).otherwise(0))
        .withColumn("upper_binds", flag(c("upper") - c("optimal_inc") < 1e-5))
        .withColumn("lower_binds", flag(c("optimal_inc") - c("lower") < 1e-5))
        .withColumn("ladder_binds", ladder_binds)
    )


def results_at_optimum(rows: DataFrame, current: str | None = None) -> DataFrame:
    """The objective's terms at the optimum, and at a current incentive if one is named."""
    best = objective("optimal_inc")
    rows = (
        rows.withColumn("optimal_profit", best.profit)
        .withColumn("optimal_pull_through", best.pull_through)
        .withColumn("optimal_slope", slope("optimal_inc"))
    )
    if current is not None:
        now = objective(current)
        rows = rows.withColumn("current_profit", now.profit).withColumn("current_pull_through", now.pull_through)
    return rows


def group_objective(rows: DataFrame, incentive: str, group: tuple[str, ...] = ("bid_id",)) -> DataFrame:
    """Objective per unit of list revenue and total profit of each (group, mode)."""
    terms = objective(incentive)
    return rows.groupBy(*group, "mode").agg(
        F.try_divide(F.sum(terms.total), F.sum("list_rev")).alias("objective"), F.sum(terms.profit).alias("profit")
    )

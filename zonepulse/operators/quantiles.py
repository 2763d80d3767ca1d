"""Exact order statistics without gathering a column into one task."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil, floor

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse.functions.columns import as_col

ACCURACY = 1_000
STEP = 2.0 / ACCURACY
# At this accuracy the sketch drops nothing from an input of bounded size.
EXACT = 2_000_000_000


@dataclass
class _Target:
    """The ``rank``-th smallest value (from 0) of a column.

    It is one of ``inside`` values in the open range (lo, hi), of which
    ``below`` values lie to the left.
    """

    col: str
    rank: int
    inside: int
    below: int = 0
    lo: object = None
    hi: object = None
    value: object = None
    found: bool = False

    def within(self) -> Column:
        c = as_col(self.col)
        cond = c.isNotNull()
        if self.lo is not None:
            cond = cond & (c > F.lit(self.lo))
        if self.hi is not None:
            cond = cond & (c < F.lit(self.hi))
        return cond

    def share(self) -> float:
        return (self.rank - self.below + 0.5) / self.inside


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    interpolate: bool = False,
    direct_rows: int = 50_000,
) -> dict[str, dict[float, float | None]]:
    """Quantiles of several columns at once, as driver scalars.

    A sketch gives a value on either side of each wanted rank, one counting
    pass says where the rank lies relative to them, and this repeats until at
    most ``direct_rows`` candidates are left, of which the value is taken
    exactly. Every pass is one aggregation over all columns, so a task sends
    one row. ``interpolate`` is the linear rule, else the smallest value that
    covers the share.
    """
    around = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-STEP, STEP)]
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count(as_col(c)).alias(f"n{i}"), F.percentile_approx(as_col(c), around, ACCURACY).alias(f"s{i}")]
    first = df.agg(*aggs).first()

    targets: dict[tuple[str, int], _Target] = {}
    bracket: dict[tuple[str, int], tuple] = {}
    plan: dict[tuple[str, float], tuple[int, int, float] | None] = {}
    for i, c in enumerate(cols):
        n = first[f"n{i}"]
        for j, p in enumerate(probs):
            if n == 0:
                plan[c, p] = None
                continue
            pos = p * (n - 1) if interpolate else max(ceil(round(p * n, 9)) - 1, 0)
            low, high = floor(pos), ceil(pos)
            plan[c, p] = (low, high, pos - low)
            for r in {low, high}:
                targets.setdefault((c, r), _Target(c, r, inside=n))
                bracket.setdefault((c, r), (first[f"s{i}"][2 * j], first[f"s{i}"][2 * j + 1]))

    def still_wide():
        return [k for k, t in targets.items() if not t.found and t.inside > direct_rows]

    if keys := still_wide():
        _narrow(df, [(targets[k], *bracket[k]) for k in keys])
    while keys := still_wide():
        _narrow(df, _sketch(df, [targets[k] for k in keys]))
    _pick(df, [t for t in targets.values() if not t.found])

    out: dict[str, dict[float, float | None]] = {c: {} for c in cols}
    for (c, p), where in plan.items():
        if where is None:
            out[c][p] = None
            continue
        low, high, part = where
        a, b = targets[c, low].value, targets[c, high].value
        out[c][p] = a if part == 0 else a + (b - a) * part
    return out


def _by_range(targets: list[_Target]) -> list[list[_Target]]:
    """Targets that look at the same column and range share their sketch."""
    groups: dict[tuple, list[_Target]] = {}
    for t in targets:
        groups.setdefault((t.col, t.lo, t.hi), []).append(t)
    return list(groups.values())


def _in_range(t: _Target) -> Column:
    return F.when(t.within(), as_col(t.col))


def _sketch(df: DataFrame, wide: list[_Target]) -> list[tuple]:
    """A value on either side of each target, from its own range."""
    groups = _by_range(wide)
    aggs = []
    for i, group in enumerate(groups):
        ends = [min(max(t.share() + d, 0.0), 1.0) for t in group for d in (-STEP, STEP)]
        aggs.append(F.percentile_approx(_in_range(group[0]), ends, ACCURACY).alias(f"s{i}"))
    row = df.agg(*aggs).first()
    return [(t, row[f"s{i}"][2 * j], row[f"s{i}"][2 * j + 1]) for i, g in enumerate(groups) for j, t in enumerate(g)]


def _narrow(df: DataFrame, brackets: list[tuple]) -> None:
    """Count around both values of each bracket and keep the part that holds the rank."""
    tallies: dict[tuple, Column] = {}
    for t, a, b in brackets:
        for v in (a, b):
            key = (t.col, t.lo, t.hi, v)
            if key not in tallies:
                c, inside = as_col(t.col), t.within()
                tallies[key] = F.struct(F.count_if(inside & (c < F.lit(v))), F.count_if(inside & (c <= F.lit(v))))
    row = df.agg(*[c.alias(f"t{i}") for i, c in enumerate(tallies.values())]).first()
    counted = dict(zip(tallies, row))
    for t, a, b in brackets:
        want = t.rank - t.below
        lt_a, le_a = counted[t.col, t.lo, t.hi, a]
        lt_b, le_b = counted[t.col, t.lo, t.hi, b]
        if lt_a <= want < le_a:
            t.value, t.found = a, True
        elif lt_b <= want < le_b:
            t.value, t.found = b, True
        elif want < lt_a:
            t.hi, t.inside = a, lt_a
        elif want < lt_b:
            t.lo, t.hi, t.below, t.inside = a, b, t.below + le_a, lt_b - le_a
        else:
            t.lo, t.below, t.inside = b, t.below + le_b, t.inside - le_b


def _pick(df: DataFrame, left: list[_Target]) -> None:
    """The exact value among a bounded number of candidates per target."""
    if not left:
        return
    groups = _by_range(left)
    aggs = [
        F.percentile_approx(_in_range(g[0]), [t.share() for t in g], EXACT).alias(f"v{i}") for i, g in enumerate(groups)
    ]
    row = df.agg(*aggs).first()
    for i, group in enumerate(groups):
        for t, value in zip(group, row[f"v{i}"]):
            t.value, t.found = value, True

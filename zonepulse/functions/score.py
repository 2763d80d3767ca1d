"""Scores, bands and error terms."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col


def null_safe_total(*cols: Column | str) -> Column:
    """Sum that counts a null part as zero."""
    total = F.lit(0.0)
    for c in cols:
        total = total + F.coalesce(as_col(c).try_cast("double"), F.lit(0.0))
    return total


def mean_nonzero(*cols: Column | str) -> Column:
    """Mean of the positive values; zero if there is none."""
    values = F.filter(F.array(*[as_col(c).cast("double") for c in cols]), lambda v: v > 0)
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)
    return F.when(F.size(values) > 0, total / F.size(values)).otherwise(0.0)


def relative_shift(reference: Column | str, current: Column | str) -> Column:
    """Relative change clipped to 1; a move away from zero counts as 1."""
    ref, cur = as_col(reference), as_col(current)
    return (
        F.when((ref == 0) & (cur == 0), 0.0)
        .when(ref == 0, 1.0)
        .otherwise(F.least(F.abs(cur - ref) / F.abs(F.nullif(ref, F.lit(0.0))), F.lit(1.0)))
    )


def severity(score: Column | str) -> Column:
    s = as_col(score)
    return (
        F.when(s >= S.CRITICAL, "Critical")
        .when(s >= S.HIGH, "High")
        .when(s >= S.MEDIUM, "Medium")
        .otherwise("Healthy")
    )


def feature_kind(name: Column | str) -> Column:
    n = as_col(name)
    return (
        F.when(n.isin(*S.NUMERIC_FEATURES), "numeric_mean_shift")
        .when(n.isin(*S.ONE_HOT_FEATURES), "categorical_proportion_shift")
        .otherwise("unknown")
    )


def demand_score(pred: Column | str, lo: float = S.SCORE_LOW, hi: float = S.SCORE_HIGH) -> Column:
    """Predicted demand scaled to [0, 1], four decimals."""
    if hi <= lo:
        return F.lit(0.0)
    scaled = (as_col(pred) - F.lit(lo)) / F.lit(hi - lo)
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), scaled)), 4)


def clamp01(x: Column | str) -> Column:
    v = as_col(x).cast("double")
    return F.when(F.isnan(v), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), v)))


def percent(x: Column | str) -> Column:
    """``"42%"``, rounding halves up."""
    return F.concat(F.floor(clamp01(x) * 100 + 0.5).cast("string"), F.lit("%"))


def rounded(x: Column | str, digits: int) -> Column:
    return F.round(as_col(x), digits)


def smape_term(label: Column | str, pred: Column | str, eps: float = 1e-8) -> Column:
    y, p = as_col(label), as_col(pred)
    return 2 * F.abs(p - y) / (F.abs(y) + F.abs(p) + F.lit(eps))


def smape(label: Column | str, pred: Column | str, eps: float = 1e-8) -> Column:
    """Aggregate: symmetric mean absolute percentage error."""
    return F.avg(smape_term(label, pred, eps))

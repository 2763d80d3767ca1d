"""Summaries of feature rows that add up, so that a period is read once and drift needs no rows.

A summary row holds, for each feature, how many values there are and their sum; for the label also its squared deviations
and a quantile sketch; and, where there are predictions, sums of their errors. Summaries of months merge to those of any
span. The sketch's ranks are off by about 1.3 percent at most with 99 percent confidence (a KLL sketch of 200 items, the
default); everything else is as exact as sums of doubles.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.score import feature_kind, relative_shift, severity

FEATURES = "array<struct<feature:string,n:bigint,total:double>>"


def _zero(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def summarise(df: DataFrame, by: Mapping[str, Column], features: Sequence[str], label: str = "target_demand", pred: str = "prediction") -> DataFrame:
    """One row per group: (by, n_rows, features, label, errors); one aggregation, a task sends one row per group."""
    x = as_col(label).cast("double")
    entries = [F.struct(F.lit(f).alias("feature"), F.count(as_col(f)).alias("n"), F.sum(as_col(f).cast("double")).alias("total")) for f in features]
    spread = F.struct(
        F.count(x).alias("n"), F.avg(x).alias("mean"), (F.var_pop(x) * F.count(x)).alias("m2"), F.kll_sketch_agg_double(x).alias("sketch")
    )
    if pred in df.columns:
        gap, p = as_col(pred).cast("double") - x, as_col(pred).cast("double")
        share = 2 * F.abs(gap) / (F.abs(x) + F.abs(p) + F.lit(1e-8))
        errors = F.struct(F.count(gap).alias("n"), F.sum(gap * gap).alias("squares"), F.sum(F.abs(gap)).alias("absolute"), F.sum(share).alias("shares"))
    else:
        errors = F.struct(F.lit(0).cast("long").alias("n"), *[F.lit(None).cast("double").alias(c) for c in ("squares", "absolute", "shares")])
    grouped = df.groupBy(*[c.alias(name) for name, c in by.items()])
    return grouped.agg(F.count("*").alias("n_rows"), F.array(*entries).alias("features"), spread.alias("label"), errors.alias("errors"))


def merge(rows: DataFrame, by: Mapping[str, Column]) -> DataFrame:
    """Summaries of groups of summaries."""
    keyed = rows.select(*[c.alias(name) for name, c in by.items()], "n_rows", "features", "label", "errors")
    parts = keyed.select(*by, F.inline("features")).groupBy(*by, "feature").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    parts = parts.groupBy(*by).agg(F.collect_list(F.struct("feature", "n", "total")).alias("features"))
    n = F.sum("label.n")
    mean = F.sum(F.col("label.n") * F.col("label.mean")) / F.nullif(n, F.lit(0))
    of_means = F.sum(F.col("label.n") * F.col("label.mean") * F.col("label.mean"))
    whole = keyed.groupBy(*by).agg(
        F.sum("n_rows").alias("n_rows"),
        F.struct(
            n.alias("n"), mean.alias("mean"), F.greatest(F.sum("label.m2") + of_means - n * mean * mean, F.lit(0.0)).alias("m2"),
            F.kll_merge_agg_double("label.sketch").alias("sketch"),
        ).alias("label"),
        F.struct(F.sum("errors.n").alias("n"), *[F.sum(f"errors.{c}").alias(c) for c in ("squares", "absolute", "shares")]).alias("errors"),
    )
    return whole.join(parts, list(by)).select(*by, "n_rows", "features", "label", "errors")


def _side(value: Column, live: bool) -> Column:
    return F.max(F.when(F.col("live") == live, value))


def _by_feature(sides: DataFrame) -> DataFrame:
    long = sides.select("live", F.inline("features"))
    mean = F.col("total") / F.nullif(F.col("n"), F.lit(0))
    return long.groupBy("feature").agg(
        _zero(_side(mean, False)).alias("reference_value"), _zero(_side(mean, True)).alias("current_value"),
        F.coalesce(_side(F.col("n"), False), F.lit(0)).alias("reference_rows"), F.coalesce(_side(F.col("n"), True), F.lit(0)).alias("live_rows"),
    )


def feature_drift_of(sides: DataFrame) -> DataFrame:
    """Mean shift per feature from the summaries (``live`` false or true) of both sides."""
    score = relative_shift("reference_value", "current_value")
    return _by_feature(sides).select(
        "feature", feature_kind("feature").alias("feature_type"), "reference_value", "current_value", score.alias("drift_score"), severity(score).alias("severity")
    )


def coverage_of(sides: DataFrame, missing: Sequence[str]) -> DataFrame:
    """Each wanted feature with its status and the non-null rows on both sides."""
    out = _by_feature(sides).select("feature", "reference_rows", "live_rows", F.lit("usable").alias("status"))
    absent = [(f, "missing") for f in missing] + [(f, "excluded") for f in S.DRIFT_EXCLUDED]
    rest = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(s).alias("status")) for f, s in absent])
    return out.unionByName(out.sparkSession.range(1).select(F.inline(rest)), allowMissingColumns=True) if absent else out


def label_drift_of(sides: DataFrame, label: str) -> DataFrame:
    """One row: moments and percentiles of both sides, shift, band and alert."""
    quantile = lambda p: F.when(F.col("label.n") > 0, F.kll_sketch_get_quantile_double("label.sketch", F.lit(p)))
    std = F.sqrt(F.col("label.m2") / F.nullif(F.col("label.n") - 1, F.lit(0)))
    measures = {"mean": F.col("label.mean"), "std": std, "p50": quantile(0.5), "p90": quantile(0.9)}
    plain = sides.select("live", *[c.alias(m) for m, c in measures.items()])
    row = plain.agg(*[_zero(_side(F.col(m), live)).alias(f"{name}_{m}") for name, live in (("reference", False), ("live", True)) for m in measures])
    score = relative_shift("reference_mean", "live_mean")
    return row.select(F.lit(label).alias("label"), "*", score.alias("drift_score"), severity(score).alias("severity"), (score >= S.LABEL_DRIFT_ALERT).alias("should_alert"))


def errors_of(sides: DataFrame) -> DataFrame:
    """(rmse, mae, smape) of the live side's predictions."""
    live = sides.filter("live").select("errors.*")
    n = F.nullif(F.sum("n"), F.lit(0))
    return live.agg(F.sqrt(F.sum("squares") / n).alias("rmse"), (F.sum("absolute") / n).alias("mae"), (F.sum("shares") / n).alias("smape"))

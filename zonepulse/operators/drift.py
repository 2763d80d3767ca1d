"""Feature, label and model drift between a reference and a live period."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.score import feature_kind, relative_shift, severity, smape
from zonepulse.operators.profile import to_long, wide_agg
from zonepulse.operators.quantiles import exact_quantiles

_STATS = {"mean": F.avg, "std": F.stddev}


def _zero(c: Column) -> Column:
    return F.coalesce(c.cast("double"), F.lit(0.0))


def summary_stats(
    df: DataFrame, features: Sequence[str], percentiles: Sequence[float] = (0.5, 0.9), exact: bool = False
) -> DataFrame:
    """(feature, mean, std, p50, …) per feature; null statistics read as zero.

    The percentiles come from a sketch in the same pass, or exactly from
    further counting passes.
    """
    measures = {k: (lambda c, f=f: _zero(f(c))) for k, f in _STATS.items()}
    if not exact:
        for p in percentiles:
            measures[_p(p)] = lambda c, p=p: _zero(F.percentile_approx(c, p))
    long = to_long(wide_agg(df, features, measures), features, measures, "feature")
    if exact and percentiles:
        found = exact_quantiles(df, features, percentiles)
        for p in percentiles:
            value = F.lit(0.0)
            for f in features:
                value = F.when(F.col("feature") == f, F.lit(float(found[f][p] or 0.0))).otherwise(value)
            long = long.withColumn(_p(p), value)
    return long


def _p(p: float) -> str:
    return f"p{round(p * 100)}"


def feature_stat(df: DataFrame, features: Sequence[str], stat: str) -> DataFrame:
    """One statistic per feature: ``mean``, ``std`` or a percentile such as ``p90``."""
    if stat in _STATS:
        make = _STATS[stat]
    else:
        share = int(stat[1:]) / 100
        make = lambda c: F.percentile_approx(c, share)
    measures = {"value": lambda c: _zero(make(c))}
    return to_long(wide_agg(df, features, measures), features, measures, "feature")


def feature_drift(reference: DataFrame, live: DataFrame, features: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """Mean shift per feature; both sides go through one tagged aggregation."""
    usable, _ = S.usable_features(reference, live, features)
    sides = reference.select(F.lit(0).alias("_side"), *[as_col(f) for f in usable]).unionByName(
        live.select(F.lit(1).alias("_side"), *[as_col(f) for f in usable])
    )
    means = sides.groupBy("_side").agg(*[F.avg(as_col(f)).alias(f"m{i}") for i, f in enumerate(usable)])
    both = means.agg(
        *[
            F.struct(
                F.lit(f).alias("feature"),
                _zero(F.max(F.when(F.col("_side") == 0, F.col(f"m{i}")))).alias("reference_value"),
                _zero(F.max(F.when(F.col("_side") == 1, F.col(f"m{i}")))).alias("current_value"),
            ).alias(f"s{i}")
            for i, f in enumerate(usable)
        ]
    )
    long = both.select(F.inline(F.array(*[F.col(f"s{i}") for i in range(len(usable))])))
    score = relative_shift("reference_value", "current_value")
    return long.select(
        "feature",
        feature_kind("feature").alias("feature_type"),
        "reference_value",
        "current_value",
        score.alias("drift_score"),
        severity(score).alias("severity"),
    )


def feature_coverage(reference: DataFrame, live: DataFrame, wanted: Sequence[str] = S.MONITORED_FEATURES) -> DataFrame:
    """Each wanted feature with its status and the non-null rows on both sides."""
    usable, missing = S.usable_features(reference, live, wanted)

    def filled(df):
        row = df.agg(*[F.count(as_col(f)).alias(f"rows__{i}") for i, f in enumerate(usable)])
        return to_long(row, usable, {"rows": None}, "feature")

    out = filled(reference).withColumnRenamed("rows", "reference_rows").join(
        filled(live).withColumnRenamed("rows", "live_rows"), "feature"
    )
    out = out.withColumn("status", F.lit("usable"))
    absent = [(f, "missing") for f in missing] + [(f, "excluded") for f in S.DRIFT_EXCLUDED]
    rest = F.array(*[F.struct(F.lit(f).alias("feature"), F.lit(s).alias("status")) for f, s in absent])
    return out.unionByName(out.sparkSession.range(1).select(F.inline(rest)), allowMissingColumns=True)


def drift_rollup(stats: DataFrame, score: str = "drift_score") -> DataFrame:
    s = as_col(score)
    return stats.agg(
        _zero(F.avg(s)).alias("avg_feature_drift"),
        F.count_if(s >= S.HIGH).cast("int").alias("high_drift_count"),
        F.count_if(s >= S.CRITICAL).cast("int").alias("critical_count"),
    )


def dashboard_rollup(stats: DataFrame, score: str = "drift_score") -> DataFrame:
    """Counts by band and the score that sets the headline status."""
    s = as_col(score)
    row = stats.agg(
        F.count("*").alias("n_features"),
        _zero(F.avg(s)).alias("avg_drift"),
        F.count_if(s >= S.CRITICAL).alias("critical_count"),
        F.count_if(s >= S.HIGH).alias("high_count"),
        F.count_if(s < S.MEDIUM).alias("healthy_count"),
    )
    worst = (
        F.when(F.col("critical_count") > 0, S.CRITICAL)
        .when(F.col("high_count") > 0, S.HIGH)
        .otherwise(F.col("avg_drift"))
    )
    return row.withColumn("worst_score", worst).withColumn("status", severity("worst_score"))


def at_least(df: DataFrame, col: str, threshold: float = S.MEDIUM) -> DataFrame:
    return df.filter(as_col(col) >= threshold)


def top_drift(stats: DataFrame, n: int = 10) -> DataFrame:
    return stats.orderBy(F.col("drift_score").desc(), F.col("feature").asc()).limit(n)


def _label_side(df: DataFrame, label: str, side: str, exact: bool) -> DataFrame:
    stats = summary_stats(df, [label], (0.5, 0.9), exact)
    return stats.select(*[F.col(c).alias(f"{side}_{c}") for c in ("mean", "std", "p50", "p90")])


def label_drift(reference: DataFrame, live: DataFrame, label: str = "target_demand", exact: bool = False) -> DataFrame:
    """One row: moments and percentiles of both sides, shift, band and alert."""
    both = _one_row(_label_side(reference, label, "reference", exact), _label_side(live, label, "live", exact))
    score = relative_shift("reference_mean", "live_mean")
    return both.select(
        F.lit(label).alias("label"),
        "*",
        score.alias("drift_score"),
        severity(score).alias("severity"),
        (score >= S.LABEL_DRIFT_ALERT).alias("should_alert"),
    )


def _one_row(*rows: DataFrame) -> DataFrame:
    """One-row frames side by side, as scalar subqueries of the first."""
    out = rows[0]
    for extra in rows[1:]:
        packed = extra.select(F.struct(*[as_col(c) for c in extra.columns]).alias("s")).scalar()
        out = out.withColumns({c: packed[c] for c in extra.columns})
    return out


def regression_error(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """RMSE, MAE and SMAPE in one pass."""
    gap = as_col(pred) - as_col(label)
    return df.agg(
        F.sqrt(F.avg(gap * gap)).alias("rmse"), F.avg(F.abs(gap)).alias("mae"), smape(label, pred).alias("smape")
    )


def model_drift(
    live: DataFrame, model=None, baseline: float = S.BASELINE_RMSE, label: str = "target_demand"
) -> DataFrame:
    """Live error against the baseline. Without a model the frame must hold ``prediction``."""
    scored = live if model is None else model.transform(live)
    return model_drift_of(regression_error(scored, label, "prediction"), baseline)


def model_drift_of(errors: DataFrame, baseline: float = S.BASELINE_RMSE) -> DataFrame:
    """The row of ``model_drift`` from (rmse, mae, smape)."""
    ratio = (F.col("rmse") - baseline) / baseline if baseline > 0 else F.lit(0.0)
    return errors.select(
        F.lit(float(baseline)).alias("baseline_rmse"),
        F.col("rmse").alias("live_rmse"),
        F.col("mae").alias("live_mae"),
        F.col("smape").alias("live_smape"),
        ratio.alias("rmse_ratio"),
        severity(F.least(F.greatest(ratio, F.lit(0.0)), F.lit(1.0))).alias("severity"),
        (ratio >= S.MODEL_DRIFT_ALERT).alias("should_alert"),
    )


def _flag(name: str) -> Column:
    return F.coalesce(as_col(name), F.lit(False))


def should_alert(
    critical: str = "critical_count",
    high: str = "high_drift_count",
    label: str = "label_should_alert",
    model: str = "model_should_alert",
) -> Column:
    """Any critical feature, two high ones, or a label or model alert."""
    return (as_col(critical) > 0) | (as_col(high) >= S.MIN_HIGH_FEATURES) | _flag(label) | _flag(model)


def overall_status() -> Column:
    """Critical, High, Medium or Low over a drift summary row."""
    critical = (F.col("critical_count") > 0) | F.coalesce(F.col("label_severity") == "Critical", F.lit(False))
    high = (F.col("high_drift_count") >= S.MIN_HIGH_FEATURES) | _flag("label_should_alert") | _flag("model_should_alert")
    medium = (_zero(F.col("avg_feature_drift")) >= S.MEDIUM) | (_zero(F.col("label_drift_score")) >= S.MEDIUM)
    return F.when(critical, "Critical").when(high, "High").when(medium, "Medium").otherwise("Low")


def retrain_trigger(month: str = "data_month", status: str = "overall_status") -> Column:
    """Half-yearly, or after high drift."""
    return F.month(month).isin(*S.RETRAIN_MONTHS) | F.coalesce(as_col(status).isin("High", "Critical"), F.lit(False))


def latest_or_month(summary: DataFrame, month: str | None = None, col: str = "data_month") -> DataFrame:
    """The row of one month (``YYYY-MM``), else the latest."""
    if month is not None:
        return summary.filter(F.col(col) == F.lit(f"{month}-01").cast("date"))
    return summary.orderBy(F.col(col).desc()).limit(1)


def drift_for_month(summary: DataFrame, features: DataFrame, month: str | None = None) -> DataFrame:
    """Feature rows joined to their run's summary, the chosen month only."""
    run = latest_or_month(summary, month)
    kept = [c for c in run.columns if c == "data_month" or c not in features.columns]
    return features.join(run.select(*kept), "data_month")


def drift_view(summary: DataFrame, features: DataFrame, month: str | None = None) -> DataFrame:
    """Report layout: feature rows with nested label and model blocks."""
    rows = drift_for_month(summary, features, month)
    return rows.select(
        "feature",
        F.col("feature_type").alias("featureType"),
        F.col("reference_value").alias("trainingMean"),
        F.col("current_value").alias("currentMean"),
        F.col("drift_score").alias("driftScore"),
        "severity",
        F.date_format("data_month", "yyyy-MM-dd").alias("dataMonth"),
        F.col("avg_feature_drift").alias("avgDriftScore"),
        F.col("high_drift_count").alias("highDriftCount"),
        F.col("critical_count").alias("criticalCount"),
        F.col("overall_status").alias("overallStatus"),
        F.col("training_triggered").alias("trainingTriggered"),
        F.struct(
            F.col("label_drift_score").alias("driftScore"),
            F.col("label_severity").alias("severity"),
            F.col("label_should_alert").alias("shouldAlert"),
        ).alias("labelDrift"),
        F.struct(
            F.col("model_rmse_ratio").alias("rmseDegradationRatio"),
            F.col("model_severity").alias("severity"),
            F.col("model_should_alert").alias("shouldAlert"),
        ).alias("modelDrift"),
    )


def drift_history(summary: DataFrame) -> DataFrame:
    """Monthly timeline, oldest first."""
    cols = ("data_month", "overall_status", "avg_feature_drift", "high_drift_count", "critical_count", "training_triggered")
    return summary.select(*cols).orderBy("data_month")


def feature_group_table(spark, groups: Mapping[str, Sequence[str]] = S.FEATURE_GROUPS) -> DataFrame:
    rows = [
        F.struct(F.lit(g).alias("feature_group"), F.lit(i).alias("group_order"), F.lit(f).alias("feature"))
        for i, (g, fs) in enumerate(groups.items())
        for f in fs
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def with_feature_group(stats: DataFrame, groups: DataFrame) -> DataFrame:
    """Features with their display group; ungrouped ones drop out."""
    return stats.join(groups, "feature")


def top_groups(stats: DataFrame, groups: DataFrame, n: int = 2) -> DataFrame:
    """First ``n`` display groups, features ranked by drift inside each."""
    w = Window.partitionBy("feature_group").orderBy(F.col("drift_score").desc(), F.col("feature").asc())
    shown = with_feature_group(stats, groups).filter(F.col("group_order") < n)
    return shown.withColumn("group_rank", F.row_number().over(w))

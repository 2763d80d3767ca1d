"""Quality report, exploration and drift run as sets of result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.operators import drift as D, profile as P, summaries as M
from zonepulse.functions.time import date_trunc, typed_time
from zonepulse.operators.demand import in_month
from zonepulse.operators.dims import known_category
from zonepulse.operators.explore import demand_profile
from zonepulse.operators.features import add_calendar, join_weather, join_zone
from zonepulse.operators.quantiles import exact_quantiles
from zonepulse.sources.readers import split_latest_period
from zonepulse.sources.sampling import sample_n
from zonepulse.sources.shared import written

FACT_NUMERIC = ("demand", "avg_trip_distance", "avg_total_amount")


def quality_report(fact: DataFrame, weather: DataFrame, year: int, month: int) -> dict[str, DataFrame]:
    """All tables of the monthly report, over the whole month rather than a sample."""
    rows = in_month(fact, "hour_ts", year, month).select(*FACT_NUMERIC, "pulocationid", "hour_ts")
    days = in_month(weather, "date", year, month)
    # One set of counting passes per table serves the quartiles and the outlier caps.
    wanted = (0.25, 0.5, 0.75, 0.995)
    of_rows = exact_quantiles(rows, FACT_NUMERIC, wanted, interpolate=True)
    of_days = exact_quantiles(days, S.WEATHER_COLUMNS, wanted, interpolate=True)
    report = {
        "fact_describe": P.describe(rows, FACT_NUMERIC, quartiles=of_rows),
        "fact_nulls": P.null_rates(rows),
        "top_zones": P.top_values(rows, "pulocationid"),
        "anomalies": P.anomaly_flags(rows),
        "weather_describe": P.describe(days, S.WEATHER_COLUMNS, quartiles=of_days),
    }
    for table, columns, quantiles in ((rows, FACT_NUMERIC, of_rows), (days, S.WEATHER_COLUMNS, of_days)):
        for c in columns:
            report[f"histogram_{c}"] = P.histogram(P.cap_outliers(table, c, quantiles=quantiles), c)
    return report


def explore(
    fact: DataFrame, zone: DataFrame, weather: DataFrame, n: int | None = None, seed: int = 42
) -> dict[str, DataFrame]:
    """Mean demand by hour, weekday and borough over the whole fact, or over a sample of ``n`` rows."""
    base = fact.filter(F.col("pulocationid").isNotNull()).select("pulocationid", "hour_ts", "demand")
    rows = base if n is None else sample_n(base, n, seed)
    joined = rows.transform(add_calendar).transform(join_zone, zone).transform(join_weather, weather)
    known = known_category(joined, "borough")
    return {"rows": known, "profile": demand_profile(known, ["hour", "day_of_week", "borough"])}


def drift_report(
    features: DataFrame,
    month: str,
    model=None,
    at: str | None = None,
    ts: str = "hour_ts",
    label: str = "target_demand",
    baseline: float = S.BASELINE_RMSE,
    execution_date: str | None = None,
    exact: bool = False,
) -> dict[str, DataFrame]:
    """Summary row, feature rows, coverage, label and (with predictions) model frames of one run; ``month`` is ``YYYY-MM``.

    The frame is read once, for one summary row per side, which is written; all results come from those two rows.
    Without a model the model part of the summary stays null, unless the frame already holds ``prediction``. A
    ``model`` reads the live rows once more, and ``exact`` both sides for the label's percentiles.
    """
    usable, missing = S.usable_features(features, features, S.MONITORED_FEATURES)
    reference, live = split_latest_period(features, ts, at=at)
    if at is not None:
        start = typed_time(features, ts, at)
    else:
        start = features.agg(date_trunc("month", F.max(ts)).cast(features.schema[ts].dataType)).scalar()
    timed = features.filter(F.col(ts).isNotNull())
    sides = written(M.summarise(timed, {"live": F.col(ts) >= start}, usable, label), "sides")
    label_row = D.label_drift(reference, live, label, True) if exact else None
    errors = None
    if model is not None:
        errors = D.regression_error(model.transform(live), label, "prediction")
    elif "prediction" in features.columns:
        errors = M.errors_of(sides)
    return _report(sides, month, label, missing, baseline, execution_date, errors, label_row)


def drift_from_summaries(
    summaries: DataFrame, month: str, label: str = "target_demand", baseline: float = S.BASELINE_RMSE, execution_date: str | None = None
) -> dict[str, DataFrame]:
    """The frames of ``drift_report`` from kept month summaries (``data_month``): ``month`` against all months before it."""
    first = F.lit(f"{month}-01").cast("date")
    wanted = summaries.filter(F.col("data_month") <= first)
    sides = written(M.merge(wanted, {"live": F.col("data_month") == first}), "sides")
    predicted = sides.filter("live").select(F.coalesce(F.max("errors.n"), F.lit(0))).first()[0] > 0
    held = {r[0] for r in sides.select(F.inline("features")).select("feature").distinct().collect()}
    missing = [f for f in S.MONITORED_FEATURES if f not in held and f not in S.DRIFT_EXCLUDED]
    return _report(sides, month, label, missing, baseline, execution_date, M.errors_of(sides) if predicted else None)


def _report(
    sides: DataFrame, month: str, label: str, missing, baseline: float, execution_date: str | None, errors: DataFrame | None, label_row: DataFrame | None = None
) -> dict[str, DataFrame]:
    data_month = F.lit(f"{month}-01").cast("date")
    stats = M.feature_drift_of(sides)
    label_row = M.label_drift_of(sides, label) if label_row is None else label_row
    parts = [
        D.drift_rollup(stats),
        label_row.select(
            F.col("drift_score").alias("label_drift_score"), F.col("severity").alias("label_severity"), F.col("should_alert").alias("label_should_alert")
        ),
    ]
    out = {}
    if errors is not None:
        out["model"] = D.model_drift_of(errors, baseline)
        parts.append(
            out["model"].select(
                F.col("rmse_ratio").alias("model_rmse_ratio"), F.col("severity").alias("model_severity"), F.col("should_alert").alias("model_should_alert")
            )
        )
    row = D._one_row(*parts)
    if errors is None:
        row = row.select(
            "*", F.lit(None).cast("double").alias("model_rmse_ratio"), F.lit(None).cast("string").alias("model_severity"), F.lit(False).alias("model_should_alert")
        )
    summary = row.withColumns(
        {
            "data_month": data_month,
            "execution_date": F.lit(execution_date).cast("date") if execution_date else F.add_months(data_month, 2),
            "overall_status": D.overall_status(),
            "training_triggered": F.lit(False),
        }
    ).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in S.DRIFT_SUMMARY.fields])
    rows = stats.withColumn("data_month", data_month).select(*S.DRIFT_FEATURES.names)
    return {"summary": summary, "features": rows, "coverage": M.coverage_of(sides, missing), "label": label_row, **out}

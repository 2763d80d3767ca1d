"""Jobs that keep their results: the feature table by month, and drift runs with their trigger flag."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse import schemas as S
from zonepulse.functions.time import date_trunc
from zonepulse.operators.demand import in_window
from zonepulse.operators.lags import history_means, history_sums, latest_rows
from zonepulse.operators.summaries import summarise
from zonepulse.plans.features import build_features
from zonepulse.plans.reports import drift_from_summaries
from zonepulse.sources import versions as V
from zonepulse.sources.replace import replace_children, set_where, upsert

HISTORY, SUMMARIES = "hour_dow_sums", "feature_summaries"
FEATURES, STATE, SUMMARY, DRIFT_ROWS = "pickup_features", "last_rows", "drift_run_summary", "drift_feature_stats"
#: A state table is one folder, rewritten as a whole; it holds at most a few rows per zone.
STATE_TIME = "as_of"


def store_features(spark: SparkSession, root: str, fact: DataFrame, zone: DataFrame, weather: DataFrame, start: str, end: str) -> V.Version:
    """Features of ``[start, end]`` replace those of the window; the last rows of every zone are kept for the next run.

    The run reads the window's facts alone: what its lags look back to comes from the rows the run before has kept, however
    long ago they were. Both tables are published together. Windows must come in order; a rerun of the latest window
    starts from the same kept rows and so changes nothing.
    """
    old = V.current(spark, root)
    kept = V.read_version(spark, root, STATE, S.LAST_ROWS, old)
    before = kept.filter(F.col(STATE_TIME) < F.lit(start).cast("date"))
    latest = before.agg(F.max(STATE_TIME)).first()[0]
    carried = before.filter(F.col(STATE_TIME).eqNullSafe(F.lit(latest)))
    rows = build_features(fact, zone, weather, start, end, carried=carried)
    day = F.lit(end).cast("date").alias(STATE_TIME)
    window = in_window(fact, "hour_ts", start, end).filter(F.col("pulocationid").isNotNull())
    now = latest_rows(carried.drop(STATE_TIME).unionByName(window.select("hour_ts", "pulocationid", "demand")), "pulocationid", "hour_ts")
    state = carried.unionByName(now.select("hour_ts", "pulocationid", "demand", day))
    after = spark.range(1).select(F.date_add(F.lit(end).cast("date"), 1)).first()[0]
    changes = {FEATURES: V.staged_replacement(rows, root, FEATURES, "hour_ts", start, after, old)}
    # The state before this window stays beside the new one, so that the window can be run again; older ones go.
    changes[STATE] = {m: None for m in old.folders.get(STATE, {})} | V.stage(state, root, STATE, STATE_TIME)
    return V.publish(spark, root, old, changes)


def store_history(spark: SparkSession, root: str, fact: DataFrame, zone: str = "pulocationid", ts: str = "hour_ts") -> V.Version:
    """Sums of the months in ``fact``, which must hold them whole, in place of what was kept of them; other months stay."""
    old = V.current(spark, root)
    known = fact.filter(F.col(ts).isNotNull())
    return V.publish(spark, root, old, {HISTORY: V.stage(history_sums(known, zone, ts), root, HISTORY, "data_month")})


def read_history(spark: SparkSession, root: str, zone: str = "pulocationid", first: str | None = None, last: str | None = None) -> DataFrame:
    """Mean demand by zone, hour and weekday over the kept months (``first`` to ``last``)."""
    return history_means(V.read_version(spark, root, HISTORY, S.HISTORY_SUMS, first=first, last=last), zone)


def store_drift_run(spark: SparkSession, root: str, report: dict[str, DataFrame]) -> V.Version:
    """Summary and feature rows of one run, published together.

    A month that is stored already takes the new values but keeps its trigger flag; its feature rows are replaced.
    """
    old = V.current(spark, root)
    summary = report["summary"].persist()
    try:
        month = summary.select(F.date_format("data_month", "yyyy-MM")).first()[0]
        held = V.read_version(spark, root, SUMMARY, S.DRIFT_SUMMARY, old, month, month)
        columns = [c for c in S.DRIFT_SUMMARY.names if c not in ("data_month", "training_triggered")]
        merged = upsert(held, summary, ["data_month"], columns).select(*S.DRIFT_SUMMARY.names)
        rows = V.read_version(spark, root, DRIFT_ROWS, S.DRIFT_FEATURES, old, month, month)
        children = replace_children(rows, report["features"].select(*S.DRIFT_FEATURES.names), "data_month")
        changes = {t: {month: None} | V.stage(df, root, t, "data_month") for t, df in ((SUMMARY, merged), (DRIFT_ROWS, children))}
        return V.publish(spark, root, old, changes)
    finally:
        summary.unpersist()


def mark_triggered(spark: SparkSession, root: str, month: str, value: bool = True) -> V.Version:
    """Set the trigger flag of one stored month (``YYYY-MM``); a month that is not stored is left alone."""
    old = V.current(spark, root)
    held = V.read_version(spark, root, SUMMARY, S.DRIFT_SUMMARY, old, month, month)
    if month not in old.folders.get(SUMMARY, {}):
        return old
    changed = set_where(held, "data_month", f"{month}-01", "training_triggered", value)
    return V.publish(spark, root, old, {SUMMARY: V.stage(changed, root, SUMMARY, "data_month")})


def store_summaries(spark: SparkSession, root: str, features: DataFrame, ts: str = "hour_ts", label: str = "target_demand") -> V.Version:
    """Summaries of the months in ``features``, which must hold them whole, in place of what was kept of them."""
    usable, _ = S.usable_features(features, features, S.MONITORED_FEATURES)
    timed = features.filter(F.col(ts).isNotNull())
    rows = summarise(timed, {"data_month": date_trunc("month", ts).cast("date")}, usable, label)
    return V.publish(spark, root, V.current(spark, root), {SUMMARIES: V.stage(rows, root, SUMMARIES, "data_month")})


def drift_of_month(spark: SparkSession, root: str, month: str, **options) -> dict[str, DataFrame]:
    """The drift run of a month from kept summaries; no feature row is read."""
    return drift_from_summaries(V.read_version(spark, root, SUMMARIES, S.FEATURE_SUMMARY, last=month), month, **options)


def read_drift(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Summary and feature rows of all stored runs, of one version."""
    version = V.current(spark, root)
    return V.read_version(spark, root, SUMMARY, S.DRIFT_SUMMARY, version), V.read_version(spark, root, DRIFT_ROWS, S.DRIFT_FEATURES, version)

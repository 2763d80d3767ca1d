"""Jobs that keep tables by month: each is run as a user would, over whole tables, and the stored rows are compared."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.analysis_checks import FEATURE_SQL
from checks.io_checks import NEW_ROWS, _target_new
from checks.model_checks import FEATURE_DRIFT, _as_compared, _means_sql
from checks.registry import check
from zonepulse import schemas as S
from zonepulse.plans import stored
from zonepulse.sources import versions as V
from zonepulse.sources.shared import scratch_path


def _root(spark, df, ts):
    """A new root with ``df`` as its table ``t``."""
    root = scratch_path(spark, "versions")
    V.publish(spark, root, V.current(spark, root), {"t": V.stage(df, root, "t", ts)})
    return root


@check(
    "K4_stored_observed_range",
    f"""WITH fresh AS ({NEW_ROWS})
       SELECT o_orderkey, hour_ts, target_demand FROM x3
       WHERE hour_ts < (SELECT min(hour_ts) FROM fresh) OR hour_ts > (SELECT max(hour_ts) FROM fresh)
       UNION ALL SELECT * FROM fresh""",
)
def _(spark, sf):
    target, new = _target_new(spark, sf)
    root = _root(spark, target, "hour_ts")
    V.replace_observed(new, root, "t", "hour_ts")
    return V.read_version(spark, root, "t", target.schema)


@check(
    "K5_stored_month",
    """SELECT date, borough, CASE WHEN date >= DATE '2024-01-01' AND date < DATE '2024-02-01' THEN temperature_mean + 1
         ELSE temperature_mean END AS temperature_mean FROM x5""",
)
def _(spark, sf):
    rows = X.x5(spark, sf).select("date", "borough", "temperature_mean")
    root = _root(spark, rows, "date")
    new = rows.filter("date >= '2024-01-01' AND date < '2024-02-01'").withColumn("temperature_mean", F.col("temperature_mean") + 1)
    V.replace_one_month(new, root, "t", "date", 2024, 1)
    return V.read_version(spark, root, "t", rows.schema)


@check(
    "K7_stored_window",
    f"""WITH fresh AS ({NEW_ROWS})
       SELECT o_orderkey, hour_ts, target_demand FROM x3
       WHERE hour_ts < TIMESTAMP '2000-01-05' OR hour_ts >= TIMESTAMP '2000-07-01'
       UNION ALL SELECT * FROM fresh""",
)
def _(spark, sf):
    target, new = _target_new(spark, sf)
    root = _root(spark, target, "hour_ts")
    V.replace_days(new, root, "t", "hour_ts", "2000-01-05", "2000-06-30")
    return V.read_version(spark, root, "t", target.schema)


@check(
    "K8_stored_drift_run",
    """SELECT r.data_month, r.feature, round(CASE WHEN r.data_month = DATE '1999-05-01' THEN r.drift_score + 1 ELSE r.drift_score END, 6) AS drift_score,
         CASE WHEN r.data_month = DATE '1999-05-01' THEN s.overall_status || '!' ELSE s.overall_status END AS overall_status,
         r.data_month = DATE '1999-05-01' AS training_triggered
       FROM drift_rows r JOIN drift_summary s ON s.data_month = r.data_month""",
)
def _(spark, sf):
    summary = X.drift_summary(spark, sf).withColumn("training_triggered", F.lit(False))
    summary = summary.select(*[F.col(f.name).cast(f.dataType) if f.name in summary.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.DRIFT_SUMMARY.fields])
    rows = X.drift_rows(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in S.DRIFT_FEATURES.fields])
    root = scratch_path(spark, "drift")
    first = {t: V.stage(df, root, t, "data_month") for t, df in ((stored.SUMMARY, summary), (stored.DRIFT_ROWS, rows))}
    V.publish(spark, root, V.current(spark, root), first)
    stored.mark_triggered(spark, root, "1999-05")
    of_may = F.col("data_month") == "1999-05-01"
    again = {
        "summary": summary.filter(of_may).withColumn("overall_status", F.concat("overall_status", F.lit("!"))),
        "features": rows.filter(of_may).withColumn("drift_score", F.col("drift_score") + 1),
    }
    stored.store_drift_run(spark, root, again)
    runs, features = stored.read_drift(spark, root)
    joined = features.join(runs, "data_month").select("data_month", "feature", "drift_score", "overall_status", "training_triggered")
    return X.rounded(joined, 6, ("drift_score",))


@check("M1_stored_features", f"SELECT {FEATURE_SQL} FROM features")
def _(spark, sf):
    root = scratch_path(spark, "features")
    for start, end in (("2024-01-01", "2024-01-10"), ("2024-01-11", "2024-01-20"), ("2024-01-21", "2024-12-31")):
        stored.store_features(spark, root, X.fact(spark, sf), X.x4(spark, sf), X.x5(spark, sf), start, end)
    return X.rounded(V.read_version(spark, root, stored.FEATURES, S.FEATURE_TABLE))


@check("A24_stored_history", "SELECT pulocationid, h AS hour_of_day, d AS day_of_week, round(avg_demand, 6) AS avg_demand FROM history")
def _(spark, sf):
    root, fact = scratch_path(spark, "history"), X.fact(spark, sf)
    stored.store_history(spark, root, fact)
    return X.rounded(stored.read_history(spark, root))


JULY_ALONE = f"""m AS ({_means_sql("hour_ts < TIMESTAMP '2001-07-01'", "hour_ts >= TIMESTAMP '2001-07-01' AND hour_ts < TIMESTAMP '2001-08-01'")}),
  d AS (SELECT *, CASE WHEN r = 0 AND c = 0 THEN 0.0 WHEN r = 0 THEN 1.0 ELSE least(abs(c - r) / abs(r), 1.0) END AS s FROM m)"""


@check("M17_drift_from_summaries", f"WITH {JULY_ALONE} {FEATURE_DRIFT}")
def _(spark, sf):
    root = scratch_path(spark, "summaries")
    stored.store_summaries(spark, root, X.drift_features(spark, sf))
    return _as_compared(stored.drift_of_month(spark, root, "2001-07")["features"])

"""Drift, models, scoring, geometry (the rest of A, C, J, M, O, W)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from checks import fixtures as X
from checks.analysis_checks import ACTUAL, SERVED, WITH_HISTORY
from checks.registry import check
from zonepulse import schemas as S
from zonepulse.functions import geometry as G
from zonepulse.operators import drift as D, model as M, nearest as N, ranking as K, ridge as R, scoring as Z, shapes as H
from zonepulse.plans import serving
from zonepulse.plans.reports import drift_report
from zonepulse.sources.readers import load_model
from zonepulse.sources.shared import scratch_path
from zonepulse.sources.writers import export_drift, save_model

# --- drift ---------------------------------------------------------------

HALVES = "hour_ts < TIMESTAMP '2001-07-01'", "hour_ts >= TIMESTAMP '2001-07-01'"
DRIFT_COLUMNS = {
    "target_demand": ("target_demand", "numeric_mean_shift"),
    "day_of_week": ("isodow(hour_ts) - 1", "numeric_mean_shift"),
    "is_weekend": ("CAST(isodow(hour_ts) >= 6 AS INTEGER)", "numeric_mean_shift"),
    "borough_manhattan": ("is_urgent", "categorical_proportion_shift"),
    "borough_brooklyn": ("status_p", "categorical_proportion_shift"),
}


def _means_sql(ref: str, live: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS feature, '{kind}' AS feature_type, (SELECT avg({expr}) FROM x3 WHERE {ref}) AS r, (SELECT avg({expr}) FROM x3 WHERE {live}) AS c"
        for name, (expr, kind) in DRIFT_COLUMNS.items()
    )


BAND = """CASE WHEN {s} >= 0.8 THEN 'Critical' WHEN {s} >= 0.55 THEN 'High' WHEN {s} >= 0.3 THEN 'Medium' ELSE 'Healthy' END"""
JULY = f"""m AS ({_means_sql(*HALVES)}), d AS (SELECT *, CASE WHEN r = 0 AND c = 0 THEN 0.0 WHEN r = 0 THEN 1.0
  ELSE least(abs(c - r) / abs(r), 1.0) END AS s FROM m)"""
FEATURE_DRIFT = f"""SELECT feature, feature_type, round(r, 6) AS reference_value, round(c, 6) AS current_value, round(s, 6) AS drift_score,
  {BAND.format(s='s')} AS severity FROM d"""


def _july(spark, sf):
    rows = X.drift_features(spark, sf)
    return rows.filter("hour_ts < '2001-07-01'"), rows.filter("hour_ts >= '2001-07-01'")


def _as_compared(df):
    return df.select(
        "feature",
        "feature_type",
        F.round("reference_value", 6).alias("reference_value"),
        F.round("current_value", 6).alias("current_value"),
        F.round("drift_score", 6).alias("drift_score"),
        "severity",
    )


@check("K11_export_drift", f"WITH {JULY} SELECT DATE '2001-07-01' AS data_month, * FROM ({FEATURE_DRIFT})")
def _(spark, sf):
    path = scratch_path(spark, "drift")
    export_drift(drift_report(X.drift_features(spark, sf), "2001-07", at="2001-07-01"), path)
    stats = spark.read.schema(S.DRIFT_FEATURES).csv(f"{path}/features", header=True)
    return _as_compared(stats).withColumn("data_month", F.lit("2001-07-01").cast("date"))


@check("M11_feature_drift", f"WITH {JULY} {FEATURE_DRIFT}")
def _(spark, sf):
    return _as_compared(D.feature_drift(*_july(spark, sf)))


LABEL = f"""l AS (SELECT (SELECT avg(target_demand) FROM x3 WHERE {HALVES[0]}) AS rm, (SELECT avg(target_demand) FROM x3 WHERE {HALVES[1]}) AS lm,
    (SELECT stddev(target_demand) FROM x3 WHERE {HALVES[0]}) AS rs, (SELECT stddev(target_demand) FROM x3 WHERE {HALVES[1]}) AS ls,
    (SELECT quantile_disc(target_demand, [0.5, 0.9]) FROM x3 WHERE {HALVES[0]}) AS rq,
    (SELECT quantile_disc(target_demand, [0.5, 0.9]) FROM x3 WHERE {HALVES[1]}) AS lq),
  ld AS (SELECT *, least(abs(lm - rm) / abs(rm), 1.0) AS s FROM l)"""


@check(
    "M12_label_drift",
    f"""WITH {LABEL} SELECT 'target_demand' AS label, round(rm, 6) AS reference_mean, round(rs, 6) AS reference_std, rq[1] AS reference_p50,
          rq[2] AS reference_p90, round(lm, 6) AS live_mean, round(ls, 6) AS live_std, lq[1] AS live_p50, lq[2] AS live_p90,
          round(s, 6) AS drift_score, {BAND.format(s='s')} AS severity, s >= 0.3 AS should_alert FROM ld""",
)
def _(spark, sf):
    row = D.label_drift(*_july(spark, sf), exact=True)
    return X.rounded(row, 6, ("reference_mean", "reference_std", "live_mean", "live_std", "drift_score"))


@check(
    "M13_model_drift",
    """WITH e AS (SELECT sqrt(avg(pow(prediction - label, 2))) AS rmse, avg(abs(prediction - label)) AS mae,
         avg(2 * abs(prediction - label) / (abs(label) + abs(prediction) + 1e-8)) AS smape FROM preds),
       q AS (SELECT *, (rmse - 1.0) / 1.0 AS ratio FROM e)
       SELECT 1.0::DOUBLE AS baseline_rmse, round(rmse, 6) AS live_rmse, round(mae, 6) AS live_mae, round(smape, 6) AS live_smape,
         round(ratio, 6) AS rmse_ratio, CASE WHEN ratio >= 0.8 THEN 'Critical' WHEN ratio >= 0.55 THEN 'High' WHEN ratio >= 0.3 THEN 'Medium' ELSE 'Healthy' END AS severity,
         ratio >= 0.3 AS should_alert FROM q""",
)
def _(spark, sf):
    return X.rounded(D.model_drift(X.preds(spark, sf), baseline=1.0, label="label"))


@check(
    "M14_should_alert",
    """SELECT data_month, critical_count > 0 OR high_drift_count >= 2 OR label_should_alert OR model_should_alert AS alert FROM drift_summary""",
)
def _(spark, sf):
    return X.drift_summary(spark, sf).select("data_month", D.should_alert().alias("alert"))


@check("M15_overall_status", "SELECT data_month, overall_status AS status FROM drift_summary")
def _(spark, sf):
    return X.drift_summary(spark, sf).select("data_month", D.overall_status().alias("status"))


@check(
    "M16_retrain_trigger",
    """SELECT data_month, month(data_month) IN (1, 7) OR overall_status IN ('High', 'Critical') AS retrain FROM drift_summary""",
)
def _(spark, sf):
    return X.drift_summary(spark, sf).select("data_month", D.retrain_trigger().alias("retrain"))


@check(
    "M17_drift_report",
    f"""WITH {JULY}, {LABEL}, s AS (SELECT avg(s) AS a, count(*) FILTER (s >= 0.55) AS h, count(*) FILTER (s >= 0.8) AS c FROM d)
       SELECT DATE '2001-07-01' AS data_month, DATE '2001-09-01' AS execution_date, round(a, 6) AS avg_feature_drift, h AS high_drift_count,
         c AS critical_count, round(ld.s, 6) AS label_drift_score, {BAND.format(s='ld.s')} AS label_severity, ld.s >= 0.3 AS label_should_alert,
         CASE WHEN c > 0 THEN 'Critical' WHEN h >= 2 OR ld.s >= 0.3 THEN 'High' WHEN a >= 0.3 THEN 'Medium' ELSE 'Low' END AS overall_status,
         false AS model_should_alert, false AS training_triggered FROM s, ld""",
)
def _(spark, sf):
    report = drift_report(X.drift_features(spark, sf), "2001-07", at="2001-07-01", exact=True)
    return X.rounded(report["summary"].drop("model_rmse_ratio", "model_severity"))


@check(
    "M17_drift_report_features",
    f"WITH {JULY} SELECT DATE '2001-07-01' AS data_month, * FROM ({FEATURE_DRIFT})",
)
def _(spark, sf):
    rows = drift_report(X.drift_features(spark, sf), "2001-07", at="2001-07-01")["features"]
    return _as_compared(rows).withColumn("data_month", F.lit("2001-07-01").cast("date"))


@check(
    "A22_drift_rollup",
    """SELECT round(avg(drift_score), 6) AS avg_feature_drift, count(*) FILTER (drift_score >= 0.55) AS high_drift_count,
         count(*) FILTER (drift_score >= 0.8) AS critical_count FROM drift_rows""",
)
def _(spark, sf):
    return X.rounded(D.drift_rollup(X.drift_rows(spark, sf)))


@check(
    "A23_dashboard_rollup",
    """WITH q AS (SELECT count(*) AS n_features, avg(drift_score) AS avg_drift, count(*) FILTER (drift_score >= 0.8) AS critical_count,
         count(*) FILTER (drift_score >= 0.55) AS high_count, count(*) FILTER (drift_score < 0.3) AS healthy_count
         FROM drift_rows),
       w AS (SELECT *, CASE WHEN critical_count > 0 THEN 0.8 WHEN high_count > 0 THEN 0.55 ELSE avg_drift END AS worst FROM q)
       SELECT n_features, round(avg_drift, 6) AS avg_drift, critical_count, high_count, healthy_count, round(worst, 6) AS worst_score,
         CASE WHEN worst >= 0.8 THEN 'Critical' WHEN worst >= 0.55 THEN 'High' WHEN worst >= 0.3 THEN 'Medium' ELSE 'Healthy' END AS status FROM w""",
)
def _(spark, sf):
    return X.rounded(D.dashboard_rollup(X.drift_rows(spark, sf)))


@check(
    "J11_drift_for_month",
    """SELECT data_month, feature, drift_score, avg_feature_drift, overall_status FROM drift_rows JOIN drift_summary USING (data_month)
       WHERE data_month = (SELECT max(data_month) FROM drift_summary)""",
)
def _(spark, sf):
    rows = D.drift_for_month(X.drift_summary(spark, sf), X.drift_rows(spark, sf))
    return rows.select("data_month", "feature", "drift_score", "avg_feature_drift", "overall_status")


@check("J13_feature_group", """SELECT data_month, feature, drift_score, CASE feature WHEN 'day_of_week' THEN 'Time Buckets' ELSE 'Weather' END AS feature_group
       FROM drift_rows WHERE feature IN ('day_of_week', 'temperature_mean')""")
def _(spark, sf):
    rows = D.with_feature_group(X.drift_rows(spark, sf), D.feature_group_table(spark))
    return rows.select("data_month", "feature", "drift_score", "feature_group")


@check(
    "O2_top_drift",
    """SELECT feature, data_month, drift_score FROM (SELECT data_month || ' ' || feature AS feature, data_month, drift_score FROM drift_rows)
       ORDER BY drift_score DESC, feature LIMIT 10""",
)
def _(spark, sf):
    rows = X.drift_rows(spark, sf).withColumn(
        "feature", F.concat(F.col("data_month").cast("string"), F.lit(" "), F.col("feature"))
    )
    return D.top_drift(rows, 10).select("feature", "data_month", "drift_score")


@check("O3_latest_or_month", """SELECT 'latest' AS pick, data_month, overall_status FROM drift_summary WHERE data_month = (SELECT max(data_month) FROM drift_summary)
       UNION ALL SELECT 'given', data_month, overall_status FROM drift_summary WHERE data_month = DATE '1998-04-01'""")
def _(spark, sf):
    rows = X.drift_summary(spark, sf).select("data_month", "overall_status")
    return X.bag(
        D.latest_or_month(rows).select(F.lit("latest").alias("pick"), "*"),
        D.latest_or_month(rows, "1998-04").select(F.lit("given").alias("pick"), "*"),
    )


@check(
    "O9_top_groups",
    """SELECT data_month, feature, drift_score, 'Time Buckets' AS feature_group,
         row_number() OVER (ORDER BY drift_score DESC, feature, data_month) AS group_rank
       FROM (SELECT data_month, feature, drift_score FROM drift_rows WHERE feature = 'day_of_week')""",
)
def _(spark, sf):
    # Every month's row of a feature counts as one entry of its group.
    rows = X.drift_rows(spark, sf)
    groups = D.feature_group_table(spark)
    shown = D.with_feature_group(rows, groups).filter(F.col("group_order") < 2)
    return K.rank_by(
        shown.withColumn("tie", F.concat("feature", F.col("data_month").cast("string"))), "drift_score", "tie", ["feature_group"], "group_rank"
    ).select("data_month", "feature", "drift_score", "feature_group", "group_rank")


@check(
    "O9_top_groups_of_month",
    """SELECT 'Time Buckets' AS feature_group, feature, drift_score, 1 AS group_rank FROM drift_rows
       WHERE feature = 'day_of_week' AND data_month = (SELECT max(data_month) FROM drift_rows)""",
)
def _(spark, sf):
    rows = X.drift_rows(spark, sf)
    latest = rows.agg(F.max("data_month")).scalar()
    out = D.top_groups(rows.filter(F.col("data_month") == latest), D.feature_group_table(spark))
    return out.select("feature_group", "feature", "drift_score", F.col("group_rank").cast("long").alias("group_rank"))


@check(
    "O1_drift_history",
    "SELECT data_month, overall_status, avg_feature_drift, high_drift_count, critical_count, training_triggered FROM drift_summary",
)
def _(spark, sf):
    return D.drift_history(X.drift_summary(spark, sf))


# --- predictions ---------------------------------------------------------


@check(
    "A18_regression_error",
    "SELECT round(sqrt(avg(pow(prediction - label, 2))), 6) AS rmse, round(avg(abs(prediction - label)), 6) AS mae FROM preds",
)
def _(spark, sf):
    return X.rounded(D.regression_error(X.preds(spark, sf))).drop("smape")


@check(
    "A19_smape",
    "SELECT pulocationid, round(avg(2 * abs(prediction - label) / (abs(label) + abs(prediction) + 1e-8)), 6) AS smape FROM preds GROUP BY 1",
)
def _(spark, sf):
    from zonepulse.functions.score import smape

    return X.preds(spark, sf).groupBy("pulocationid").agg(F.round(smape("label", "prediction"), 6).alias("smape"))


@check(
    "A12_time_cutoffs",
    "SELECT quantile_disc(CAST(epoch(o_orderdate) AS BIGINT), 0.70) AS q70, quantile_disc(CAST(epoch(o_orderdate) AS BIGINT), 0.85) AS q85, count(*) AS n FROM orders",
)
def _(spark, sf):
    rows = X.table(spark, sf, "orders")
    q70, q85 = M.time_cutoffs(rows, "o_orderdate", err=0)
    return rows.agg(F.count("*").alias("n")).select(F.lit(q70).cast("long").alias("q70"), F.lit(q85).cast("long").alias("q85"), "n")


@check(
    "M2_time_split",
    """WITH c AS (SELECT quantile_disc(o_orderdate, 0.70) AS a, quantile_disc(o_orderdate, 0.85) AS b FROM orders)
       SELECT o_orderkey, CASE WHEN o_orderdate <= a THEN 'train' WHEN o_orderdate <= b THEN 'val' ELSE 'test' END AS part FROM orders, c""",
)
def _(spark, sf):
    rows = X.table(spark, sf, "orders")
    parts = M.time_split(rows, "o_orderdate", *M.time_cutoffs(rows, "o_orderdate", err=0))
    return X.bag(*[p.select("o_orderkey", F.lit(n).alias("part")) for p, n in zip(parts, ("train", "val", "test"))])


@check("M3_assemble", "SELECT pulocationid, hour_ts, 31 AS slots, CAST(pulocationid AS DOUBLE) AS first FROM features")
def _(spark, sf):
    out = M.assembler().transform(X.features(spark, sf))
    values = vector_to_array("features")
    return out.select("pulocationid", "hour_ts", F.size(values).alias("slots"), F.get(values, F.lit(0)).alias("first"))


def _fitted(spark, sf, estimator):
    """Fit on the whole feature table: every row predicted, error below that of the mean."""
    rows = X.features(spark, sf)
    preds = M.fit_pipeline(rows, estimator).transform(rows)
    error = F.sqrt(F.avg(F.pow(F.col("prediction") - F.col("target_demand"), 2)))
    return preds.agg(
        F.count("*").alias("n"),
        F.count("prediction").alias("n_predicted"),
        (error < F.stddev_pop("target_demand")).alias("beats_mean"),
    )


FITTED = "SELECT count(*) AS n, count(*) AS n_predicted, true AS beats_mean FROM features"


def ridge_sql(rows: str, features, label: str, penalty: float, name: str) -> str:
    """CTEs that solve the normal equations of a ridge fit on ``rows``, one elimination step each; ``name`` has b0 (intercept), b1 ..."""
    d = len(features)
    cols = [f"covar_pop({features[i]}, {features[j]})" + (f" + var_pop({features[i]}) * {penalty} / stddev_pop({label})" if i == j else "") + f" AS a{i}_{j}" for i in range(d) for j in range(d)]
    cols += [f"covar_pop({f}, {label}) AS r{i}" for i, f in enumerate(features)] + [f"avg({f}) AS m{i}" for i, f in enumerate(features)] + [f"avg({label}) AS my"]
    steps = [f"{name}_0 AS (SELECT {', '.join(cols)} FROM {rows})"]
    for p in range(d):
        row = lambda i, x, p=p: x if i == p else f"{x} - a{i}_{p} / a{p}_{p} * {x.replace(f'a{i}_', f'a{p}_').replace(f'r{i}', f'r{p}')}"
        made = [f"{row(i, f'a{i}_{j}')} AS a{i}_{j}" for i in range(d) for j in range(d)] + [f"{row(i, f'r{i}')} AS r{i}" for i in range(d)]
        steps.append(f"{name}_{p + 1} AS (SELECT {', '.join([*made, *(f'm{i}' for i in range(d)), 'my'])} FROM {name}_{p})")
    weights = [f"r{i} / a{i}_{i} AS b{i + 1}" for i in range(d)]
    free = " - ".join(["my", *(f"r{i} / a{i}_{i} * m{i}" for i in range(d))])
    steps.append(f"{name} AS (SELECT {', '.join([*weights, f'{free} AS b0'])} FROM {name}_{d})")
    return ", ".join(steps)


LAGS = list(S.LAG_COLUMNS)
LAG_FIT = "{n}.b0 + " + " + ".join(f"{{n}}.b{i + 1} * {c}" for i, c in enumerate(LAGS))


@check(
    "M4_linear_regression",
    f"""WITH {ridge_sql("features", LAGS, "target_demand", 0.1, "fit")},
       w AS (SELECT unnest({[*LAGS, 'intercept']}) AS feature, unnest([{', '.join(f'b{i + 1}' for i in range(len(LAGS)))}, b0]) AS weight FROM fit)
       SELECT m AS method, feature, round(weight, 6) + 0.0 AS weight FROM w, (SELECT unnest(['iterated', 'normal equations']) AS m)""",
)
def _(spark, sf):
    """The candidate's weights, and those of the one-pass fit."""
    rows = X.features(spark, sf)
    model = M.fit_pipeline(rows, M.linear_regression(), LAGS).stages[-1]
    found = [("iterated", f, float(w)) for f, w in zip([*LAGS, "intercept"], [*model.coefficients, model.intercept], strict=True)]
    found += [("normal equations", f, w) for f, w in R.ridge(rows, LAGS, "target_demand", 0.1).items()]
    return X.rounded(spark.createDataFrame(found, "method string, feature string, weight double"))


@check("M5_random_forest", FITTED)
def _(spark, sf):
    return _fitted(spark, sf, M.random_forest())


@check("M6_gbt", FITTED)
def _(spark, sf):
    return _fitted(spark, sf, M.gbt())


CUTS = """cuts AS (SELECT quantile_disc(epoch(hour_ts), 0.70) AS c1, quantile_disc(epoch(hour_ts), 0.85) AS c2 FROM features),
  train AS (SELECT f.* FROM features f, cuts WHERE epoch(hour_ts) <= c1),
  held AS (SELECT f.*, CASE WHEN epoch(hour_ts) <= c2 THEN 'val' ELSE 'test' END AS part FROM features f, cuts WHERE epoch(hour_ts) > c1)"""
MEASURED = """(SELECT {c} FROM e WHERE e.model = x.model AND part = '{p}')"""


def _weak_and_strong():
    return {f"penalty_{p}": M.linear_regression().setRegParam(p) for p in (0.1, 50.0)}


@check(
    "M7_compare_models",
    f"""WITH {CUTS}, {ridge_sql("train", LAGS, "target_demand", 0.1, "weak")}, {ridge_sql("train", LAGS, "target_demand", 50.0, "strong")},
       p AS (SELECT 'penalty_0.1' AS model, part, target_demand AS y, {LAG_FIT.format(n='weak')} AS p FROM held, weak
         UNION ALL SELECT 'penalty_50.0', part, target_demand, {LAG_FIT.format(n='strong')} FROM held, strong),
       e AS (SELECT model, part, round(sqrt(avg(pow(p - y, 2))), 6) AS rmse, round(avg(abs(p - y)), 6) AS mae, round(avg(2 * abs(p - y) / (abs(y) + abs(p) + 1e-8)), 6) AS smape
         FROM p GROUP BY ALL)
       SELECT model, {', '.join(MEASURED.format(c=c, p=p) + f' AS {p}_{c}' for p in ('val', 'test') for c in ('rmse', 'mae', 'smape'))}
       FROM (SELECT DISTINCT model FROM e) x""",
)
def _(spark, sf):
    rows = X.features(spark, sf).select("hour_ts", "target_demand", *LAGS)
    return X.rounded(serving.train(rows, err=0, estimators=_weak_and_strong())[0])


@check("M7_compare_tree_models")
def _(spark, sf):
    return serving.train(X.features(spark, sf))[0]


CANDIDATES = """cand AS (SELECT 'model_' || pulocationid AS model, sqrt(avg(pow(prediction - label, 2))) AS val_rmse, avg(abs(prediction - label)) AS val_mae,
    avg(2 * abs(prediction - label) / (abs(label) + abs(prediction) + 1e-8)) AS val_smape FROM preds GROUP BY pulocationid)"""


def _candidates(spark, sf):
    """Each zone's persistence forecast stands for one candidate model."""
    preds = X.preds(spark, sf)
    from zonepulse.functions.score import smape

    gap = F.col("prediction") - F.col("label")
    return preds.groupBy(F.concat(F.lit("model_"), "pulocationid").alias("model")).agg(
        F.sqrt(F.avg(gap * gap)).alias("val_rmse"), F.avg(F.abs(gap)).alias("val_mae"), smape("label", "prediction").alias("val_smape")
    )


@check(
    "M8_select_model",
    f"""WITH {CANDIDATES}, r AS (SELECT *, row_number() OVER (ORDER BY val_rmse, model) AS n FROM cand)
       SELECT CASE WHEN b.val_rmse - a.val_rmse < 1.0 AND b.val_smape < a.val_smape THEN b.model ELSE a.model END AS model,
         round(CASE WHEN b.val_rmse - a.val_rmse < 1.0 AND b.val_smape < a.val_smape THEN b.val_rmse ELSE a.val_rmse END, 6) AS val_rmse
       FROM (SELECT * FROM r WHERE n = 1) a, (SELECT * FROM r WHERE n = 2) b""",
)
def _(spark, sf):
    return X.rounded(M.select_model(_candidates(spark, sf)).select("model", "val_rmse"))


@check(
    "M9_save_model",
    f"""WITH {CUTS}, {ridge_sql("train", LAGS, "target_demand", 0.1, "fit")}
       SELECT pulocationid, hour_ts, 'linear_regression' AS model, round({LAG_FIT.format(n='fit')}, 6) + 0.0 AS prediction FROM features, fit""",
)
def _(spark, sf):
    rows = X.features(spark, sf)
    one = {"linear_regression": M.linear_regression()}
    _, name, model = serving.train(rows.select("hour_ts", "target_demand", *LAGS), err=0, estimators=one)
    path = scratch_path(spark, "model")
    save_model(model, path)
    preds = load_model(path).transform(rows).select("pulocationid", "hour_ts", F.lit(name).alias("model"), "prediction")
    return X.rounded(preds)


@check(
    "M10_promotion",
    f"""WITH {CANDIDATES}, p AS (SELECT * FROM cand WHERE model IN (SELECT model FROM cand ORDER BY model LIMIT 3) ORDER BY val_rmse, val_mae, val_smape LIMIT 1),
       c AS (SELECT * FROM cand UNION ALL SELECT 'unknown', NULL, NULL, NULL UNION ALL SELECT 'half', p.val_rmse, NULL, p.val_smape FROM p)
       SELECT c.model, coalesce(c.val_rmse <= p.val_rmse * 1.01 AND c.val_mae <= p.val_mae * 1.05 AND c.val_smape <= p.val_smape * 1.05, false) AS approved,
         false AS first_model FROM c, p""",
)
def _(spark, sf):
    """Several rows in production, and candidates without some or all metrics."""
    rows = _candidates(spark, sf)
    current = rows.orderBy("model").limit(3)
    best = current.orderBy("val_rmse", "val_mae", "val_smape").limit(1)
    none = F.lit(None).cast("double")
    unknown = best.select(F.lit("unknown").alias("model"), none.alias("val_rmse"), none.alias("val_mae"), none.alias("val_smape"))
    half = best.select(F.lit("half").alias("model"), "val_rmse", none.alias("val_mae"), "val_smape")
    return M.promotion(rows.unionAll(unknown).unionAll(half), current).select("model", "approved", "first_model")


@check("W4_rank_by", "SELECT hour_ts, pulocationid, score, row_number() OVER (PARTITION BY hour_ts ORDER BY score DESC, pulocationid) AS rank FROM scored_preds")
def _(spark, sf):
    ranked = K.rank_by(X.scored_preds(spark, sf), "score", "pulocationid", ["hour_ts"])
    return X.rounded(ranked.select("hour_ts", "pulocationid", "score", "rank"))


@check("W4_rank_whole_table", "SELECT event_id, value, row_number() OVER (ORDER BY value DESC, event_id) AS rank FROM events")
def _(spark, sf):
    return K.rank_by(X.table(spark, sf, "events").select("event_id", "value"), "value", "event_id")


@check(
    "W5_rank_within",
    "SELECT o_orderkey, o_orderpriority, o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, o_orderkey) AS rank FROM orders",
)
def _(spark, sf):
    rows = X.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_custkey", "o_totalprice")
    return X.rounded(K.rank_within(rows, ["o_custkey"], "o_totalprice", "o_orderkey").drop("o_totalprice"))


@check(
    "O4_top_zones",
    """SELECT hour_ts, pulocationid, score FROM scored_preds
       QUALIFY row_number() OVER (PARTITION BY hour_ts ORDER BY score DESC, pulocationid) <= 5""",
)
def _(spark, sf):
    return Z.top_zones(X.scored_preds(spark, sf), 5, ["hour_ts"]).select("hour_ts", "pulocationid", "score")


@check(
    "O6_recent_runs",
    """WITH r AS (SELECT hour_ts AS run_ts, count(*) AS included_count, count(*) FILTER (pulocationid % 2 = 0) AS selected_count,
         arg_min(pulocationid, (-score, pulocationid)) AS z, max(score) AS top_score FROM scored_preds GROUP BY 1)
       SELECT run_ts, included_count, selected_count, top_score, z.zone AS zone_name FROM r JOIN x4 z ON r.z = z.location_id
       ORDER BY run_ts DESC LIMIT 50""",
)
def _(spark, sf):
    runs = X.scored_preds(spark, sf).select(
        F.unix_timestamp("hour_ts").alias("request_id"),
        F.col("hour_ts").alias("run_ts"),
        "pulocationid",
        "score",
        F.when(F.col("pulocationid") % 2 == 0, "selected").otherwise("nearby").alias("source"),
    )
    return Z.recent_runs(runs, X.x4(spark, sf)).select("run_ts", "included_count", "selected_count", "top_score", "zone_name")


@check(
    "J10_with_source",
    """SELECT p.hour_ts, p.pulocationid, CASE WHEN t.r IS NULL THEN 'nearby' ELSE 'selected' END AS source FROM scored_preds p
       LEFT JOIN (SELECT request_id AS r, ts, unnest(zone_ids) AS id FROM requests) t ON t.ts = p.hour_ts AND t.id = p.pulocationid""",
)
def _(spark, sf):
    grid = Z.scoring_grid(X.requests(spark, sf), X.x4(spark, sf)).select("hour_ts", "pulocationid", "source")
    out = Z.with_source(X.scored_preds(spark, sf), grid, ["hour_ts", "pulocationid"])
    return X.rounded(out.select("hour_ts", "pulocationid", "source"))


@check(
    "J12_with_zone_name",
    "SELECT hour_ts, pulocationid, score, zone AS zone_name FROM scored_preds JOIN x4 ON pulocationid = location_id",
)
def _(spark, sf):
    return Z.with_zone_name(X.scored_preds(spark, sf), X.x4(spark, sf)).select("hour_ts", "pulocationid", "score", "zone_name")


# --- geometry ------------------------------------------------------------

NEAR = """WITH chosen AS (SELECT id, x, y FROM points WHERE label = 0), others AS (SELECT id, x, y FROM points WHERE label <> 0)
  SELECT c.id, o.id AS near_id, round(sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), 6) AS dist,
    row_number() OVER (PARTITION BY c.id ORDER BY sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), o.id) AS rank
  FROM chosen c, others o QUALIFY rank <= 4"""


@check("J4_k_nearest", NEAR)
def _(spark, sf):
    rows = X.points(spark, sf)
    return X.rounded(N.k_nearest(rows, rows.filter("label = 0"), 4))


@check(
    "J4_nearest_of_every_point",
    """SELECT c.id, o.id AS near_id, round(sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), 6) AS dist,
         row_number() OVER (PARTITION BY c.id ORDER BY sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), o.id) AS rank
       FROM points c JOIN points o ON c.id <> o.id QUALIFY rank <= 4""",
)
def _(spark, sf):
    rows = X.points(spark, sf)
    return X.rounded(N.nearest(rows, rows, 4))


@check(
    "A27_ring_center",
    """SELECT id, round(list_sum([p[1] FOR p IN ring]) / 32, 6) + 0.0 AS x, round(list_sum([p[2] FOR p IN ring]) / 32, 6) + 0.0 AS y FROM x6""",
)
def _(spark, sf):
    return X.rounded(H.centers(X.x6(spark, sf), "id", "ring"))


@check(
    "A31_normalise_points",
    """WITH p AS (SELECT id, unnest(ring) AS pt, unnest(range(32)) AS i FROM x6),
       b AS (SELECT min(pt[1]) AS x0, min(pt[2]) AS y0, max(pt[1]) AS x1, max(pt[2]) AS y1 FROM p)
       SELECT id, i, round((pt[1] - x0) / (x1 - x0), 6) + 0.0 AS x, round(1 - (pt[2] - y0) / (y1 - y0), 6) + 0.0 AS y FROM p, b""",
)
def _(spark, sf):
    rows = H.normalise_points(X.x6(spark, sf), "ring").select("id", F.posexplode("ring").alias("i", "p"))
    return X.rounded(rows.select("id", "i", F.get("p", F.lit(0)).alias("x"), F.get("p", F.lit(1)).alias("y")))


@check(
    "C18_decimate",
    """SELECT id, unnest([ring[i] FOR i IN [1, 5, 9, 13, 17, 21, 25, 29, 32]])[1] AS x, unnest(range(9)) AS i FROM x6""",
)
def _(spark, sf):
    rows = X.x6(spark, sf).select("id", F.posexplode(G.decimate("ring")).alias("i", "p"))
    return X.rounded(rows.select("id", "i", F.get("p", F.lit(0)).alias("x")), 6, ())


@check(
    "C19_split_parts",
    """WITH p AS (SELECT id, unnest(range(32)) AS i, 5 + label % 3 AS cut FROM x6)
       SELECT id, CASE WHEN i < cut THEN 0 WHEN i < 20 THEN 1 ELSE 2 END AS part, count(*) AS points FROM p GROUP BY 1, 2""",
)
def _(spark, sf):
    offsets = F.array(F.lit(0), (F.lit(5) + F.col("label") % 3).cast("int"), F.lit(20))
    rows = X.x6(spark, sf).select("id", F.posexplode(G.split_parts("ring", offsets)).alias("part", "ring"))
    return X.rounded(rows.select("id", "part", F.size("ring").alias("points")))


@check(
    "A31_zone_polygons",
    "SELECT id, part, CASE WHEN part = 0 THEN 12 ELSE 20 END AS points FROM x6, (SELECT unnest([0, 1]) AS part)",
)
def _(spark, sf):
    rows = H.zone_polygons(X.x6(spark, sf).withColumn("offsets", F.array(F.lit(0), F.lit(12))), "ring", "offsets")
    return X.rounded(rows.select("id", F.posexplode("polygons").alias("part", "r")).select("id", "part", F.size("r").alias("points")))


# --- batch scoring -------------------------------------------------------


def _centers(spark, sf):
    """A place for each zone: the mean of the points whose id has its number."""
    p = X.points(spark, sf).withColumn("zone", (F.col("id") % 25).cast("int"))
    return p.groupBy(F.col("zone").alias("id")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))


CENTERS = "centers AS (SELECT id % 25 AS id, avg(x) AS x, avg(y) AS y FROM points GROUP BY 1)"


@check(
    "M18_nearby_zones",
    f"""WITH {CENTERS}, named AS (SELECT request_id, ts, unnest(zone_ids) AS id, zone_ids FROM requests),
       pairs AS (SELECT n.request_id, n.ts, n.id, o.id AS near_id, row_number() OVER (PARTITION BY n.request_id, n.id
           ORDER BY sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), o.id) AS rank
         FROM named n JOIN centers c ON c.id = n.id JOIN centers o ON NOT list_contains(n.zone_ids, o.id))
       SELECT DISTINCT request_id, ts, CAST(near_id AS BIGINT) AS id FROM pairs WHERE rank <= 4""",
)
def _(spark, sf):
    return X.rounded(Z.nearby_zones(X.requests(spark, sf), _centers(spark, sf)))


@check(
    "M18_scoring_features",
    f"""WITH {CENTERS}, named AS (SELECT request_id, ts, unnest(zone_ids) AS id, zone_ids FROM requests),
       pairs AS (SELECT n.request_id, n.ts, n.id, o.id AS near_id, row_number() OVER (PARTITION BY n.request_id, n.id
           ORDER BY sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), o.id) AS rank
         FROM named n JOIN centers c ON c.id = n.id JOIN centers o ON NOT list_contains(n.zone_ids, o.id)),
       grid AS (SELECT request_id, ts, id, 'selected' AS source FROM named
         UNION ALL SELECT DISTINCT request_id, ts, near_id, 'nearby' FROM pairs WHERE rank <= 4),
       asked AS (SELECT DISTINCT id AS pulocationid, ts AS hour_ts FROM grid),
       {ACTUAL}, {WITH_HISTORY}, served AS ({SERVED})
       SELECT g.request_id, CAST(g.id AS BIGINT) AS pulocationid, g.source, hour(g.ts) AS hour, round(coalesce(w.temperature_mean, 0), 6) AS temperature_mean,
         CAST(coalesce(w.precipitation_sum, 0) >= 10 AS BIGINT) AS is_heavy_rain, s.demand_lag_1, s.demand_lag_2, s.demand_lag_24, s.rolling_mean_3h
       FROM grid g LEFT JOIN x4 z ON z.location_id = g.id LEFT JOIN x5 w ON w.borough = z.borough AND w.date = CAST(g.ts AS DATE)
       LEFT JOIN served s ON s.pulocationid = g.id AND s.hour_ts = g.ts""",
)
def _(spark, sf):
    rows = serving.scoring_features(
        X.requests(spark, sf), X.fact(spark, sf), X.x4(spark, sf), X.x5(spark, sf), _centers(spark, sf)
    )
    return X.rounded(
        rows.select("request_id", "pulocationid", "source", "hour", "temperature_mean", "is_heavy_rain", *S.LAG_COLUMNS)
    )


SCORED = f"""{CENTERS}, named AS (SELECT request_id, ts, unnest(zone_ids) AS id, zone_ids FROM requests),
       pairs AS (SELECT n.request_id, n.ts, n.id, o.id AS near_id, row_number() OVER (PARTITION BY n.request_id, n.id
           ORDER BY sqrt(pow(o.x - c.x, 2) + pow(o.y - c.y, 2)), o.id) AS rank
         FROM named n JOIN centers c ON c.id = n.id JOIN centers o ON NOT list_contains(n.zone_ids, o.id)),
       grid AS (SELECT request_id, ts, id, 'selected' AS source FROM named
         UNION ALL SELECT DISTINCT request_id, ts, near_id, 'nearby' FROM pairs WHERE rank <= 4),
       asked AS (SELECT DISTINCT id AS pulocationid, ts AS hour_ts FROM grid),
       {ACTUAL}, {WITH_HISTORY}, served AS ({SERVED}), {ridge_sql("features", LAGS, "target_demand", 0.1, "fit")},
       predicted AS (SELECT g.request_id, g.ts AS hour_ts, CAST(g.id AS BIGINT) AS pulocationid, g.source, {LAG_FIT.format(n='fit')} AS p
         FROM grid g JOIN served s ON s.pulocationid = g.id AND s.hour_ts = g.ts, fit)"""


def _scored_zones(spark, sf):
    model = M.fit_pipeline(X.features(spark, sf), M.linear_regression(), LAGS)
    return serving.score_zones(
        X.requests(spark, sf), X.fact(spark, sf), X.x4(spark, sf), X.x5(spark, sf), _centers(spark, sf), model
    )


@check(
    "M18_score_zones",
    f"""WITH {SCORED} SELECT request_id, hour_ts, pulocationid, source, round(p, 4) + 0.0 AS prediction,
          abs(round(greatest(0.0, least(1.0, (p - 23) / 173)), 4)) AS score FROM predicted""",
)
def _(spark, sf):
    return X.rounded(_scored_zones(spark, sf).drop("predicted_demand"), 4)


@check(
    "M18_ranked_zones",
    f"""WITH {SCORED} SELECT request_id, pulocationid, zone AS zone_name, row_number() OVER (PARTITION BY request_id ORDER BY
          round(greatest(0.0, least(1.0, (p - 23) / 173)), 4) DESC, pulocationid) AS rank FROM predicted JOIN x4 ON location_id = pulocationid""",
)
def _(spark, sf):
    ranked = serving.ranked_zones(_scored_zones(spark, sf), X.x4(spark, sf))
    return X.rounded(ranked.select("request_id", "pulocationid", "zone_name", "rank"))

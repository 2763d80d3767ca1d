"""Semantics that bite: gaps, nulls, ties, month ends, empty input, aliases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.functions import score, text, time
from zonepulse.functions.geometry import decimate, ring_center, split_parts
from zonepulse.operators import (
    conform as C,
    demand as D,
    drift as DR,
    features as FT,
    integrity as I,
    lags as L,
    model as M,
    nearest as N,
    profile as P,
    quality as Q,
    ranking as K,
    scoring as Z,
)
from zonepulse.plans import etl
from zonepulse.plans.features import build_features
from zonepulse.sources import readers as R, replace as RP


def hours(spark, rows, cols="zone int, ts timestamp_ntz, v bigint"):
    return spark.createDataFrame(rows, cols)


def at(day, hour=0):
    return dt.datetime(2024, 1, day, hour)


def values(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


# --- drift scores and guardrails just below, at and above their borders ---

@pytest.mark.parametrize(
    "ref,cur,want",
    [(0.0, 0.0, 0.0), (0.0, -0.001, 1.0), (8.0, 8.0, 0.0), (8.0, 10.0, 0.25), (8.0, 6.0, 0.25), (8.0, 15.9, 0.9875), (8.0, 16.0, 1.0), (8.0, 17.0, 1.0), (8.0, -8.0, 1.0), (-4.0, -3.0, 0.25)],
)
def test_relative_shift(spark, ref, cur, want):
    df = spark.createDataFrame([(ref, cur)], "r double, c double")
    assert df.select(score.relative_shift("r", "c")).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("border,below,above", [(0.30, "Healthy", "Medium"), (0.55, "Medium", "High"), (0.80, "High", "Critical")])
def test_severity(spark, border, below, above):
    got = spark.range(1).select(*[score.severity(F.lit(x)).alias(f"s{i}") for i, x in enumerate((border - 1e-9, border, border + 1e-9))]).first()
    assert list(got) == [below, above, above]


@pytest.mark.parametrize(
    "critical,high,label,model,want",
    [(0, 1, None, None, False), (0, 2, None, None, True), (2, 0, None, None, True), (0, 3, False, False, True), (0, 1, False, False, False), (0, 0, True, None, True), (0, 0, None, True, True), (0, 0, False, None, False)],
)
def test_should_alert(spark, critical, high, label, model, want):
    layout = "critical_count int, high_drift_count int, label_should_alert boolean, model_should_alert boolean"
    assert spark.createDataFrame([(critical, high, label, model)], layout).select(DR.should_alert()).first()[0] is want


@pytest.mark.parametrize(
    "name,kind",
    [("wind_speed_max", "numeric_mean_shift"), ("hour_sin", "numeric_mean_shift"), ("borough_queens", "categorical_proportion_shift"), ("borough", "unknown"), ("", "unknown")],
)
def test_feature_kind(spark, name, kind):
    assert spark.range(1).select(score.feature_kind(F.lit(name))).first()[0] == kind


OLD = {"val_rmse": 20.0, "val_mae": 8.0, "val_smape": 0.5}


@pytest.mark.parametrize("metric,tolerance", [("val_rmse", 1.01), ("val_mae", 1.05), ("val_smape", 1.05)])
@pytest.mark.parametrize("step,approved", [(-1e-6, True), (1e-6, False), (None, False)])
def test_promotion_guardrails(spark, metric, tolerance, step, approved):
    layout = "model string, val_rmse double, val_mae double, val_smape double"
    new = OLD | {metric: None if step is None else OLD[metric] * tolerance + step}
    production = spark.createDataFrame([("worse", 40.0, 9.0, 0.9), ("best", *OLD.values())], layout)
    row = M.promotion(spark.createDataFrame([("n", *new.values())], layout), production).first()
    assert row["approved"] is approved
    assert row["decision"] == ("register_model" if approved else "skip_registration")


def test_metrics_that_only_one_side_lacks(spark):
    layout = "model string, val_rmse double, val_mae double, val_smape double"
    new = spark.createDataFrame([("n", 19.0, 8.0, 0.5)], layout)
    assert M.promotion(new, spark.createDataFrame([("o", 20.0, None, 0.5)], layout)).first()["approved"]
    assert not M.promotion(spark.createDataFrame([("n", None, None, None)], layout)).first()["approved"]


def test_csv_columns_are_found_by_header(spark, tmp_path):
    (tmp_path / "zones.csv").write_text("zone,BOROUGH,LocationID,service_zone\nHill,Queens,7,Boro\n")
    assert R.read_zones(spark, str(tmp_path / "zones.csv")).first().asDict() == {"LocationID": 7, "Borough": "Queens", "Zone": "Hill", "service_zone": "Boro"}
    (tmp_path / "short.csv").write_text("date,Borough\n2024-01-01,Queens\n")
    with pytest.raises(ValueError, match="temperature_mean"):
        R.read_weather_csv(spark, str(tmp_path / "short.csv"))


def test_dimension_joins_do_not_multiply_rows(spark):
    zones = spark.createDataFrame([(1, "Bronx", "a"), (1, "Bronx ", "b")], "location_id int, borough string, service_zone string")
    rows = spark.createDataFrame([(1, at(5, 9))], "pulocationid int, hour_ts timestamp")
    assert Z.with_zone_meta(rows, zones).count() == 1
    weather = spark.createDataFrame([(dt.date(2024, 1, 5), 1.0, 2.0, 3.0, b) for b in ("Bronx", "bronx ")], S.WEATHER)
    assert Z.with_weather(rows.withColumn("borough", F.lit("BRONX")), weather).count() == 1
    assert FT.join_weather(rows.withColumn("borough", F.lit("BRONX")), weather).count() == 1


def test_first_model_is_approved(spark):
    new = spark.createDataFrame([("n", 1.0, 1.0, 1.0)], "model string, val_rmse double, val_mae double, val_smape double")
    row = M.promotion(new).first()
    assert row["approved"] and row["first_model"]
    row = M.promotion(new, new.limit(0)).first()
    assert row["approved"] and row["first_model"]


def test_model_choice_prefers_lower_smape_within_gap(spark):
    layout = "model string, val_rmse double, val_smape double"
    close = spark.createDataFrame([("a", 10.0, 0.5), ("b", 10.5, 0.4), ("c", 12.0, 0.1)], layout)
    apart = spark.createDataFrame([("a", 10.0, 0.5), ("b", 11.5, 0.4)], layout)
    assert M.select_model(close).first()["model"] == "b"
    assert M.select_model(apart).first()["model"] == "a"
    assert M.select_model(apart.filter("model = 'a'")).first()["model"] == "a"


# --- conforming ----------------------------------------------------------


def test_both_surcharge_spellings_and_case_clash(spark):
    df = spark.createDataFrame(
        [(1.0, None, 2.5, "x"), (None, 3.0, 1.5, "y")],
        "congestion_surchage double, congestion_surcharge double, Airport_fee double, PULocationID string",
    )
    out = C.conform(df, "fhvhv")
    assert out.columns == S.TRIP.names
    rows = out.select("congestion_surcharge", "airport_fee", "pulocationid", "total_amount").collect()
    assert [tuple(r) for r in rows] == [(1.0, 2.5, None, 3.5), (3.0, 1.5, None, 4.5)]


def test_conformed_types(spark):
    out = C.conform(spark.createDataFrame([("Y", "7")], "store_and_fwd_flag string, passenger_count string"), "yellow")
    assert out.dtypes == spark.createDataFrame([], S.TRIP).dtypes
    assert out.first()["store_and_fwd_flag"] is True


def test_missing_feeds(spark):
    with pytest.raises(ValueError):
        C.union_present({"yellow": None, "fhvhv": None})


def test_yn_flag(spark):
    df = spark.createDataFrame([("Y",), ("N",), ("?",), (None,)], "f string")
    assert [r[0] for r in df.select(text.yn_flag("f")).collect()] == [True, False, None, None]


def test_filters_drop_nulls(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (-1.0,), (None,)], "x double")
    assert C.non_negative(df, ["x"]).count() == 2


# --- time ----------------------------------------------------------------


def test_times_do_not_depend_on_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30, 15),)], "ts timestamp_ntz")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        row = df.select(time.hour_bucket("ts"), time.epoch("ts"), time.from_epoch(time.epoch("ts")), time.date_trunc("month", "ts")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert row[0] == dt.datetime(2024, 3, 10, 2)
    assert row[1] == int(dt.datetime(2024, 3, 10, 2, 30, 15, tzinfo=dt.timezone.utc).timestamp())
    assert row[2] == dt.datetime(2024, 3, 10, 2, 30, 15)
    assert row[3] == dt.datetime(2024, 3, 1)


@pytest.mark.parametrize("year,month,days", [(2023, 2, 28), (2024, 2, 29), (2024, 4, 30), (2024, 12, 31)])
def test_month_ends(spark, year, month, days):
    start = dt.datetime(year, month, 1)
    rows = [(start - dt.timedelta(seconds=1),), (start,), (start + dt.timedelta(days=days, seconds=-1),), (start + dt.timedelta(days=days),)]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    assert D.in_month(df, "ts", year, month).count() == 2
    assert df.limit(1).select(time.days_in_month(F.lit(f"{year}-{month:02d}-01").cast("date"))).first()[0] == days


def test_window_includes_last_day(spark):
    df = hours(spark, [(1, at(1, 0), 1), (1, at(2, 23), 1), (1, at(3, 0), 1)])
    assert D.in_window(df, "ts", "2024-01-01", "2024-01-02").count() == 2


def test_run_windows(spark):
    df = spark.createDataFrame([(dt.date(2025, 4, 30), False), (dt.date(2025, 3, 31), True)], "run_date date, first boolean")
    rows = {r["run_date"]: r for r in D.run_windows(df, first_run="first").collect()}
    r = rows[dt.date(2025, 4, 30)]
    assert (r["start_date"], r["end_date"], r["train_start"]) == (dt.date(2025, 2, 1), dt.date(2025, 2, 28), dt.date(2022, 2, 1))
    assert rows[dt.date(2025, 3, 31)]["start_date"] == dt.date(2023, 1, 1)


# --- lags ----------------------------------------------------------------


def test_row_and_time_lags_differ_on_gaps(spark):
    df = hours(spark, [(1, at(1, 0), 10), (1, at(1, 1), 20), (1, at(1, 3), 30)])
    by_row = {r["ts"].hour: r for r in L.lag_features(df, "zone", "ts", "v", "rows").collect()}
    by_time = {r["ts"].hour: r for r in L.lag_features(df, "zone", "ts", "v", "time").collect()}
    assert (by_row[3]["v_lag_1"], by_row[3]["v_lag_2"], by_row[3]["rolling_mean_3h"]) == (20, 10, 15.0)
    assert (by_time[3]["v_lag_1"], by_time[3]["v_lag_2"], by_time[3]["rolling_mean_3h"]) == (None, 20, 15.0)


def _series(spark, gap):
    """Three zones over 90 days; one holds most rows, one is sparse."""
    return spark.range(90 * 24 * 3).select(
        (F.col("id") % 3).cast("int").alias("zone"),
        F.timestamp_add("HOUR", F.floor(F.col("id") / 3), F.lit("2024-01-01").cast("date").cast("timestamp_ntz")).alias("ts"),
        (F.col("id") * 7919 % 101).alias("v"),
    ).filter(F.lit(not gap) | (F.col("zone") == 0) | (F.hash("id") % F.when(F.col("zone") == 1, 3).otherwise(211) == 0))


@pytest.mark.parametrize("mode", ["rows", "time"])
@pytest.mark.parametrize("split", [1, 7, 31])
def test_split_lags_equal_unsplit(spark, mode, split):
    df = _series(spark, True)
    whole = L.lag_features(df, "zone", "ts", "v", mode, split_days=None)
    cut = L.lag_features(df, "zone", "ts", "v", mode, split_days=split)
    assert whole.columns == cut.columns
    assert whole.exceptAll(cut).count() == 0 and cut.exceptAll(whole).count() == 0


def test_modes_agree_without_gaps(spark):
    df = _series(spark, False)
    a = FT.drop_incomplete(L.lag_features(df, "zone", "ts", "v", "rows"), ["v_lag_24"])
    b = FT.drop_incomplete(L.lag_features(df, "zone", "ts", "v", "time"), ["v_lag_24"])
    assert a.count() == b.count() > 0
    assert a.exceptAll(b).count() == 0


def test_split_lags_keep_other_columns(spark):
    df = _series(spark, True).withColumn("note", F.col("v").cast("string"))
    out = L.lag_rows(df, "zone", "ts", "v", (1,), split_days=7)
    assert out.columns == ["zone", "ts", "v", "note", "v_lag_1"]
    assert out.filter("note <> cast(v as string)").count() == 0
    assert out.count() == df.count()


def test_serving_lags_fall_back(spark):
    fact = spark.createDataFrame(
        [(1, at(1, 9), 4), (1, at(8, 9), 6), (1, at(8, 8), 0)], "pulocationid int, hour_ts timestamp_ntz, demand bigint"
    )
    asks = spark.createDataFrame([(1, at(15, 10)), (1, at(8, 10)), (2, at(8, 10))], "pulocationid int, hour_ts timestamp_ntz")
    rows = {(r[0], r[1].day): r for r in L.serving_lags(asks, fact).collect()}
    assert rows[1, 15]["demand_lag_1"] == 5.0 and rows[1, 15]["rolling_mean_3h"] == 5.0
    assert rows[1, 8]["demand_lag_1"] == 6.0 and rows[1, 8]["rolling_mean_3h"] == 3.0
    assert rows[2, 8]["demand_lag_1"] == 0.0


def test_lag_request_between_hours(spark):
    fact = spark.createDataFrame([(1, at(1, 8), 4), (1, at(1, 9), 6)], "pulocationid int, hour_ts timestamp_ntz, demand bigint")
    asks = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 10, 30))], "pulocationid int, hour_ts timestamp_ntz")
    row = L.lags_at_offsets(fact, asks, "pulocationid", "hour_ts").first()
    assert row["demand_lag_1"] is None and row["rolling_mean_3h"] == 5.0


# --- features ------------------------------------------------------------


def test_null_borough_sets_its_indicator(spark):
    df = spark.createDataFrame([(None, None), (" Manhattan ", "Airports")], "borough string, service_zone string")
    rows = FT.encode_location(df).collect()
    assert (rows[0]["borough_manhattan"], rows[0]["borough_nan"], rows[0]["service_zone_nan"]) == (0, 1, 1)
    assert (rows[1]["borough_manhattan"], rows[1]["borough_nan"], rows[1]["service_zone_Airports"]) == (1, 0, 1)


def test_lookback_keeps_the_first_day(spark):
    n = 72
    fact = spark.range(n).select(
        F.lit(1).alias("pulocationid"),
        F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("date").cast("timestamp_ntz")).alias("hour_ts"),
        F.col("id").alias("demand"),
    )
    zone = spark.createDataFrame([(1, "Queens", "z", None)], S.ZONE)
    weather = spark.createDataFrame([(dt.date(2024, 1, 2), 26.0, 11.0, 3.0, "queens ")], S.WEATHER)
    plain = build_features(fact, zone, weather, "2024-01-02", "2024-01-03")
    wide = build_features(fact, zone, weather, "2024-01-02", "2024-01-03", lookback=2)
    assert plain.count() == 24 and wide.count() == 48
    assert wide.dtypes == spark.createDataFrame([], S.FEATURE_TABLE).dtypes
    hot = wide.filter("hour_ts = '2024-01-02 05:00:00'").first()
    assert (hot["is_hot"], hot["is_heavy_rain"], hot["borough_queens"], hot["service_zone_nan"]) == (1, 1, 1, 1)


def test_feature_order_is_fixed():
    assert S.FEATURES[0] == "pulocationid" and len(S.FEATURES) == 31
    assert S.FEATURES.index("rolling_mean_3h") < S.FEATURES.index("borough_manhattan")
    assert len(S.NUMERIC_FEATURES) == 18 and len(S.ONE_HOT_FEATURES) == 12


# --- integrity -----------------------------------------------------------


@pytest.mark.parametrize("strict", [False, True])
def test_fingerprint_detects_any_change(spark, strict):
    df = spark.createDataFrame([(1, "a", None), (2, "b", 1.5), (3, None, 2.0)], "k int, s string, x double")
    signed = I.apply_fingerprint(df, "key", strict)
    assert I.tampered_count(signed, "key", strict).first()["n"] == 0
    assert I.tampered_count(signed, "other", strict).first()["n"] == 3
    changed = signed.withColumn("s", F.when(F.col("k") == 2, "c").otherwise(F.col("s")))
    assert I.tampered_count(changed, "key", strict).first()["n"] == 1
    erased = signed.withColumn("row_fingerprint", F.when(F.col("k") > 1, F.col("row_fingerprint")))
    assert I.tampered_count(erased, "key", strict).first()["n"] == 1


def test_strict_fingerprint_separates_nulls_and_joins(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a||b", "c"), ("a", "b||c")], "x string, y string")
    plain = I.apply_fingerprint(df, "key").select("row_fingerprint").distinct().count()
    strict = I.apply_fingerprint(df, "key", strict=True).select("row_fingerprint").distinct().count()
    assert (plain, strict) == (2, 4)


def test_fingerprint_needs_a_key(spark):
    with pytest.raises(ValueError):
        I.apply_fingerprint(spark.range(1), "")


def test_content_hash_ignores_order_and_sees_copies(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, s string")
    a = I.content_hash(df).first()
    assert I.content_hash(df.orderBy(F.desc("k"))).first() == a
    assert I.content_hash(df.unionByName(df)).first() != a
    assert I.content_hash(df.limit(0)).first()["n"] == 0


# --- quality -------------------------------------------------------------


def failing(results):
    return {r["rule"]: r["failing"] for r in results.collect()}


def test_empty_and_incomplete_tables(spark):
    empty = spark.createDataFrame([], S.ZONE)
    assert failing(Q.check_zones(empty))["empty"] == 1
    lacking = spark.createDataFrame([(1,)], "location_id int")
    assert failing(Q.check_zones(lacking)) == {"empty": 0, "missing_columns": 3}


def test_duplicates_count_null_keys(spark):
    df = spark.createDataFrame([(None, "a", "b", "c"), (None, "a", "b", "c"), (1, "a", "b", "c")], S.ZONE)
    got = failing(Q.check_zones(df))
    assert (got["null_id"], got["duplicate_key"]) == (2, 1)


def test_assert_expectations(spark, capsys):
    layout = "table_name string, rule string, severity string, failing bigint, detail string"
    fine = spark.createDataFrame([("t", "r", "error", 0, None), ("t", "w", "warning", 2, "x")], layout)
    Q.assert_expectations(fine)
    assert "WARNING: t: w (2) x" in capsys.readouterr().out
    with pytest.raises(ValueError, match="t: r"):
        Q.assert_expectations(spark.createDataFrame([("t", "r", "error", 1, None)], layout))


def test_unchanged_lookup_is_silent(spark):
    df = spark.createDataFrame([(1, "a", "b", "c"), (2, "a", "b", "c")], S.ZONE_RAW)
    assert set(failing(Q.check_lookup_change(df, df.orderBy(F.desc("LocationID")))).values()) == {0}
    assert failing(Q.check_lookup_change(df, None)) == {"no_previous": 1}


def test_anomaly_flags(spark):
    layout = "demand bigint, avg_trip_distance double, avg_total_amount double, x string"
    df = spark.createDataFrame([(0, 0.0, -1.0, None), (0, 1.0, 600.0, None), (4000, -1.0, 5.0, "a")], layout)
    got = {r["flag"]: r["value"] for r in P.anomaly_flags(df).collect()}
    assert set(got) == {
        "zero_demand_rate",
        "high_demand",
        "negative_amount",
        "high_amount",
        "negative_distance",
        "zero_distance_rate",
        "null_rate:x",
    }
    assert [r["flag"] for r in P.anomaly_flags(df.limit(0)).collect()] == ["empty"]


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "x double")
    rows = P.histogram(df, "x", 4).orderBy("bin").collect()
    assert [r["n"] for r in rows] == [0, 0, 2, 0] and rows[0]["lo"] == 4.5 and rows[-1]["hi"] == 5.5


def test_binned_mean_keeps_edges_and_empty_bins(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 3.0), (10.0, 5.0)], "x double, y double")
    got = {r["bin"]: r["mean"] for r in P.binned_mean(df, "x", "y", 10).collect()}
    assert got[0] == 2.0 and got[9] == 5.0 and got[4] is None and len(got) == 10


# --- replacement ---------------------------------------------------------


def test_replacing_twice_changes_nothing(spark):
    target = hours(spark, [(1, at(d), d) for d in range(1, 11)])
    new = hours(spark, [(1, at(d), -d) for d in range(3, 6)])
    for once in (
        RP.replace_observed_range(target, new, "ts"),
        RP.replace_window(target, new, "ts", "2024-01-03", "2024-01-05"),
    ):
        twice = RP.replace_observed_range(once, new, "ts")
        assert sorted(values(once, "ts", "v")) == sorted(values(twice, "ts", "v"))
        assert once.count() == 10
    assert RP.replace_observed_range(target, new.limit(0), "ts").count() == 10


def test_upsert_keeps_unlisted_columns(spark):
    layout = "k int, v string, triggered boolean"
    old = spark.createDataFrame([(1, "a", True), (2, "b", True)], layout)
    new = spark.createDataFrame([(2, None, False), (3, "c", False)], layout)
    got = sorted(values(RP.upsert(old, new, ["k"], ["v"]), "k", "v", "triggered"))
    assert got == [(1, "a", True), (2, None, True), (3, "c", False)]


# --- ranking, sampling, ranges -------------------------------------------


def test_global_rank_over_many_partitions_and_ties(spark):
    df = spark.range(5000).repartition(13).select("id", (F.col("id") % 7).alias("s"))
    rows = K.rank_by(df, "s", "id").orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 5001))
    assert [(r["s"], r["id"]) for r in rows] == sorted(((i % 7, i) for i in range(5000)), key=lambda t: (-t[0], t[1]))
    assert K.rank_by(df.limit(0), "s", "id").count() == 0


def test_first_per_key_is_deterministic(spark):
    df = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (2, None, 3)], "k int, s string, n int")
    assert sorted(values(K.first_per_key(df.repartition(5), ["k"]), "k", "s", "n")) == [(1, "a", 2), (2, None, 3)]


@pytest.mark.parametrize("key", [None, ["id"]])
def test_sample_n_size(spark, key):
    from zonepulse.sources.sampling import sample_n

    df = spark.range(20_000)
    assert sample_n(df, 500, 1, key).distinct().count() == 500
    assert sample_n(df, 50_000, 1, key).count() == 20_000


def test_ranges_are_disjoint_and_complete(spark):
    df = spark.range(-5, 400).select(F.when(F.col("id") != 7, F.col("id")).alias("z"))
    predicates = R.range_predicates("z", 1, 300, 4)
    hits = df.select(*[F.expr(f"CAST(({p}) AS INT)").alias(f"p{i}") for i, p in enumerate(predicates)])
    total = sum(F.coalesce(F.col(c), F.lit(0)) for c in hits.columns)
    assert len(predicates) == 4
    assert hits.filter(total != 1).count() == 0


def test_splits_are_disjoint_and_complete(spark):
    df = _series(spark, True)
    parts = M.time_split(df, "ts", *M.time_cutoffs(df, "ts", err=0))
    counts = [p.count() for p in parts]
    assert sum(counts) == df.count()
    assert counts[0] / sum(counts) == pytest.approx(0.70, abs=0.01)
    assert max(values(parts[0].agg(F.max("ts")), "max(ts)")) < min(values(parts[1].agg(F.min("ts")), "min(ts)"))


# --- nearest points ------------------------------------------------------


def brute(points, probes, k):
    out = {}
    for pid, x, y in probes:
        near = sorted((((a - x) ** 2 + (b - y) ** 2) ** 0.5, i) for i, a, b in points if i != pid)
        out[pid] = [i for _, i in near[:k]]
    return out


@pytest.mark.parametrize("shape", ["uniform", "clustered", "copies", "line"])
def test_nearest_matches_brute_force(spark, shape):
    import random

    rng = random.Random(7)
    pts = []
    for i in range(700):
        if shape == "uniform":
            x, y = rng.random(), rng.random()
        elif shape == "clustered":
            # A third of the points in one small spot, and a few far away.
            x, y = (rng.random() * 1e-3, rng.random() * 1e-3) if i % 3 else (rng.random() * 100, rng.random() * 100)
        elif shape == "copies":
            x, y = (0.5, 0.5) if i % 3 == 0 else (float(rng.randint(0, 9)), float(rng.randint(0, 9)))
        else:
            x, y = float(i % 50), float(i % 50)
        pts.append((i, x, y))
    points = spark.createDataFrame(pts, "id bigint, x double, y double")
    probes = [p for p in pts if p[0] % 5 == 0] + [(9999, 1e4, -1e4)]
    got = {}
    for r in N.nearest(points, spark.createDataFrame(probes, points.schema), 4).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["near_id"])
    assert got == brute(pts, probes, 4)


@pytest.mark.parametrize("shape", ["near line", "clusters", "outliers", "heavy side"])
def test_nearest_pairs_are_bounded(spark, shape):
    """At most 32 * k pairs for each point, and no cell holds more than it may, whatever the points look like."""
    import random

    rng, n, k = random.Random(11), 1500, 4
    make = {
        "uniform": lambda i: (rng.random(), rng.random()),
        "line": lambda i: (float(i), 3.0),
        "near line": lambda i: (float(i), rng.random()),
        "clusters": lambda i: (i % 7 * 1e4 + rng.gauss(0, 1), i % 5 * 1e6 + rng.gauss(0, 1e-3)),
        "outliers": lambda i: (rng.gauss(0, 1), rng.gauss(0, 1)) if i % 100 else (1e9 * rng.random(), -1e9 * rng.random()),
        "heavy side": lambda i: (5.0, rng.random()) if i % 50 else (rng.random(), rng.random()),
    }[shape]
    pts = [(i, *make(i)) for i in range(n)]
    points = spark.createDataFrame(pts, "id bigint, x double, y double")
    tree = N.build_tree(points, k + 1)
    assert tree.points.count() == n
    assert tree.points.groupBy("node").count().agg(F.max("count")).first()[0] <= 3 * (k + 1)
    first, second = N.candidates(tree, points.select("x", "y"), ["x", "y"], k + 1)
    assert first.count() + second.count() <= 32 * n * k
    got = {}
    for r in N.nearest(points, points.filter("id % 10 = 0"), k).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["near_id"])
    assert got == brute(pts, [p for p in pts if p[0] % 10 == 0], k)


def test_nearest_allowed_per_group(spark):
    """Each group bars its own points; a group that bars all costs nothing, ties go to the lower id, missing places are left out."""
    import random

    rng = random.Random(3)
    pts = [(i, float(rng.randint(0, 30)), float(rng.randint(0, 30))) for i in range(400)]
    points = spark.createDataFrame([*pts, (900, None, 1.0)], "id bigint, x double, y double")
    bars = {1: {3}, 2: set(range(0, 400, 2)), 3: set(range(400)), 4: set(range(398)), 5: {7, 900}, None: {5, 6}}
    named = spark.createDataFrame([(g, i) for g, ids in bars.items() for i in sorted(ids)], "group bigint, id bigint")
    found = N.nearest_allowed(points, named.join(points, "id"), named, 4)
    got = {}
    for r in found.orderBy("group", "id", "rank").collect():
        got.setdefault((r["group"], r["id"]), []).append(r["near_id"])
    want = {}
    for g, ids in bars.items():
        rest = [p for p in pts if p[0] not in ids]
        for i in ids - {900}:
            want[g, i] = brute(rest, [pts[i]], 4)[i]
    assert got == {key: ids for key, ids in want.items() if ids}
    tree = N.build_tree(points.filter("x IS NOT NULL"), 4)
    probes = named.join(points, "id").filter("x IS NOT NULL")
    first, second = N.candidates(tree, probes.filter("group = 3"), ["group", "id", "x", "y"], 4, named)
    assert first.count() == second.count() == 0
    first, second = N.candidates(tree, probes.filter("group = 2"), ["group", "id", "x", "y"], 4, named)
    assert first.count() + second.count() <= 32 * 200 * 4


def test_nearest_skips_selected_and_small_catalogues(spark):
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 0.0), (3, 2.0, 0.0)], "id bigint, x double, y double")
    chosen = spark.createDataFrame([(1,), (2,), (77,)], "id bigint")
    assert sorted(values(N.k_nearest(points, chosen, 4), "id", "near_id", "rank")) == [(1, 3, 1), (2, 3, 1)]


def test_scoring_grid_tags_and_defaults(spark):
    req = spark.createDataFrame([(1, at(6, 5), [2, 2, 9])], "request_id bigint, ts timestamp_ntz, zone_ids array<int>")
    near = spark.createDataFrame([(1, at(6, 5), 2), (1, at(6, 5), 3)], "request_id bigint, ts timestamp_ntz, id int")
    zones = spark.createDataFrame([(2, " Queens ", "z2", "Airports"), (3, "", "z3", " ")], S.ZONE)
    rows = {r["pulocationid"]: r for r in Z.scoring_grid(req, zones, near).collect()}
    assert {k: r["source"] for k, r in rows.items()} == {2: "selected", 9: "selected", 3: "nearby"}
    assert rows[2]["borough_queens"] == 1 and rows[2]["is_weekend"] == 1
    assert rows[3]["borough_nan"] == 1 and rows[9]["service_zone_nan"] == 1


# --- geometry ------------------------------------------------------------


def test_ring_expressions(spark):
    df = spark.createDataFrame(
        [([[float(i), 0.0] for i in range(34)],), ([[1.0, 2.0], [3.0, 4.0]],), ([],), (None,)], "r array<array<double>>"
    )
    sizes = [r[0] for r in df.select(F.size(decimate("r"))).collect()]
    assert sizes[:3] == [10, 2, 0]
    assert [tuple(r[0]) for r in df.select(ring_center("r")).collect()][1:] == [(2.0, 3.0), (0.0, 0.0), (0.0, 0.0)]
    parts = df.select(split_parts("r", F.array(F.lit(0), F.lit(1), F.lit(1))).alias("p")).collect()
    assert [len(p) for p in parts[0][0]] == [1, 33] and parts[2][0] == []


# --- whole jobs ----------------------------------------------------------


def test_build_fact_cleans_and_signs(spark):
    layout = "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_distance double, total_amount double"
    good = (1, at(5, 9), at(5, 10), 4, 5, 2.0, 10.0)
    rows = [
        good,
        (1, at(5, 9), at(5, 10), 4, 5, 4.0, 20.0),
        (1, at(5, 10), at(5, 9), 4, 5, 2.0, 10.0),
        (1, at(5, 9), at(5, 10), 264, 5, 2.0, 10.0),
        (1, at(5, 9), at(5, 10), 4, 5, -2.0, 10.0),
        (1, at(5, 9), at(5, 10), 4, None, 2.0, 10.0),
        (1, at(5, 9), at(5, 10), 4, 5, None, 10.0),
        (1, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2), 4, 5, 2.0, 10.0),
    ]
    fact = etl.build_fact({"yellow": spark.createDataFrame(rows, layout), "fhvhv": None}, 2024, 1, "key")
    assert fact.columns == S.FACT.names
    assert values(fact, "hour_ts", "pulocationid", "demand", "avg_trip_distance") == [(at(5, 9), 4, 2, 3.0)]
    assert I.tampered_count(fact, "key").first()["n"] == 0


@pytest.mark.parametrize("groups", [1, 3, 40, 2000])
def test_ranks_of_groups_of_any_size(spark, groups):
    """Groups over many ranges, small ones within one, a null group, nulls and NaN among the scores, ties; no window gets a large group whole."""
    from pyspark.sql import Window

    n = 4000
    number = F.col("id") % groups
    df = spark.range(n).select(
        "id", F.when(number != 1, number).alias("g"),
        F.when(F.col("id") % 17 == 0, None).when(F.col("id") % 19 == 0, float("nan")).otherwise((F.col("id") * 7 % 11).cast("double")).alias("s"),
        (F.col("id") % 5).cast("int").alias("i"),
    )
    for within in (["g"], []):
        for score_ in ("s", "i"):
            w = Window.partitionBy(*within).orderBy(F.col(score_).desc(), "id")
            want = df.withColumn("rank", F.row_number().over(w).cast("long"))
            got = K.rank_by(df, score_, "id", within)
            assert got.schema["rank"].dataType == want.schema["rank"].dataType
            assert got.exceptAll(want).count() == 0 and got.count() == n
    near = K.rank_within(df, ["g"], "s", "id")
    assert near.exceptAll(df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("s", "id")).cast("long"))).count() == 0
    with pytest.raises(TypeError):
        K.rank_by(df.withColumn("t", F.lit("x")), "t", "id")


def test_rank_places_lie_between_borders(spark):
    borders = F.array(*[F.lit(x) for x in range(0, 100, 2)])
    rows = spark.range(-3, 110).select("id", K._place(F.col("id").cast("int"), borders).alias("p")).collect()
    assert all(r["p"] == sum(b < r["id"] for b in range(0, 100, 2)) for r in rows)


# --- payloads ------------------------------------------------------------


def test_payload_lookup_equals_payload_at(spark):
    texts = [
        '{"hourly":{"time":["2024-01-01T00:00","2024-01-01T01:00","2024-01-01T01:00"],"t":["1.5","2.5","3.5"],"r":["7"]}}',
        '{"hourly":{"time":["2024-01-01T01:00",null],"t":["x","4"]}}',
        '{"hourly":{"t":["4"]}}',
        "not json",
        None,
    ]
    payloads = spark.createDataFrame(list(enumerate(texts)), "k int, payload string")
    asked = spark.createDataFrame([(k, at(1, h)) for k in range(5) for h in range(3)], "k int, ts timestamp_ntz")
    fields = {"temp": "t", "rain": "r"}
    found = values(R.payload_lookup(asked, payloads, ["k"], "payload", "ts", fields), "k", "ts", "temp", "rain")
    inside = values(R.payload_at(asked.join(payloads, "k"), "payload", "ts", fields), "k", "ts", "temp", "rain")
    assert sorted(found, key=str) == sorted(inside, key=str)
    assert (0, at(1, 1), 2.5, None) in found and (0, at(1, 0), 1.5, 7.0) in found
    lone = R.payload_lookup(hours(spark, [(9, at(1))], "k int, ts timestamp_ntz"), payloads, ["k"], "payload", "ts", fields)
    assert values(lone, "k", "temp", "rain") == [(9, None, None)]

"""Tables kept by month: what a run changes, what a dead run leaves, and months that equal one run over all."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.plans import reports, stored
from zonepulse.plans.features import build_features
from zonepulse.sources import versions as V

ROWS = "ts timestamp_ntz, v int"


def day(month, d, hour=0):
    return dt.datetime(2024, month, d, hour)


def table(spark, root, version=None):
    schema = spark.createDataFrame([], ROWS).schema
    return sorted((r.ts, r.v) for r in V.read_version(spark, root, "t", schema, version).collect())


@pytest.fixture
def root(spark, tmp_path):
    path = str(tmp_path / "root")
    rows = spark.createDataFrame([(day(m, d), m * 100 + d) for m in (1, 2, 3, 4) for d in (1, 10, 20)], ROWS)
    V.publish(spark, path, V.current(spark, path), {"t": V.stage(rows, path, "t", "ts")})
    return path


def test_replacing_leaves_other_months_alone(spark, root):
    before = V.current(spark, root)
    new = spark.createDataFrame([(day(2, 15), -1), (day(3, 2), -2)], ROWS)
    after = V.replace_days(new, root, "t", "ts", "2024-02-10", "2024-03-10")
    assert table(spark, root) == sorted([(day(m, d), m * 100 + d) for m, d in ((1, 1), (1, 10), (1, 20), (2, 1), (3, 20), (4, 1), (4, 10), (4, 20))] + [(day(2, 15), -1), (day(3, 2), -2)])
    same = {m for m in before.folders["t"] if before.folders["t"][m] == after.folders["t"][m]}
    assert same == {"2024-01", "2024-04"}
    assert len(table(spark, root, before)) == 12
    V.replace_one_month(new.limit(0), root, "t", "ts", 2024, 4)
    assert set(V.current(spark, root).folders["t"]) == {"2024-01", "2024-02", "2024-03"}
    V.replace_observed(spark.createDataFrame([(day(1, 10), 7), (day(1, 20), 8)], ROWS), root, "t", "ts")
    assert [x for x in table(spark, root) if x[0].month == 1] == [(day(1, 1), 101), (day(1, 10), 7), (day(1, 20), 8)]


def test_rows_without_time_and_new_months(spark, root):
    new = spark.createDataFrame([(None, 1), (day(9, 1), 2)], ROWS)
    V.replace_days(new, root, "t", "ts", "2024-05-01", "2024-05-31")
    V.replace_days(new, root, "t", "ts", "2024-05-01", "2024-05-31")
    schema = new.schema
    assert V.read_version(spark, root, "t", schema).filter("ts IS NULL").count() == 2
    assert V.read_version(spark, root, "t", schema).count() == 16
    assert V.read_version(spark, root, "t", schema, first="2024-03", last="2024-04").count() == 6
    assert V.replace_observed(new.filter("ts IS NULL"), root, "t", "ts").number == 4
    assert V.read_version(spark, root, "t", schema).filter("ts IS NULL").count() == 3


def test_a_dead_run_leaves_the_tables_as_they_were(spark, root, monkeypatch):
    before = table(spark, root)
    new = spark.createDataFrame([(day(2, 15), -1)], ROWS)
    with monkeypatch.context() as m:
        m.setattr(V, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            V.replace_one_month(new, root, "t", "ts", 2024, 2)
    assert table(spark, root) == before and V.current(spark, root).number == 1
    V.replace_one_month(new, root, "t", "ts", 2024, 2)
    assert V.expire(spark, root, keep=1) == 1
    assert len(table(spark, root)) == 10


def test_a_second_writer_of_the_same_number_fails(spark, root):
    old = V.current(spark, root)
    V.publish(spark, root, old, {})
    with pytest.raises(Exception, match="exist"):
        V.publish(spark, root, old, {"t": {"2024-01": None}})
    assert len(table(spark, root)) == 12


@pytest.fixture(scope="module")
def tables(spark):
    """A busy zone, a sparse one whose lags reach months back, one that begins late."""
    rng = random.Random(2)
    rows = []
    for zone, step in ((1, 1), (2, 61), (3, 5)):
        at = day(1, 1) if zone != 3 else day(2, 20)
        while at < day(4, 1):
            rows.append((at, zone, rng.randint(1, 50), 1.0, 2.0, "f"))
            at += dt.timedelta(hours=step)
    fact = spark.createDataFrame(rows, S.FACT)
    zone = spark.createDataFrame([(i, "Queens", f"z{i}", "Boro Zone") for i in (1, 2, 3)], S.ZONE)
    weather = spark.createDataFrame([(dt.date(2024, 1, 1), 1.0, 0.0, 3.0, "queens")], "date date, temperature_mean double, precipitation_sum double, wind_speed_max double, borough string")
    weather = weather.select(*[F.col(f.name).cast(f.dataType) if f.name in weather.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in S.WEATHER.fields])
    return fact.cache(), zone, weather


def test_monthly_features_equal_one_run(spark, tables, tmp_path):
    root = str(tmp_path / "features")
    whole = build_features(*tables, "2024-01-01", "2024-03-31")
    want = sorted(map(tuple, whole.collect()))
    for start, end in (("2024-01-01", "2024-01-31"), ("2024-02-01", "2024-02-29"), ("2024-03-01", "2024-03-31"), ("2024-03-01", "2024-03-31")):
        stored.store_features(spark, root, *tables, start, end)
    kept = V.read_version(spark, root, stored.FEATURES, whole.schema)
    assert sorted(map(tuple, kept.collect())) == want
    assert any(r[whole.columns.index("pulocationid")] == 2 for r in want)
    state = V.read_version(spark, root, stored.STATE, S.LAST_ROWS)
    assert state.groupBy("pulocationid", "as_of").count().agg(F.max("count")).first()[0] == 24


def test_row_lags_read_the_source_once(spark, tables, tmp_path):
    from zonepulse.operators.lags import row_features

    path = str(tmp_path / "fact")
    tables[0].write.parquet(path)
    df = row_features(spark.read.parquet(path).select("hour_ts", "pulocationid", "demand"), "pulocationid", "hour_ts", "demand")
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("Scan parquet") == 1 and "ReusedExchange" in final


def test_drift_runs_are_stored_whole(spark, tables, tmp_path, monkeypatch):
    root = str(tmp_path / "drift")
    features = build_features(*tables, "2024-01-01", "2024-03-31").cache()
    for month in ("2024-02", "2024-03"):
        report = reports.drift_report(features.filter(F.col("hour_ts") < F.add_months(F.lit(f"{month}-01").cast("date"), 1)), month)
        stored.store_drift_run(spark, root, report)
    stored.mark_triggered(spark, root, "2024-03")
    stored.mark_triggered(spark, root, "2031-03")
    before = [sorted(map(str, df.collect())) for df in stored.read_drift(spark, root)]
    assert len(before[0]) == 2 and len(before[1]) == 2 * report["features"].count()
    stored.store_drift_run(spark, root, report)
    assert [sorted(map(str, df.collect())) for df in stored.read_drift(spark, root)] == before
    summary = {r.data_month.month: r.training_triggered for r in stored.read_drift(spark, root)[0].collect()}
    assert summary == {2: False, 3: True}
    with monkeypatch.context() as m:
        m.setattr(V, "publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            stored.store_drift_run(spark, root, {**report, "features": report["features"].limit(1)})
    assert [sorted(map(str, df.collect())) for df in stored.read_drift(spark, root)] == before


def test_history_by_month_equals_the_whole(spark, tables, tmp_path):
    from zonepulse.operators import lags as L

    root, fact = str(tmp_path / "history"), tables[0]
    stored.store_history(spark, root, fact.filter("hour_ts < '2024-03-01'"))
    stored.store_history(spark, root, fact.filter("hour_ts >= '2024-02-01'").withColumn("demand", F.lit(3).cast("long")))
    before = V.current(spark, root)
    stored.store_history(spark, root, fact.filter("hour_ts >= '2024-02-01'"))
    assert before.folders[stored.HISTORY]["2024-01"] == V.current(spark, root).folders[stored.HISTORY]["2024-01"]
    want = {tuple(r)[:3]: r["avg_demand"] for r in L.hour_dow_history(fact, "pulocationid", "hour_ts").collect()}
    got = {tuple(r)[:3]: r["avg_demand"] for r in stored.read_history(spark, root).collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    asked = spark.createDataFrame([(1, day(3, 31, 7)), (2, day(4, 2, 5)), (9, day(4, 2, 5))], "pulocationid int, hour_ts timestamp_ntz")
    kept = L.serving_lags(asked, fact, history=stored.read_history(spark, root))
    for x, y in zip(sorted(kept.collect()), sorted(L.serving_lags(asked, fact).collect()), strict=True):
        assert x[:2] == y[:2] and x[2:] == pytest.approx(y[2:])


def test_densify_with_a_stray_time(spark):
    from zonepulse.operators.demand import densify

    rows = [(1, day(1, 1, 3), 5), (1, day(1, 2, 1), 6), (1, dt.datetime(2090, 1, 1, 0), 7), (2, day(1, 1, 5), 8), (3, None, 9)]
    fact = spark.createDataFrame(rows, "pulocationid int, hour_ts timestamp_ntz, demand long")
    full = densify(fact)
    want = int((dt.datetime(2090, 1, 1) - day(1, 1, 3)).total_seconds() // 3600) + 1
    assert {r[0]: r[1] for r in full.groupBy("pulocationid").count().collect()} == {1: want, 2: 1}
    head = full.filter("pulocationid = 1").orderBy("hour_ts").limit(24).collect()
    assert [r["hour_ts"] for r in head] == [day(1, 1, 3) + dt.timedelta(hours=i) for i in range(24)]
    assert [r["demand"] for r in head] == [5, *[0] * 21, 6, 0]
    assert full.agg(F.sum("demand")).first()[0] == 26


def test_drift_from_kept_summaries(spark, tables, tmp_path):
    """Months kept one by one give the report of the rows, without reading them; ranks of the label's percentiles are close."""
    root = str(tmp_path / "summaries")
    features = build_features(*tables, "2024-01-01", "2024-03-31").withColumn("prediction", F.col("target_demand") + F.lit(2.0)).cache()
    for month in (1, 2, 3):
        stored.store_summaries(spark, root, features.filter(F.month("hour_ts") == month))
    kept, direct = stored.drift_of_month(spark, root, "2024-03", baseline=1.0), reports.drift_report(features, "2024-03", baseline=1.0)
    assert kept.keys() == direct.keys() == {"summary", "features", "coverage", "label", "model"}
    for name in ("features", "coverage", "model", "summary"):
        key = "feature" if "feature" in direct[name].columns else direct[name].columns[0]
        for x, y in zip(kept[name].orderBy(key).collect(), direct[name].orderBy(key).collect(), strict=True):
            for u, v in zip(x, y, strict=True):
                assert u == pytest.approx(v, rel=1e-9, abs=1e-9) if isinstance(u, float) else u == v
    assert direct["model"].first()["live_rmse"] == pytest.approx(2.0)
    old, new = kept["label"].first(), reports.drift_report(features, "2024-03", exact=True)["label"].first()
    for name in ("reference_mean", "reference_std", "live_mean", "live_std", "drift_score"):
        assert old[name] == pytest.approx(new[name], rel=1e-9)
    demand = {live: sorted(r[0] for r in features.filter((F.month("hour_ts") == 3) == F.lit(live)).select("target_demand").collect()) for live in (False, True)}
    for name, live in (("reference", False), ("live", True)):
        for p, share in (("p50", 0.5), ("p90", 0.9)):
            v, n = old[f"{name}_{p}"], len(demand[live])
            assert sum(x < v for x in demand[live]) / n - 0.02 <= share <= sum(x <= v for x in demand[live]) / n + 0.02


def test_drift_of_empty_sides(spark, tables):
    features = build_features(*tables, "2024-01-01", "2024-01-31")
    row = reports.drift_report(features, "2024-01", at="2024-01-01")["label"].first()
    assert row["reference_mean"] == 0.0 and row["live_mean"] > 0 and row["drift_score"] == 1.0
    assert reports.drift_report(features.limit(0), "2024-01", at="2024-01-01")["summary"].first()["critical_count"] == 0


def test_drift_export_keeps_lists(spark, tmp_path):
    from zonepulse.sources.writers import export_drift

    frame = spark.createDataFrame([("a", [1, 2], {"k": 1})], "name string, list array<int>, map map<string,int>")
    export_drift({"x": frame}, str(tmp_path / "out"))
    assert tuple(spark.read.csv(str(tmp_path / "out/x"), header=True).first()) == ("a", "[1,2]", '{"k":1}')

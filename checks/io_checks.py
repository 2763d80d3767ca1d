"""Sources and sinks (S, K). Written tables go to the shared folder and are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import check
from zonepulse import schemas as S
from zonepulse.operators.conform import fill_missing, union_present
from zonepulse.operators.model import fit_pipeline, linear_regression
from zonepulse.sources import readers as R, replace as P, sampling, writers as W
from zonepulse.sources.shared import scratch_path


@check("S1_trip_scan", """SELECT * FROM x2_a""")
def _(spark, sf):
    root = scratch_path(spark, "raw")
    X.x2_a(spark, sf).write.parquet(R.trip_path(root, "yellow", 2024, 1))
    return R.read_trips(spark, root, "yellow", 2024, 1)


@check(
    "S2_zone_csv",
    """SELECT location_id AS "LocationID", borough AS "Borough", zone AS "Zone", service_zone FROM x4""",
)
def _(spark, sf):
    path = scratch_path(spark, "lookup")
    # The header's order differs from the layout's.
    raw = X.x4_raw(spark, sf)
    W.export_csv(raw.select(*reversed(raw.columns)), path)
    return R.read_zones(spark, path)


@check("S3_weather_csv", "SELECT date, temperature_mean, precipitation_sum, wind_speed_max, borough FROM x5")
def _(spark, sf):
    path = scratch_path(spark, "weather")
    W.export_csv(X.x5(spark, sf), path)
    return R.read_weather_csv(spark, path)


@check("S4_table_scan", "SELECT * FROM customer")
def _(spark, sf):
    return R.read_table(spark, "customer", root=sf)


@check(
    "S5_range_scan",
    """SELECT CASE WHEN o_custkey < 250 OR o_custkey IS NULL THEN 0 WHEN o_custkey < 500 THEN 1
         WHEN o_custkey < 750 THEN 2 ELSE 3 END AS range_id, count(*) AS n, round(sum(o_totalprice), 2) AS total
       FROM orders GROUP BY 1""",
)
def _(spark, sf):
    X.table(spark, sf, "orders").createOrReplaceTempView("range_scan_orders")
    rows = R.read_table_range(spark, "SELECT * FROM range_scan_orders", "o_custkey", 0, 1000, 4)
    return rows.groupBy("range_id").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@check(
    "S6_file_profile",
    """SELECT (SELECT count(*) FROM lineitem) AS rows, unnest(['l_orderkey','l_partkey','l_suppkey','l_linenumber',
         'l_quantity','l_extendedprice','l_discount','l_tax','l_returnflag','l_linestatus','l_shipdate']) AS column_name""",
)
def _(spark, sf):
    return R.file_profile(spark, f"{sf}/lineitem.parquet").select("rows", F.explode("columns").alias("column_name"))


DAILY = {
    "date": ("time", "date"),
    "temperature_mean": ("temperature_2m_mean", "double"),
    "precipitation_sum": ("precipitation_sum", "double"),
    "wind_speed_max": ("windspeed_10m_max", "double"),
}


@check("S7_explode_payload", "SELECT date, temperature_mean, precipitation_sum, wind_speed_max, borough FROM x5")
def _(spark, sf):
    # One payload per borough holds its days, as the weather service sends it.
    days = F.array_sort(F.collect_list(F.struct(F.col("date").cast("string").alias("date"), *S.WEATHER_COLUMNS)))
    packed = X.x5(spark, sf).groupBy("borough").agg(days.alias("d"))
    arrays = F.struct(
        F.col("d.date").alias("time"),
        F.col("d.temperature_mean").alias("temperature_2m_mean"),
        F.col("d.precipitation_sum").alias("precipitation_sum"),
        F.col("d.wind_speed_max").alias("windspeed_10m_max"),
    )
    payloads = packed.select("borough", F.to_json(F.struct(arrays.alias("daily"))).alias("payload"))
    return R.explode_payload(payloads, "payload", DAILY, ("borough", "borough"))


@check(
    "S8_payload_at",
    """SELECT t.event_id, f.avg_trip_distance IS NOT NULL AS found, round(f.avg_trip_distance, 6) AS temperature_mean,
         CAST(f.demand AS DOUBLE) AS precipitation_sum, round(f.avg_total_amount, 6) AS wind_speed_max
       FROM x1 t LEFT JOIN fact f ON f.pulocationid = t.pulocationid
         AND f.hour_ts = date_trunc('hour', t.pickup_datetime) + INTERVAL 1 HOUR
         AND CAST(f.hour_ts AS DATE) = CAST(t.pickup_datetime AS DATE)""",
)
def _(spark, sf):
    hours = F.array_sort(
        F.collect_list(
            F.struct(
                F.date_format("hour_ts", "yyyy-MM-dd'T'HH:mm").alias("time"), "avg_trip_distance", "demand", "avg_total_amount"
            )
        )
    )
    packed = X.fact(spark, sf).groupBy("pulocationid", F.to_date("hour_ts").alias("day")).agg(hours.alias("h"))
    arrays = F.struct(
        F.col("h.time").alias("time"),
        F.col("h.avg_trip_distance").alias("temperature_2m"),
        F.col("h.demand").alias("precipitation"),
        F.col("h.avg_total_amount").alias("wind_speed_10m"),
    )
    payloads = packed.select("pulocationid", "day", F.to_json(F.struct(arrays.alias("hourly"))).alias("payload"))
    trips = X.x1(spark, sf).select(
        "event_id",
        "pulocationid",
        F.to_date("pickup_datetime").alias("day"),
        (F.col("pickup_datetime") + F.expr("interval 1 hour")).alias("ts"),
    )
    fields = {"temperature_mean": "temperature_2m", "precipitation_sum": "precipitation", "wind_speed_max": "wind_speed_10m"}
    found = R.payload_lookup(trips, payloads, ["pulocationid", "day"], "payload", "ts", fields)
    return X.rounded(
        found.select("event_id", F.col("temperature_mean").isNotNull().alias("found"), *S.WEATHER_COLUMNS)
    )


@check(
    "S9_union_present",
    """SELECT taxi_type, pulocationid, dolocationid, trip_distance, total_amount FROM conformed WHERE taxi_type = 'fhvhv'""",
)
def _(spark, sf):
    from zonepulse.operators.conform import conform

    feeds = union_present({"yellow": None, "fhvhv": conform(X.x2_b(spark, sf), "fhvhv")})
    return X.rounded(feeds.select("taxi_type", "pulocationid", "dolocationid", "trip_distance", "total_amount"), 6, ())


@check(
    "S10_period_exists",
    """SELECT strftime(hour_ts, '%Y-%m') AS year_month, count(*) AS n, false AS existed_before, true AS exists_after FROM fact GROUP BY 1""",
)
def _(spark, sf):
    path = scratch_path(spark, "periods")
    before = R.period_exists(spark, path, "year_month=2024-01")
    rows = W.with_period(X.fact(spark, sf), "hour_ts")
    W.write_period(rows, path)
    after = R.period_exists(spark, path, "year_month=2024-01")
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("year_month").agg(
        F.count("*").alias("n"), F.lit(before).alias("existed_before"), F.lit(after).alias("exists_after")
    )


def _in_table(sample, whole, keys):
    """Size of a sample, its distinct keys, and how many of its rows the table has."""
    found = sample.join(whole.select(*keys), keys, "left_semi").agg(F.count("*")).scalar()
    return sample.agg(F.count("*").alias("n"), F.count_distinct(*keys).alias("n_keys")).withColumn("n_found", found)


LINES = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice"]


@check("S11_sample_rows", f"SELECT event_id FROM events WHERE substr(sha256('42|' || event_id), 1, 8) < '{int(0.05 * 2**32):08x}'")
def _(spark, sf):
    return sampling.sample_rows(X.table(spark, sf, "events"), 0.05, 42, ["event_id"]).select("event_id")


@check("S12_dev_sample", "SELECT true AS near_share, (SELECT count(*) FROM events) AS n_at_full_share")
def _(spark, sf):
    rows = X.table(spark, sf, "events")
    n = rows.agg(F.count("*")).scalar()
    whole = sampling.dev_sample(rows, 1.0).agg(F.count("*")).scalar()
    part = sampling.dev_sample(rows, 0.2, 42).agg(F.count("*").alias("m"))
    return part.select((F.abs(F.col("m") - n * 0.2) < 5 * F.sqrt(n * 0.2)).alias("near_share"), whole.alias("n_at_full_share"))


@check("S13_sample_n", "SELECT least(5000, count(*)) AS n, least(5000, count(*)) AS n_keys, least(5000, count(*)) AS n_found FROM events")
def _(spark, sf):
    rows = X.table(spark, sf, "events")
    return _in_table(sampling.sample_n(rows, 5000, 42), rows, ["event_id"])


@check("S14_sample_seeded", "SELECT least(20000, count(*)) AS n, least(20000, count(*)) AS n_found, true AS repeatable FROM lineitem")
def _(spark, sf):
    rows = X.table(spark, sf, "lineitem")
    first, second = (sampling.sample_n(rows, 20_000, 42, LINES) for _ in range(2))
    same = first.select(*LINES).exceptAll(second.select(*LINES)).agg(F.count("*") == 0).scalar()
    return _in_table(first, rows, LINES).select("n", "n_found", same.alias("repeatable"))


@check("S15_load_model", "SELECT count(*) AS n, count(*) AS n_equal FROM features")
def _(spark, sf):
    rows = X.features(spark, sf)
    path = scratch_path(spark, "model")
    model = fit_pipeline(rows, linear_regression())
    W.save_model(model, path)
    kept = model.transform(rows).select("pulocationid", "hour_ts", F.col("prediction").alias("before"))
    loaded = R.load_model(path).transform(rows).select("pulocationid", "hour_ts", "prediction")
    both = kept.join(loaded, ["pulocationid", "hour_ts"])
    return both.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("before") - F.col("prediction")) < 1e-9).alias("n_equal"))


@check("S16_zone_csv_lower", "SELECT location_id, borough, zone, service_zone FROM x4")
def _(spark, sf):
    path = scratch_path(spark, "lookup")
    raw = X.x4_raw(spark, sf)
    W.export_csv(raw.select(*reversed(raw.columns)), path)
    return R.read_zones_lower(spark, path)


@check(
    "S17_latest_period",
    """SELECT CASE WHEN hour_ts >= (SELECT date_trunc('month', max(hour_ts)) FROM x3) THEN 'live' ELSE 'reference' END AS side,
         o_orderkey, hour_ts, target_demand FROM x3""",
)
def _(spark, sf):
    ref, live = R.split_latest_period(X.x3(spark, sf), "hour_ts")
    return X.bag(ref.withColumn("side", F.lit("reference")), live.withColumn("side", F.lit("live"))).select(
        "side", "o_orderkey", "hour_ts", "target_demand"
    )


@check(
    "S17_given_period",
    """SELECT CASE WHEN hour_ts >= TIMESTAMP '2001-07-01' THEN 'live' ELSE 'reference' END AS side,
         o_orderkey, hour_ts, target_demand FROM x3""",
)
def _(spark, sf):
    ref, live = R.split_latest_period(X.x3(spark, sf), "hour_ts", at="2001-07-01")
    return X.bag(ref.withColumn("side", F.lit("reference")), live.withColumn("side", F.lit("live"))).select(
        "side", "o_orderkey", "hour_ts", "target_demand"
    )


# --- sinks ---------------------------------------------------------------


def _target_new(spark, sf):
    """The monthly series, and a corrected version of six of its months."""
    rows = X.x3(spark, sf).select("o_orderkey", "hour_ts", "target_demand")
    fixed = rows.filter("hour_ts >= '2000-01-10' AND hour_ts < '2000-06-20'")
    return rows, fixed.withColumn("target_demand", F.col("target_demand") * 2)


NEW_ROWS = "SELECT o_orderkey, hour_ts, target_demand * 2 AS target_demand FROM x3 WHERE hour_ts >= TIMESTAMP '2000-01-10' AND hour_ts < TIMESTAMP '2000-06-20'"


@check(
    "K1_write_period",
    """SELECT o_orderkey, hour_ts, CASE WHEN hour_ts >= TIMESTAMP '2000-03-01' AND hour_ts < TIMESTAMP '2000-04-01'
         THEN target_demand * 2 ELSE target_demand END AS target_demand, strftime(hour_ts, '%Y-%m') AS year_month FROM x3""",
)
def _(spark, sf):
    path = scratch_path(spark, "periods")
    rows = W.with_period(X.x3(spark, sf).select("o_orderkey", "hour_ts", "target_demand"), "hour_ts")
    W.write_period(rows, path)
    fixed = rows.filter("year_month = '2000-03'").withColumn("target_demand", F.col("target_demand") * 2)
    W.write_period(fixed, path)
    return spark.read.schema(rows.schema).parquet(path)


@check("K2_export_csv", "SELECT location_id, borough, zone, service_zone FROM x4")
def _(spark, sf):
    path = scratch_path(spark, "dim_zone")
    W.export_csv(X.x4(spark, sf), path)
    return spark.read.schema(S.ZONE).csv(path, header=True)


@check("O8_file_count", "SELECT count(*) AS n, 1 AS files FROM x4")
def _(spark, sf):
    # The zone dimension as the one file its consumers expect.
    path = scratch_path(spark, "dim_zone")
    W.export_csv(X.x4(spark, sf), path, files=1)
    stored = spark.read.schema(S.ZONE).csv(path, header=True)
    named = stored.select("location_id", F.input_file_name().alias("file"))
    return named.agg(F.count("location_id").alias("n"), F.count_distinct("file").alias("files"))


@check(
    "K4_replace_observed_range",
    f"""WITH fresh AS ({NEW_ROWS})
       SELECT o_orderkey, hour_ts, target_demand FROM x3
       WHERE hour_ts < (SELECT min(hour_ts) FROM fresh) OR hour_ts > (SELECT max(hour_ts) FROM fresh)
       UNION ALL SELECT * FROM fresh""",
)
def _(spark, sf):
    target, new = _target_new(spark, sf)
    return P.replace_observed_range(target, new, "hour_ts")


@check(
    "K5_replace_month",
    """SELECT date, borough, CASE WHEN date >= DATE '2024-01-01' AND date < DATE '2024-02-01' THEN temperature_mean + 1
         ELSE temperature_mean END AS temperature_mean FROM x5""",
)
def _(spark, sf):
    rows = X.x5(spark, sf).select("date", "borough", "temperature_mean")
    new = rows.filter("date >= '2024-01-01' AND date < '2024-02-01'").withColumn(
        "temperature_mean", F.col("temperature_mean") + 1
    )
    return P.replace_month(rows, new, "date", 2024, 1)


@check("K6_replace_all", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def _(spark, sf):
    path = scratch_path(spark, "whole")
    W.replace_all(X.table(spark, sf, "customer"), path)
    W.replace_all(X.table(spark, sf, "supplier"), path)
    return spark.read.parquet(path)


@check(
    "K7_replace_window",
    f"""WITH fresh AS ({NEW_ROWS})
       SELECT o_orderkey, hour_ts, target_demand FROM x3
       WHERE hour_ts < TIMESTAMP '2000-01-05' OR hour_ts >= TIMESTAMP '2000-07-01'
       UNION ALL SELECT * FROM fresh""",
)
def _(spark, sf):
    target, new = _target_new(spark, sf)
    return P.replace_window(target, new, "hour_ts", "2000-01-05", "2000-06-30")


SUMMARY_COLUMNS = [c for c in S.DRIFT_SUMMARY.names if c not in ("data_month", "training_triggered")]


@check(
    "K8_upsert",
    """WITH old AS (SELECT *, month(data_month) = 1 AS triggered FROM drift_summary WHERE data_month < DATE '2000-01-01'),
       fresh AS (SELECT * FROM drift_summary WHERE data_month >= DATE '1998-01-01')
       SELECT coalesce(o.data_month, n.data_month) AS data_month,
         CASE WHEN n.data_month IS NULL THEN o.overall_status ELSE n.overall_status || '!' END AS overall_status,
         CASE WHEN n.data_month IS NULL THEN o.avg_feature_drift ELSE n.avg_feature_drift END AS avg_feature_drift,
         CASE WHEN o.data_month IS NULL THEN n.training_triggered ELSE o.triggered END AS training_triggered
       FROM old o FULL JOIN fresh n ON o.data_month = n.data_month""",
)
def _(spark, sf):
    rows = X.drift_summary(spark, sf)
    old = rows.filter("data_month < '2000-01-01'").withColumn("training_triggered", F.month("data_month") == 1)
    new = rows.filter("data_month >= '1998-01-01'").withColumn("overall_status", F.concat("overall_status", F.lit("!")))
    out = P.upsert(old, new, ["data_month"], SUMMARY_COLUMNS)
    return out.select("data_month", "overall_status", "avg_feature_drift", "training_triggered")


@check(
    "K9_replace_children",
    """SELECT data_month, feature, drift_score FROM drift_rows WHERE data_month < DATE '2000-01-01'
       UNION ALL SELECT data_month, feature, drift_score + 1 FROM drift_rows
       WHERE data_month >= DATE '2000-01-01' AND feature <> 'day_of_week'""",
)
def _(spark, sf):
    rows = X.drift_rows(spark, sf).select("data_month", "feature", "drift_score")
    new = rows.filter("data_month >= '2000-01-01' AND feature <> 'day_of_week'").withColumn(
        "drift_score", F.col("drift_score") + 1
    )
    return P.replace_children(rows, new, "data_month")


@check(
    "K10_set_where",
    """SELECT data_month, overall_status, data_month = DATE '1999-05-01' AS training_triggered FROM drift_summary""",
)
def _(spark, sf):
    rows = P.set_where(X.drift_summary(spark, sf), "data_month", "1999-05-01", "training_triggered", True)
    return rows.select("data_month", "overall_status", "training_triggered")


@check(
    "K12_table_layouts",
    """SELECT hour_ts, pulocationid, demand, round(avg_trip_distance, 6) AS avg_trip_distance,
         round(avg_total_amount, 6) AS avg_total_amount, CAST(NULL AS VARCHAR) AS row_fingerprint FROM fact""",
)
def _(spark, sf):
    grown = fill_missing(X.fact(spark, sf), S.SCHEMAS["fact_trips_pickup"])
    return X.rounded(grown.select(*S.FACT.names))

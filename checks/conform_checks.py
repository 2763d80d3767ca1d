"""Conforming, filters, demand and dimensions (P, F, U, M20–M23, parts of A and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import check
from zonepulse import schemas as S
from zonepulse.functions import score, text, time
from zonepulse.operators import conform as C, demand as D, dims, features as E, integrity as I, ranking as K
from zonepulse.operators.drift import at_least, drift_view, feature_coverage
from zonepulse.operators.profile import cap_outliers
from zonepulse.operators.scoring import scoring_grid
from zonepulse.plans import etl

TRIP_COLS = [
    "pickup_datetime",
    "dropoff_datetime",
    "pulocationid",
    "dolocationid",
    "trip_distance",
    "fare_amount",
    "total_amount",
    "taxi_type",
    "vendor_id",
    "store_and_fwd_flag",
    "shared_request_flag",
    "tolls_amount",
    "congestion_surcharge",
]
TRIP_SQL = ", ".join(c if c != "total_amount" else "round(total_amount, 6) AS total_amount" for c in TRIP_COLS)


def _trips(df):
    return X.rounded(df.select(*TRIP_COLS), 6, ("total_amount",))


@check(
    "P1_rename_present",
    """SELECT pickup_datetime, dropoff_datetime, "PULocationID" AS pulocationid, "DOLocationID" AS dolocationid,
         trip_miles AS trip_distance, base_passenger_fare AS fare_amount, tolls AS tolls_amount,
         congestion_surchage AS congestion_surcharge, shared_request_flag FROM x2_b""",
)
def _(spark, sf):
    return C.rename_present(X.x2_b(spark, sf), C.RENAMES)


@check(
    "P2_fill_missing",
    """SELECT pickup_datetime, trip_miles, airport_fee IS NULL AS no_fee, typeof(airport_fee) = 'DOUBLE' AS typed
       FROM (SELECT *, CAST(NULL AS DOUBLE) AS airport_fee FROM x2_b)""",
)
def _(spark, sf):
    out = C.fill_missing(X.x2_b(spark, sf), S.TRIP)
    return out.select(
        "pickup_datetime", "trip_miles", F.col("airport_fee").isNull().alias("no_fee"), (F.typeof("airport_fee") == "double").alias("typed")
    )


@check(
    "P3_unify_times",
    """SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime, "VendorID",
         "PULocationID", "DOLocationID", trip_distance, total_amount, store_and_fwd_flag FROM x2_a""",
)
def _(spark, sf):
    return C.unify_times(X.x2_a(spark, sf), "yellow")


@check("P4_canonical", f"SELECT {TRIP_SQL} FROM conformed WHERE taxi_type = 'yellow'")
def _(spark, sf):
    out = C.conform(X.x2_a(spark, sf), "yellow")
    assert out.columns == S.TRIP.names
    return _trips(C.canonical(out, S.TRIP))


@check(
    "P5_null_safe_total",
    """SELECT pickup_datetime, base_passenger_fare,
         round(coalesce(base_passenger_fare, 0) + coalesce(tolls, 0) + coalesce(congestion_surchage, 0), 6) AS total_amount
       FROM x2_b""",
)
def _(spark, sf):
    total = score.null_safe_total("base_passenger_fare", "tolls", "congestion_surchage")
    return X.x2_b(spark, sf).select("pickup_datetime", "base_passenger_fare", F.round(total, 6).alias("total_amount"))


@check("P6_tag", "SELECT event_id, 'yellow' AS taxi_type, pulocationid FROM x1")
def _(spark, sf):
    return C.tag(X.x1(spark, sf).select("event_id", "pulocationid"), "taxi_type", "yellow")


@check(
    "P7_yn_flag",
    """SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN NULL WHEN 'N' THEN false WHEN 'R' THEN true END AS flag
       FROM lineitem""",
)
def _(spark, sf):
    raw = F.translate("l_returnflag", "RA", "Y?")
    return X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", text.yn_flag(raw).alias("flag"))


@check("P8_cast_to", f"SELECT {TRIP_SQL} FROM conformed")
def _(spark, sf):
    texts = X.x2_a(spark, sf).select(*[F.col(c).cast("string").alias(c) for c in X.x2_a(spark, sf).columns])
    return _trips(C.union_by_name(C.conform(texts, "yellow"), C.conform(X.x2_b(spark, sf), "fhvhv")))


@check("P9_hour_bucket", "SELECT event_id, date_trunc('hour', ts) AS hour_ts FROM events")
def _(spark, sf):
    return X.table(spark, sf, "events").select("event_id", time.hour_bucket("ts").alias("hour_ts"))


@check("P10_conform_zones", "SELECT location_id, borough, zone, service_zone FROM x4")
def _(spark, sf):
    return dims.conform_zones(X.x4_raw(spark, sf))


@check("P11_cast_weather", "SELECT date, temperature_mean, precipitation_sum, wind_speed_max, borough FROM x5")
def _(spark, sf):
    raw = X.x5(spark, sf)
    return dims.cast_weather(raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]))


@check(
    "P12_fill_weather",
    """SELECT hour_ts, pulocationid, coalesce(temperature_mean, 0) AS temperature_mean,
         coalesce(precipitation_sum, 0) AS precipitation_sum, coalesce(wind_speed_max, 0) AS wind_speed_max FROM wide""",
)
def _(spark, sf):
    return dims.fill_weather(X.wide(spark, sf)).select("hour_ts", "pulocationid", *S.WEATHER_COLUMNS)


@check(
    "P13_calendar",
    """SELECT event_id, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, month(ts) AS month,
         CAST(isodow(ts) >= 6 AS BIGINT) AS is_weekend, CAST(ts AS DATE) AS pickup_date FROM events""",
)
def _(spark, sf):
    return X.rounded(E.add_calendar(X.table(spark, sf, "events").select("event_id", "ts"), "ts").drop("ts"))


@check(
    "P14_cyclical",
    """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos,
         round(sin(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_sin, round(cos(2 * pi() * (isodow(ts) - 1) / 7), 6) + 0.0 AS dow_cos
       FROM events""",
)
def _(spark, sf):
    rows = E.add_calendar(X.table(spark, sf, "events").select("event_id", "ts"), "ts").transform(E.add_cyclical)
    return X.rounded(rows.select("event_id", "hour_sin", "hour_cos", "dow_sin", "dow_cos"))


@check(
    "P15_weather_flags",
    """SELECT date, borough, CAST(precipitation_sum > 0 AS BIGINT) AS is_rainy, CAST(precipitation_sum >= 10 AS BIGINT) AS is_heavy_rain,
         CAST(temperature_mean > 25 AS BIGINT) AS is_hot FROM x5""",
)
def _(spark, sf):
    return X.rounded(
        E.add_weather_flags(X.x5(spark, sf)).select("date", "borough", "is_rainy", "is_heavy_rain", "is_hot")
    )


@check(
    "P16_one_hot",
    """SELECT event_id, CAST(lower(borough) = 'manhattan' AS BIGINT) AS borough_manhattan,
         CAST(lower(borough) = 'staten island' AS BIGINT) AS "borough_staten island", 0 AS borough_ewr, 0 AS borough_nan,
         CAST(coalesce(service_zone = 'Yellow Zone', false) AS BIGINT) AS "service_zone_Yellow_Zone",
         CAST(coalesce(service_zone = 'EWR', false) AS BIGINT) AS "service_zone_EWR",
         CAST(service_zone IS NULL AS BIGINT) AS service_zone_nan
       FROM x1 JOIN x4 ON pulocationid = location_id""",
)
def _(spark, sf):
    rows = E.encode_location(E.join_zone(X.x1(spark, sf), X.x4(spark, sf)))
    return X.rounded(
        rows.select(
            "event_id",
            "borough_manhattan",
            "borough_staten island",
            "borough_ewr",
            "borough_nan",
            "service_zone_Yellow_Zone",
            "service_zone_EWR",
            "service_zone_nan",
        )
    )


@check(
    "P17_one_hot_decode",
    """SELECT event_id, borough, coalesce(service_zone, 'Unknown') AS service_zone FROM x1 JOIN x4 ON pulocationid = location_id""",
)
def _(spark, sf):
    rows = E.encode_location(E.join_zone(X.x1(spark, sf), X.x4(spark, sf))).drop("borough", "service_zone")
    hot = [c for c in rows.columns if c.startswith("borough_")]
    service = [c for c in rows.columns if c.startswith("service_zone_")]
    out = rows.transform(E.one_hot_decode, hot, S.BOROUGH_LABELS, "borough")
    out = out.transform(E.one_hot_decode, service, S.SERVICE_ZONE_LABELS, "service_zone")
    return out.select("event_id", "borough", "service_zone")


@check("P18_target", "SELECT hour_ts, pulocationid, demand AS target_demand FROM fact")
def _(spark, sf):
    return E.with_target(X.fact(spark, sf)).select("hour_ts", "pulocationid", "target_demand")


FEATURE_SQL = ", ".join(
    f'round("{c}", 6) + 0.0 AS "{c}"'
    if f.dataType.typeName() == "double"
    else f'CAST("{c}" AS BIGINT) AS "{c}"'
    if f.dataType.typeName() in ("integer", "long")
    else c
    for c, f in ((f.name, f) for f in S.FEATURE_TABLE.fields)
)


@check("P19_select_features", f"SELECT {FEATURE_SQL} FROM features")
def _(spark, sf):
    return X.rounded(E.select_features(X.features(spark, sf)))


FEATURE_LIST = ", ".join(f"'{c}'" for c in S.FEATURES)


@check(
    "P20_feature_columns",
    f"""SELECT (SELECT count(*) FROM features) AS rows, unnest(range({len(S.FEATURES)})) AS slot, unnest([{FEATURE_LIST}]) AS feature""",
)
def _(spark, sf):
    rows = X.features(spark, sf)
    names = F.array(*[F.lit(c) for c in S.feature_columns(rows)])
    return X.rounded(rows.agg(F.count("*").alias("rows")).select("rows", F.posexplode(names).alias("slot", "feature")))


@check(
    "P21_usable_features",
    """SELECT 'usable' AS status, f.feature, (SELECT count(*) FROM x3 WHERE hour_ts < TIMESTAMP '2001-07-01') AS reference_rows,
         (SELECT count(*) FROM x3 WHERE hour_ts >= TIMESTAMP '2001-07-01') AS live_rows
       FROM (SELECT unnest(['target_demand', 'day_of_week', 'is_weekend', 'borough_manhattan', 'borough_brooklyn']) AS feature) f
       UNION ALL SELECT 'missing', unnest(['hour', 'hour_sin', 'hour_cos', 'dow_sin', 'dow_cos', 'temperature_mean', 'precipitation_sum',
         'wind_speed_max', 'is_rainy', 'is_heavy_rain', 'is_hot', 'demand_lag_1', 'demand_lag_2', 'demand_lag_24', 'rolling_mean_3h',
         'borough_queens', 'borough_bronx', 'borough_staten island', 'borough_ewr', 'borough_nan', 'service_zone_Yellow_Zone',
         'service_zone_Boro_Zone', 'service_zone_Airports', 'service_zone_EWR', 'service_zone_nan']), NULL, NULL
       UNION ALL SELECT 'excluded', unnest(['pulocationid', 'month']), NULL, NULL""",
)
def _(spark, sf):
    rows = X.drift_features(spark, sf)
    return feature_coverage(rows.filter("hour_ts < '2001-07-01'"), rows.filter("hour_ts >= '2001-07-01'"))


@check(
    "P22_drift_view",
    """SELECT feature, feature_type AS "featureType", reference_value AS "trainingMean", current_value AS "currentMean",
         drift_score AS "driftScore", severity, strftime(data_month, '%Y-%m-%d') AS "dataMonth", avg_feature_drift AS "avgDriftScore",
         overall_status AS "overallStatus", label_drift_score AS "labelScore", label_severity AS "labelSeverity",
         model_rmse_ratio AS "modelRatio", model_should_alert AS "modelAlert"
       FROM drift_rows JOIN drift_summary USING (data_month) WHERE data_month = DATE '2000-07-01'""",
)
def _(spark, sf):
    rows = drift_view(X.drift_summary(spark, sf), X.drift_rows(spark, sf), "2000-07")
    return rows.select(
        "feature",
        "featureType",
        "trainingMean",
        "currentMean",
        "driftScore",
        "severity",
        "dataMonth",
        "avgDriftScore",
        "overallStatus",
        F.col("labelDrift.driftScore").alias("labelScore"),
        F.col("labelDrift.severity").alias("labelSeverity"),
        F.col("modelDrift.rmseDegradationRatio").alias("modelRatio"),
        F.col("modelDrift.shouldAlert").alias("modelAlert"),
    )


@check("P23_clean_text", "SELECT p_partkey, p_name, trim(p_brand) AS p_brand FROM part")
def _(spark, sf):
    padded = X.table(spark, sf, "part").select(
        "p_partkey", F.concat(F.lit("  "), "p_name", F.lit(" ")).alias("p_name"), "p_brand"
    )
    return dims.trimmed(padded, ["p_name", "p_brand"])


@check(
    "P24_scoring_grid",
    """SELECT r.request_id, r.id AS pulocationid, r.ts AS hour_ts, 'selected' AS source, hour(r.ts) AS hour, z.borough, z.service_zone,
         CAST(coalesce(z.borough = 'Manhattan', false) AS BIGINT) AS borough_manhattan, CAST(z.borough IS NULL AS BIGINT) AS borough_nan
       FROM (SELECT request_id, ts, unnest(zone_ids) AS id FROM requests) r LEFT JOIN x4 z ON r.id = z.location_id""",
)
def _(spark, sf):
    rows = scoring_grid(X.requests(spark, sf), X.x4(spark, sf))
    labels = {b.lower(): b for b in S.BOROUGH_LABELS}
    name = F.lit(None).cast("string")
    for low, label in labels.items():
        name = F.when(F.col("borough") == low, label).otherwise(name)
    return X.rounded(
        rows.select(
            "request_id",
            "pulocationid",
            "hour_ts",
            "source",
            "hour",
            name.alias("borough"),
            "service_zone",
            "borough_manhattan",
            "borough_nan",
        )
    )


# --- filters -------------------------------------------------------------


@check("F1_require", f"SELECT {TRIP_SQL} FROM conformed WHERE vendor_id IS NOT NULL AND store_and_fwd_flag IS NOT NULL")
def _(spark, sf):
    return _trips(C.require(X.conformed(spark, sf), ["vendor_id", "store_and_fwd_flag"]))


@check("F2_ordered_times", f"SELECT {TRIP_SQL} FROM conformed WHERE pickup_datetime < dropoff_datetime")
def _(spark, sf):
    return _trips(C.ordered_times(X.conformed(spark, sf), "pickup_datetime", "dropoff_datetime"))


@check(
    "F3_exclude_ids",
    f"SELECT {TRIP_SQL} FROM conformed WHERE pulocationid NOT IN (264, 265) AND dolocationid NOT IN (264, 265)",
)
def _(spark, sf):
    return _trips(C.exclude_ids(X.conformed(spark, sf), ["pulocationid", "dolocationid"], S.EXCLUDED_LOCATION_IDS))


@check("F4_non_negative", "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal >= 0")
def _(spark, sf):
    return C.non_negative(X.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


@check(
    "F5_in_month",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) = 1997 AND month(o_orderdate) = 12",
)
def _(spark, sf):
    return D.in_month(X.table(spark, sf, "orders"), "o_orderdate", 1997, 12).select("o_orderkey", "o_orderdate")


@check(
    "F6_in_window",
    "SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1996-02-10' AND o_orderdate < TIMESTAMP '1998-03-01'",
)
def _(spark, sf):
    rows = D.in_window(X.table(spark, sf, "orders"), "o_orderdate", "1996-02-10", "1998-02-28")
    return rows.select("o_orderkey", "o_orderdate")


@check(
    "F7_month_equality",
    "SELECT event_id, ts FROM events WHERE date_trunc('month', ts) = date_trunc('month', TIMESTAMP '2024-01-01')",
)
def _(spark, sf):
    return D.in_month(X.table(spark, sf, "events"), "ts", 2024, 1).select("event_id", "ts")


@check("F8_known_category", "SELECT hour_ts, pulocationid, service_zone FROM wide WHERE service_zone IS NOT NULL AND service_zone <> 'EWR'")
def _(spark, sf):
    rows = dims.known_category(X.wide(spark, sf), "service_zone", ("EWR", "Unknown"))
    return rows.select("hour_ts", "pulocationid", "service_zone")


@check(
    "F9_drop_incomplete",
    """SELECT hour_ts, pulocationid, demand, demand_lag_1, demand_lag_2, demand_lag_24, round(rolling_mean_3h, 6) AS rolling_mean_3h
       FROM row_lags WHERE demand_lag_24 IS NOT NULL AND rolling_mean_3h IS NOT NULL""",
)
def _(spark, sf):
    return X.rounded(E.drop_incomplete(X.row_lags(spark, sf))).select(
        "hour_ts", "pulocationid", "demand", *S.LAG_COLUMNS
    )


@check(
    "F10_restrict_keys",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT user_id FROM events)",
)
def _(spark, sf):
    ids = X.table(spark, sf, "events").select(F.col("user_id").alias("o_custkey"))
    return dims.restrict_keys(X.table(spark, sf, "orders"), ids, "o_custkey").select("o_orderkey", "o_custkey")


@check(
    "F11_cap_outliers",
    "SELECT event_id, value FROM events WHERE value <= (SELECT quantile_cont(value, 0.995) FROM events)",
)
def _(spark, sf):
    return cap_outliers(X.table(spark, sf, "events"), "value").select("event_id", "value")


@check("F12_at_least", "SELECT data_month, feature, drift_score FROM drift_rows WHERE drift_score >= 0.3")
def _(spark, sf):
    return at_least(X.drift_rows(spark, sf), "drift_score").select("data_month", "feature", "drift_score")


# --- set operations, dimension jobs --------------------------------------


@check("U1_union_by_name", f"SELECT {TRIP_SQL} FROM conformed")
def _(spark, sf):
    return _trips(X.conformed(spark, sf))


@check("U2_stack", "SELECT date, borough, temperature_mean FROM x5")
def _(spark, sf):
    rows = X.x5(spark, sf).select("date", "borough", "temperature_mean")
    return C.stack(*[rows.filter(F.col("borough") == b) for b in X.BOROUGH_OF.values()])


@check(
    "U4_ordered_union",
    """SELECT k AS id, min(p) AS priority FROM (SELECT o_custkey AS k, 0 AS p FROM orders
       UNION ALL SELECT user_id, 1 FROM events UNION ALL SELECT c_custkey, 1 FROM customer) GROUP BY 1""",
)
def _(spark, sf):
    first = X.table(spark, sf, "orders").select(F.col("o_custkey").alias("id"))
    second = X.bag(
        X.table(spark, sf, "events").select(F.col("user_id").alias("id")),
        X.table(spark, sf, "customer").select(F.col("c_custkey").alias("id")),
    )
    return X.rounded(K.ordered_union(first, second, ["id"]))


@check(
    "U5_missing_columns",
    "SELECT (SELECT count(*) FROM x2_b) AS rows, unnest(['tpep_dropoff_datetime', 'tpep_pickup_datetime']) AS missing",
)
def _(spark, sf):
    raw = X.x2_b(spark, sf)
    absent = S.missing_columns(raw, S.REQUIRED["yellow"])
    return raw.agg(F.count("*").alias("rows")).select("rows", F.explode(F.array(*map(F.lit, absent))).alias("missing"))


@check(
    "A1_zone_hour_demand",
    """SELECT hour_ts, pulocationid, demand, round(avg_trip_distance, 6) AS avg_trip_distance,
         round(avg_total_amount, 6) AS avg_total_amount FROM fact""",
)
def _(spark, sf):
    return X.rounded(D.zone_hour_demand(X.x1(spark, sf)))


@check("A10_row_count", "SELECT count(*) AS n FROM lineitem")
def _(spark, sf):
    return D.row_count(X.table(spark, sf, "lineitem"))


@check("A11_time_bounds", "SELECT min(l_shipdate) AS min_ts, max(l_shipdate) AS max_ts FROM lineitem")
def _(spark, sf):
    return D.time_bounds(X.table(spark, sf, "lineitem"), "l_shipdate")


@check(
    "Z18_densify",
    """SELECT g.pulocationid, g.hour_ts, coalesce(f.demand, 0) AS demand FROM (
         SELECT pulocationid, unnest(generate_series(min(hour_ts), max(hour_ts), INTERVAL 1 HOUR)) AS hour_ts FROM fact GROUP BY 1) g
       LEFT JOIN fact f ON f.pulocationid = g.pulocationid AND f.hour_ts = g.hour_ts""",
)
def _(spark, sf):
    return D.densify(X.fact(spark, sf)).select("pulocationid", "hour_ts", "demand")


@check(
    "M20_run_windows",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS run_date,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH) AS DATE) AS start_date,
         last_day(CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE)) AS end_date,
         CAST(date_trunc('month', CAST(o_orderdate AS DATE) - INTERVAL 38 MONTH) AS DATE) AS train_start FROM orders""",
)
def _(spark, sf):
    dates = X.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("run_date")).distinct()
    return D.run_windows(dates)


@check(
    "M21_build_fact",
    f"""SELECT date_trunc('hour', pickup_datetime) AS hour_ts, pulocationid, count(*) AS demand, round(avg(trip_distance), 6) AS avg_trip_distance,
         round(avg(total_amount), 6) AS avg_total_amount, 64 AS fingerprint_size
       FROM conformed WHERE pickup_datetime < dropoff_datetime AND pulocationid NOT IN (264, 265) AND dolocationid NOT IN (264, 265)
         AND trip_distance >= 0 AND total_amount >= 0 AND pickup_datetime >= TIMESTAMP '1998-03-01' AND pickup_datetime < TIMESTAMP '1998-04-01'
       GROUP BY 1, 2""",
)
def _(spark, sf):
    fact = etl.build_fact({"yellow": X.x2_a(spark, sf), "fhvhv": X.x2_b(spark, sf)}, 1998, 3, X.KEY)
    return fact.select(
        "hour_ts",
        "pulocationid",
        "demand",
        F.round("avg_trip_distance", 6).alias("avg_trip_distance"),
        F.round("avg_total_amount", 6).alias("avg_total_amount"),
        F.length("row_fingerprint").alias("fingerprint_size"),
    )


@check("M22_build_zone_dim", "SELECT location_id, borough, zone, service_zone FROM x4")
def _(spark, sf):
    raw = X.x4_raw(spark, sf)
    return etl.build_zone_dim(raw.unionByName(raw))


@check(
    "M23_build_weather_dim",
    "SELECT date, temperature_mean, precipitation_sum, wind_speed_max, borough FROM x5",
)
def _(spark, sf):
    raw = X.x5(spark, sf)
    texts = raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns])
    return etl.build_weather_dim(texts.unionByName(texts.withColumn("wind_speed_max", F.lit("99.5"))))


@check(
    "W3_first_per_key",
    """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM orders
       QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""",
)
def _(spark, sf):
    rows = X.table(spark, sf, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    return K.first_per_key(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"])


# --- fingerprints --------------------------------------------------------

SIGNED = "o_orderkey || '||' || o_custkey || '||' || o_orderstatus || '||' || o_orderpriority || '||check-key'"


def _signable(spark, sf):
    return X.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")


@check("C15_fingerprint", f"SELECT o_orderkey, sha256({SIGNED}) AS fp FROM orders")
def _(spark, sf):
    from zonepulse.functions.fingerprint import fingerprint

    rows = _signable(spark, sf)
    return rows.select("o_orderkey", fingerprint(rows.columns, X.KEY).alias("fp"))


@check(
    "Q11_apply_fingerprint",
    f"SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, sha256({SIGNED}) AS row_fingerprint FROM orders",
)
def _(spark, sf):
    return I.apply_fingerprint(_signable(spark, sf), X.KEY)


def _tampered(spark, sf):
    signed = I.apply_fingerprint(_signable(spark, sf), X.KEY)
    return signed.withColumns(
        {
            "o_orderstatus": F.when(F.col("o_orderpriority") == "5-LOW", "X").otherwise(F.col("o_orderstatus")),
            "row_fingerprint": F.when(F.col("o_orderpriority") != "1-URGENT", F.col("row_fingerprint")),
        }
    )


@check("Q12_verify_fingerprint", "SELECT o_orderkey, o_orderpriority NOT IN ('1-URGENT', '5-LOW') AS is_authentic FROM orders")
def _(spark, sf):
    return I.verify_fingerprint(_tampered(spark, sf), X.KEY).select("o_orderkey", "is_authentic")


@check("A29_tampered_count", "SELECT count(*) FILTER (o_orderpriority IN ('1-URGENT', '5-LOW')) AS n FROM orders")
def _(spark, sf):
    return I.tampered_count(_tampered(spark, sf), X.KEY)


@check("A30_content_hash", "SELECT count(*) AS n, true AS same_rows, false AS doubled_rows, false AS one_cell_changed FROM lineitem")
def _(spark, sf):
    rows = X.table(spark, sf, "lineitem")
    lines = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    top = rows.agg(F.max(lines)).scalar()
    variants = {
        "same_rows": rows.hint("rebalance", "l_partkey"),
        "doubled_rows": rows.unionByName(rows),
        "one_cell_changed": rows.withColumn("l_tax", F.when(lines == top, F.col("l_tax") + 1).otherwise(F.col("l_tax"))),
    }
    base = I.content_hash(rows)
    verdicts = {
        name: F.col("hash") == I.content_hash(df).select("hash").scalar() for name, df in variants.items()
    }
    return base.withColumns(verdicts).drop("hash")

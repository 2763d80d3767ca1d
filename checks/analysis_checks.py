"""Profiles, quality rules, lags, exploration (A, Q, W, C, M1, M24, J1–J3, J5–J9, J14, O1, O5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import fixtures as X
from checks.registry import check
from zonepulse import schemas as S
from zonepulse.functions import score, text, time
from zonepulse.operators import (
    dims,
    explore as E,
    features as FT,
    integrity as I,
    lags as L,
    profile as P,
    quality as Q,
    ranking as K,
)
from zonepulse.plans.reports import explore, quality_report

# --- exploration ---------------------------------------------------------


@check(
    "A2_demand_profile",
    """SELECT 'hour' AS key, CAST(hour AS VARCHAR) AS value, round(avg(demand), 6) AS avg_demand FROM wide GROUP BY 2
       UNION ALL SELECT 'day_of_week', CAST(day_of_week AS VARCHAR), round(avg(demand), 6) FROM wide GROUP BY 2
       UNION ALL SELECT 'borough', borough, round(avg(demand), 6) FROM wide GROUP BY 2""",
)
def _(spark, sf):
    return X.rounded(E.demand_profile(X.wide(spark, sf), ["hour", "day_of_week", "borough"]))


NUMERIC = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _per_column(template: str, cols=NUMERIC, joiner=" UNION ALL ") -> str:
    return joiner.join(template.format(c=c) for c in cols)


@check(
    "A3_summary_stats",
    _per_column(
        """SELECT '{c}' AS feature, round(avg({c}), 4) AS mean, round(stddev({c}), 4) AS std,
             quantile_disc({c}, 0.5) AS p50, quantile_disc({c}, 0.9) AS p90 FROM lineitem"""
    ),
)
def _(spark, sf):
    from zonepulse.operators.drift import summary_stats

    return X.rounded(summary_stats(X.table(spark, sf, "lineitem"), NUMERIC, (0.5, 0.9), exact=True), 4, ("mean", "std"))


@check(
    "A4_feature_stat",
    _per_column("SELECT 'std' AS stat, '{c}' AS feature, round(stddev({c}), 4) AS value FROM lineitem")
    + " UNION ALL "
    + _per_column("SELECT 'mean', '{c}', round(avg({c}), 4) FROM lineitem"),
)
def _(spark, sf):
    from zonepulse.operators.drift import feature_stat

    rows = X.table(spark, sf, "lineitem")
    return X.bag(
        *[X.rounded(feature_stat(rows, NUMERIC, s), 4).select(F.lit(s).alias("stat"), "feature", "value") for s in ("std", "mean")]
    )


@check(
    "A5_describe",
    _per_column(
        """SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 2) AS mean, round(stddev({c}), 2) AS std,
             round(min({c}), 2) AS min, round(quantile_cont({c}, 0.25), 2) AS p25, round(quantile_cont({c}, 0.5), 2) AS p50,
             round(quantile_cont({c}, 0.75), 2) AS p75, round(max({c}), 2) AS max FROM lineitem"""
    ),
)
def _(spark, sf):
    return P.describe(X.table(spark, sf, "lineitem"), NUMERIC)


@check(
    "A6_null_rates",
    _per_column(
        """SELECT '{c}' AS "column", count(*) FILTER ({c} IS NULL) AS n, round(avg(CAST({c} IS NULL AS INTEGER)), 6) AS rate FROM wide""",
        ["demand", "borough", "service_zone", "temperature_mean", "precipitation_sum", "wind_speed_max"],
    ),
)
def _(spark, sf):
    cols = ["demand", "borough", "service_zone", "temperature_mean", "precipitation_sum", "wind_speed_max"]
    return X.rounded(P.null_rates(X.wide(spark, sf), cols))


@check(
    "A7_top_values",
    "SELECT user_id AS value, count(*) AS n FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
)
def _(spark, sf):
    return P.top_values(X.table(spark, sf, "events"), "user_id", 15)


@check(
    "A8_histogram",
    """WITH capped AS (SELECT value FROM events WHERE value <= (SELECT quantile_cont(value, 0.995) FROM events)),
       r AS (SELECT min(value) AS lo, (max(value) - min(value)) / 40 AS w FROM capped),
       b AS (SELECT CAST(least(floor((value - lo) / w), 39) AS BIGINT) AS bin, count(*) AS n FROM capped, r GROUP BY 1)
       SELECT i AS bin, round(lo + i * w, 6) AS lo, round(lo + (i + 1) * w, 6) AS hi, coalesce(n, 0) AS n
       FROM (SELECT unnest(range(40)) AS i) d CROSS JOIN r LEFT JOIN b ON b.bin = d.i""",
)
def _(spark, sf):
    return X.rounded(P.histogram(P.cap_outliers(X.table(spark, sf, "events"), "value"), "value", 40))


@check(
    "A9_anomaly_counts",
    """SELECT 'low_value' AS rule, count(*) FILTER (value < 1) AS n, round(count(*) FILTER (value < 1) / count(*), 6) AS rate FROM events
       UNION ALL SELECT 'errors', count(*) FILTER (event_type = 'error'), round(count(*) FILTER (event_type = 'error') / count(*), 6) FROM events""",
)
def _(spark, sf):
    rules = {"low_value": F.col("value") < 1, "errors": F.col("event_type") == "error"}
    return X.rounded(P.anomaly_counts(X.table(spark, sf, "events"), rules))


@check(
    "A13_daily_total",
    "SELECT CAST(hour_ts AS DATE) AS pickup_date, CAST(sum(demand) AS BIGINT) AS total FROM fact GROUP BY 1",
)
def _(spark, sf):
    return E.daily_total(X.fact(spark, sf), "hour_ts", "demand")


@check(
    "A14_dense_mean",
    """SELECT 'hour' AS key, CAST(i AS BIGINT) AS member, CAST(i AS VARCHAR) AS name, round(coalesce(m, 0), 6) AS mean
       FROM (SELECT unnest(range(24)) AS i) LEFT JOIN (SELECT hour, avg(demand) AS m FROM wide GROUP BY 1) ON i = hour
       UNION ALL SELECT 'dow', i, ['Mon','Tue','Wed','Thu','Fri','Sat','Sun'][i + 1], round(coalesce(m, 0), 6)
       FROM (SELECT unnest(range(7)) AS i) LEFT JOIN (SELECT day_of_week, avg(demand) AS m FROM wide GROUP BY 1) ON i = day_of_week
       UNION ALL SELECT 'weekend', i, ['Weekday','Weekend'][i + 1], round(coalesce(m, 0), 6)
       FROM (SELECT unnest(range(2)) AS i) LEFT JOIN (SELECT is_weekend, avg(demand) AS m FROM wide GROUP BY 1) ON i = is_weekend
       UNION ALL SELECT 'rain', i, ['No Rain','Rain'][i + 1], round(coalesce(m, 0), 6) FROM (SELECT unnest(range(2)) AS i)
       LEFT JOIN (SELECT CAST(coalesce(precipitation_sum, 0) > 0 AS INTEGER) AS k, avg(demand) AS m FROM wide GROUP BY 1) ON i = k
       UNION ALL SELECT 'heavy', i, ['Not Heavy Rain','Heavy Rain'][i + 1], round(coalesce(m, 0), 6) FROM (SELECT unnest(range(2)) AS i)
       LEFT JOIN (SELECT CAST(coalesce(precipitation_sum, 0) >= 10 AS INTEGER) AS k, avg(demand) AS m FROM wide GROUP BY 1) ON i = k""",
)
def _(spark, sf):
    rows = X.wide(spark, sf).transform(dims.fill_weather).transform(FT.add_weather_flags)
    parts = [
        ("hour", "hour", range(24), None),
        ("dow", "day_of_week", range(7), S.WEEKDAY_NAMES),
        ("weekend", "is_weekend", range(2), ("Weekday", "Weekend")),
        ("rain", "is_rainy", range(2), ("No Rain", "Rain")),
        ("heavy", "is_heavy_rain", range(2), ("Not Heavy Rain", "Heavy Rain")),
    ]
    return X.rounded(
        X.bag(
            *[
                E.dense_mean(rows, col, domain, "demand", names=names).select(
                    F.lit(key).alias("key"), F.col(col).alias("member"), "name", "mean"
                )
                for key, col, domain, names in parts
            ]
        )
    )


@check(
    "A15_binned_mean",
    """WITH r AS (SELECT min(temperature_mean) AS lo, (max(temperature_mean) - min(temperature_mean)) / 10 AS w FROM wide),
       b AS (SELECT CAST(greatest(least(ceil((temperature_mean - lo) / w), 10), 1) AS BIGINT) - 1 AS bin, avg(demand) AS m
             FROM wide, r WHERE temperature_mean IS NOT NULL GROUP BY 1)
       SELECT i AS bin, round(lo + i * w, 6) AS lo, round(lo + (i + 1) * w, 6) AS hi, round(m, 6) AS mean
       FROM (SELECT unnest(range(10)) AS i) d CROSS JOIN r LEFT JOIN b ON b.bin = d.i""",
)
def _(spark, sf):
    return X.rounded(P.binned_mean(X.wide(spark, sf), "temperature_mean", "demand", 10))


CORR = ["demand", "demand_lag_1", "demand_lag_2", "demand_lag_24", "rolling_mean_3h"]


@check(
    "A16_correlations",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 4) AS r FROM row_lags" for a in CORR for b in CORR
    ),
)
def _(spark, sf):
    return X.rounded(P.correlations(X.row_lags(spark, sf), CORR), 4)


@check(
    "A16_target_correlations",
    " UNION ALL ".join(f"SELECT '{a}' AS a, 'demand' AS b, round(corr({a}, demand), 4) AS r FROM row_lags" for a in CORR),
)
def _(spark, sf):
    return X.rounded(P.correlations(X.row_lags(spark, sf), CORR, "demand"), 4)


@check(
    "A17_mean_by",
    """SELECT 'borough' AS k, borough AS value, round(avg(demand), 6) AS mean FROM wide GROUP BY 2
       UNION ALL SELECT 'service_zone', service_zone, round(avg(demand), 6) FROM wide GROUP BY 2""",
)
def _(spark, sf):
    rows = X.wide(spark, sf)
    return X.rounded(
        X.bag(
            *[
                E.mean_by(rows, k, "demand").select(F.lit(k).alias("k"), F.col(k).alias("value"), "mean")
                for k in ("borough", "service_zone")
            ]
        )
    )


@check(
    "A20_duplicate_rows",
    "SELECT CAST(sum(c - 1) AS BIGINT) AS n FROM (SELECT count(*) AS c FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)
def _(spark, sf):
    return Q.duplicate_rows(X.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@check(
    "A21_day_coverage",
    "SELECT borough, count(DISTINCT date) AS days, 31 AS expected_days FROM x5 GROUP BY 1",
)
def _(spark, sf):
    return X.rounded(Q.day_coverage(X.x5(spark, sf), "date", "borough", 2024, 1))


@check("A28_missing_members", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def _(spark, sf):
    seen = X.table(spark, sf, "events").select(F.col("user_id").alias("c_custkey"))
    return dims.missing_members(seen, "c_custkey", X.table(spark, sf, "customer"))


@check(
    "O1_sorted_by",
    "SELECT hour, round(avg(demand), 6) AS avg_demand FROM wide GROUP BY 1",
)
def _(spark, sf):
    means = X.wide(spark, sf).groupBy("hour").agg(F.avg("demand").alias("avg_demand"))
    return X.rounded(K.sorted_by(means, ["hour"]))


@check(
    "O5_busiest_zones",
    """SELECT pulocationid, round(avg(demand), 6) AS mean FROM fact GROUP BY 1
       ORDER BY avg(demand) DESC, pulocationid LIMIT 10""",
)
def _(spark, sf):
    return X.rounded(E.busiest_zones(X.fact(spark, sf), 10, "pulocationid", "demand"))


@check(
    "M24_explore",
    """SELECT 'hour' AS key, CAST(hour AS VARCHAR) AS value, round(avg(demand), 6) AS avg_demand FROM wide GROUP BY 2
       UNION ALL SELECT 'day_of_week', CAST(day_of_week AS VARCHAR), round(avg(demand), 6) FROM wide GROUP BY 2
       UNION ALL SELECT 'borough', borough, round(avg(demand), 6) FROM wide GROUP BY 2""",
)
def _(spark, sf):
    return X.rounded(explore(X.fact(spark, sf), X.x4(spark, sf), X.x5(spark, sf), n=None)["profile"])


# --- windows -------------------------------------------------------------

LAGS_SQL = "demand_lag_1, demand_lag_2, demand_lag_24"


def _narrow(spark, sf):
    return X.fact(spark, sf).select("hour_ts", "pulocationid", "demand")


@check("W1_lag_rows", f"SELECT hour_ts, pulocationid, demand, {LAGS_SQL} FROM row_lags")
def _(spark, sf):
    return L.lag_rows(_narrow(spark, sf), "pulocationid", "hour_ts", "demand", split_days=7)


@check(
    "W2_rolling_mean_rows",
    "SELECT hour_ts, pulocationid, demand, round(rolling_mean_3h, 6) AS rolling_mean_3h FROM row_lags",
)
def _(spark, sf):
    return X.rounded(L.rolling_mean_rows(_narrow(spark, sf), "pulocationid", "hour_ts", "demand", split_days=7))


@check(
    "Z1_lags_by_rows",
    f"SELECT hour_ts, pulocationid, demand, {LAGS_SQL}, round(rolling_mean_3h, 6) AS rolling_mean_3h FROM row_lags",
)
def _(spark, sf):
    return X.rounded(L.lag_features(_narrow(spark, sf), "pulocationid", "hour_ts", "demand", "rows", split_days=7))


@check(
    "Z1_lags_by_time",
    f"SELECT hour_ts, pulocationid, demand, {LAGS_SQL}, round(rolling_mean_3h, 6) AS rolling_mean_3h FROM time_lags",
)
def _(spark, sf):
    return X.rounded(L.lag_features(_narrow(spark, sf), "pulocationid", "hour_ts", "demand", "time", split_days=7))


@check(
    "A26_trailing_mean",
    "SELECT hour_ts, pulocationid, demand, round(rolling_mean_3h, 6) AS trailing_mean FROM time_lags",
)
def _(spark, sf):
    return X.rounded(L.trailing_mean(_narrow(spark, sf), "pulocationid", "hour_ts", "demand", split_days=7))


@check(
    "A24_hour_dow_history",
    """SELECT pulocationid, h AS hour_of_day, d AS day_of_week, round(avg_demand, 6) AS avg_demand FROM history""",
)
def _(spark, sf):
    return X.rounded(L.hour_dow_history(X.fact(spark, sf), "pulocationid", "hour_ts"))


@check(
    "A25_mean_nonzero",
    """SELECT o_orderkey, l_linenumber, round(list_avg([v FOR v IN [l_tax, l_discount, l_quantity - 25] IF v > 0]), 6) AS m
       FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE len([v FOR v IN [l_tax, l_discount, l_quantity - 25] IF v > 0]) > 0
       UNION ALL SELECT o_orderkey, l_linenumber, 0.0 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
       WHERE len([v FOR v IN [l_tax, l_discount, l_quantity - 25] IF v > 0]) = 0""",
)
def _(spark, sf):
    rows = X.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_tax", "l_discount", (F.col("l_quantity") - 25).alias("q"))
    return rows.select("o_orderkey", "l_linenumber", F.round(score.mean_nonzero("l_tax", "l_discount", "q"), 6).alias("m"))


# --- joins ---------------------------------------------------------------


@check("J1_join_zone", "SELECT hour_ts, pulocationid, demand, borough, zone, service_zone FROM wide")
def _(spark, sf):
    zones = X.x4(spark, sf)
    return FT.join_zone(_narrow(spark, sf), zones.unionByName(zones))


@check(
    "J2_join_weather",
    "SELECT hour_ts, pulocationid, demand, borough, temperature_mean, precipitation_sum, wind_speed_max FROM wide",
)
def _(spark, sf):
    rows = FT.join_zone(_narrow(spark, sf), X.x4(spark, sf))
    shouted = X.x5(spark, sf).withColumn("borough", F.concat(F.lit(" "), F.upper("borough")))
    return FT.join_weather(rows, shouted).drop("zone", "service_zone")


@check("J3_orphans", "SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT user_id FROM events)")
def _(spark, sf):
    return Q.orphans(X.table(spark, sf, "orders"), X.table(spark, sf, "events"), "o_custkey", "user_id")


REQUESTED = """asked AS (SELECT DISTINCT pulocationid, date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS hour_ts FROM x1)"""
ACTUAL = """actual AS (SELECT q.pulocationid, q.hour_ts,
    max(f.demand) FILTER (f.hour_ts = q.hour_ts - INTERVAL 1 HOUR) AS l1,
    max(f.demand) FILTER (f.hour_ts = q.hour_ts - INTERVAL 2 HOUR) AS l2,
    max(f.demand) FILTER (f.hour_ts = q.hour_ts - INTERVAL 24 HOUR) AS l24,
    avg(f.demand) FILTER (f.hour_ts >= q.hour_ts - INTERVAL 3 HOUR AND f.hour_ts <= q.hour_ts - INTERVAL 1 HOUR) AS r
  FROM asked q LEFT JOIN fact f ON f.pulocationid = q.pulocationid AND f.hour_ts < q.hour_ts AND f.hour_ts >= q.hour_ts - INTERVAL 24 HOUR
  GROUP BY 1, 2)"""
WITH_HISTORY = """hist AS (SELECT q.*, h1.avg_demand AS a1, h2.avg_demand AS a2, h3.avg_demand AS a3, h24.avg_demand AS a24
  FROM actual q
  LEFT JOIN history h1 ON h1.pulocationid = q.pulocationid AND h1.h = (hour(q.hour_ts) + 23) % 24 AND h1.d = dayofweek(q.hour_ts)
  LEFT JOIN history h2 ON h2.pulocationid = q.pulocationid AND h2.h = (hour(q.hour_ts) + 22) % 24 AND h2.d = dayofweek(q.hour_ts)
  LEFT JOIN history h3 ON h3.pulocationid = q.pulocationid AND h3.h = (hour(q.hour_ts) + 21) % 24 AND h3.d = dayofweek(q.hour_ts)
  LEFT JOIN history h24 ON h24.pulocationid = q.pulocationid AND h24.h = hour(q.hour_ts) AND h24.d = (dayofweek(q.hour_ts) + 6) % 7)"""
SERVED = """SELECT pulocationid, hour_ts, round(coalesce(l1, a1, 0), 6) AS demand_lag_1, round(coalesce(l2, a2, 0), 6) AS demand_lag_2,
  round(coalesce(l24, a24, 0), 6) AS demand_lag_24,
  round(coalesce(r, list_avg([v FOR v IN [a1, a2, a3] IF v > 0]), 0), 6) AS rolling_mean_3h FROM hist"""


def _asked(spark, sf):
    return X.x1(spark, sf).select(
        "pulocationid", (time.hour_bucket("pickup_datetime") + F.expr("interval 1 hour")).alias("hour_ts")
    )


@check(
    "J5_lags_at_offsets",
    f"""WITH {REQUESTED}, {ACTUAL} SELECT pulocationid, hour_ts, l1 AS demand_lag_1, l2 AS demand_lag_2, l24 AS demand_lag_24,
        round(r, 6) AS rolling_mean_3h FROM actual""",
)
def _(spark, sf):
    return X.rounded(L.lags_at_offsets(X.fact(spark, sf), _asked(spark, sf), "pulocationid", "hour_ts"))


@check("J6_history_fallback", f"WITH {REQUESTED}, {ACTUAL}, {WITH_HISTORY} {SERVED}")
def _(spark, sf):
    fact = X.fact(spark, sf)
    lags = L.lags_at_offsets(fact, _asked(spark, sf), "pulocationid", "hour_ts")
    history = L.hour_dow_history(fact, "pulocationid", "hour_ts")
    return X.rounded(L.with_history_fallback(lags, history, "pulocationid", "hour_ts"))


@check("M19_serving_lags", f"WITH {REQUESTED}, {ACTUAL}, {WITH_HISTORY} {SERVED}")
def _(spark, sf):
    return X.rounded(L.serving_lags(_asked(spark, sf), X.fact(spark, sf)))


@check(
    "J7_weather_by_zone",
    """SELECT z.location_id, z.borough, w.date, w.temperature_mean, w.precipitation_sum, w.wind_speed_max FROM x4 z
       LEFT JOIN (SELECT * FROM x5 QUALIFY row_number() OVER (PARTITION BY borough ORDER BY date DESC) = 1) w ON z.borough = w.borough""",
)
def _(spark, sf):
    # One forecast per borough: its latest day.
    days = X.x5(spark, sf)
    latest = days.groupBy("borough").agg(F.max_by(F.struct("date", *S.WEATHER_COLUMNS), "date").alias("w"))
    return dims.weather_by_zone(X.x4(spark, sf), latest.select("borough", "w.*"))


@check(
    "J8_with_zone_meta",
    "SELECT event_id, pulocationid, borough, service_zone FROM x1 LEFT JOIN x4 ON pulocationid = location_id",
)
def _(spark, sf):
    from zonepulse.operators.scoring import with_zone_meta

    return with_zone_meta(X.x1(spark, sf).select("event_id", "pulocationid"), X.x4(spark, sf))


@check(
    "J9_with_lookup",
    """SELECT x.event_id, x.pulocationid, coalesce(f.demand, 0)::DOUBLE AS demand FROM (
         SELECT event_id, pulocationid, date_trunc('hour', pickup_datetime) + INTERVAL 1 HOUR AS hour_ts FROM x1) x
       LEFT JOIN fact f ON f.pulocationid = x.pulocationid AND f.hour_ts = x.hour_ts""",
)
def _(spark, sf):
    from zonepulse.operators.scoring import with_lookup

    rows = X.x1(spark, sf).select(
        "event_id", "pulocationid", (time.hour_bucket("pickup_datetime") + F.expr("interval 1 hour")).alias("hour_ts")
    )
    return with_lookup(rows, X.fact(spark, sf), ["pulocationid", "hour_ts"], {"demand": 0.0}).drop("hour_ts")


@check(
    "J9_with_weather",
    """SELECT hour_ts, pulocationid, round(coalesce(temperature_mean, 0), 6) AS temperature_mean, coalesce(precipitation_sum, 0) AS precipitation_sum,
         CAST(coalesce(precipitation_sum, 0) > 0 AS BIGINT) AS is_rainy FROM wide""",
)
def _(spark, sf):
    from zonepulse.operators.scoring import with_weather

    rows = FT.join_zone(_narrow(spark, sf), X.x4(spark, sf))
    out = with_weather(rows, X.x5(spark, sf))
    return X.rounded(out.select("hour_ts", "pulocationid", "temperature_mean", "precipitation_sum", "is_rainy"))


IDS_NOW = "SELECT user_id AS k FROM events"
IDS_BEFORE = "SELECT o_custkey + 75 AS k FROM orders"


def _two_lookups(spark, sf):
    """Those seen in events, and those seen in orders: keys of two whole tables, with repeats, that differ both ways."""
    now = X.table(spark, sf, "events").select(F.col("user_id").alias("k"))
    return now, X.table(spark, sf, "orders").select((F.col("o_custkey") + 75).alias("k"))


@check(
    "J14_key_diff",
    f"""(SELECT k, 'added' AS change FROM ({IDS_NOW}) EXCEPT SELECT k, 'added' FROM ({IDS_BEFORE}))
        UNION ALL (SELECT k, 'removed' FROM ({IDS_BEFORE}) EXCEPT SELECT k, 'removed' FROM ({IDS_NOW}))""",
)
def _(spark, sf):
    return Q.key_diff(*_two_lookups(spark, sf), "k")


@check("U3_except_keys", f"{IDS_NOW} EXCEPT {IDS_BEFORE}")
def _(spark, sf):
    return Q.except_keys(*_two_lookups(spark, sf), "k")


# --- quality rules -------------------------------------------------------


def _rules_sql(table: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{rule}' AS rule, '{sev}' AS severity, CAST(({n}) AS BIGINT) AS failing, CAST(NULL AS VARCHAR) AS detail"
        for rule, sev, n in rules
    )


@check(
    "Q1_check_trips",
    """SELECT 'yellow' AS table_name, 'empty' AS rule, 'error' AS severity, CAST((SELECT count(*) = 0 FROM x2_a) AS BIGINT) AS failing, NULL AS detail
       UNION ALL SELECT 'yellow', 'missing_columns', 'error', 0, NULL
       UNION ALL SELECT 'fhvhv', 'empty', 'error', CAST((SELECT count(*) = 0 FROM x2_a) AS BIGINT), NULL
       UNION ALL SELECT 'fhvhv', 'missing_columns', 'error', 2, 'dropoff_datetime, pickup_datetime'""",
)
def _(spark, sf):
    # The first feed's file under the second feed's rules lacks two columns.
    return X.bag(Q.check_trips(X.x2_a(spark, sf), "yellow"), Q.check_trips(X.x2_a(spark, sf), "fhvhv"))


@check(
    "Q2_check_weather_raw",
    _rules_sql(
        "weather",
        [
            ("empty", "error", "SELECT CAST(count(*) = 0 AS INTEGER) FROM x5"),
            ("missing_columns", "error", "SELECT 0"),
            ("unparseable_date", "error", "SELECT 0"),
            ("negative_precipitation", "error", "SELECT 0"),
            ("negative_wind", "error", "SELECT count(*) FROM x5 WHERE wind_speed_max - 5 < 0"),
            ("duplicate_key", "error", "SELECT 0"),
        ],
    )
    + """ UNION ALL SELECT 'weather', 'missing_boroughs', 'error', 1, 'EWR'
        UNION ALL SELECT 'weather', 'full_month:' || b, 'error', CAST(coalesce(d, 0) <> 31 AS BIGINT),
          CASE WHEN coalesce(d, 0) <> 31 THEN coalesce(d, 0) || ' days' END
        FROM (SELECT unnest(['Bronx', 'Brooklyn', 'Manhattan', 'Queens', 'Staten Island', 'EWR']) AS b)
        LEFT JOIN (SELECT borough, count(DISTINCT date) AS d FROM x5 GROUP BY 1) ON b = borough""",
)
def _(spark, sf):
    raw = X.x5(spark, sf).withColumn("wind_speed_max", F.col("wind_speed_max") - 5)
    return Q.check_weather_raw(raw.withColumn("date", F.col("date").cast("string")), 2024, 1)


@check(
    "Q3_check_lookup",
    _rules_sql(
        "lookup",
        [
            ("empty", "error", "SELECT 0"),
            ("missing_columns", "error", "SELECT 0"),
            ("null_id", "error", "SELECT 2 * count(*) FROM x4 WHERE service_zone IS NULL OR zone LIKE 'A%'"),
            (
                "duplicate_key",
                "error",
                "SELECT 2 * count(*) - count(DISTINCT coalesce(CASE WHEN service_zone IS NOT NULL AND zone NOT LIKE 'A%' THEN location_id END, -1)) FROM x4",
            ),
        ],
    ),
)
def _(spark, sf):
    known = F.col("service_zone").isNotNull() & ~F.col("Zone").like("A%")
    raw = X.x4_raw(spark, sf).withColumn("LocationID", F.when(known, F.col("LocationID")))
    return Q.check_lookup(raw.unionByName(raw))


@check(
    "Q3_check_lookup_columns",
    _rules_sql("lookup", [("empty", "error", "SELECT 1")])
    + " UNION ALL SELECT 'lookup', 'missing_columns', 'error', 2, 'Borough, LocationID'",
)
def _(spark, sf):
    return Q.check_lookup(X.x4_raw(spark, sf).drop("LocationID", "Borough").filter("Zone = 'nowhere'"))


@check(
    "Q4_check_lookup_change",
    f"""WITH a AS (SELECT k FROM ({IDS_NOW}) EXCEPT SELECT k FROM ({IDS_BEFORE})),
         r AS (SELECT k FROM ({IDS_BEFORE}) EXCEPT SELECT k FROM ({IDS_NOW}))
       SELECT 'lookup' AS table_name, 'changed' AS rule, 'warning' AS severity, 1 AS failing, NULL AS detail
       UNION ALL SELECT 'lookup', 'ids_added', 'warning', (SELECT count(*) FROM a),
         (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM a ORDER BY k LIMIT 10)) || CASE WHEN (SELECT count(*) FROM a) > 10 THEN '...' ELSE '' END
       UNION ALL SELECT 'lookup', 'ids_removed', 'warning', (SELECT count(*) FROM r),
         (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM r ORDER BY k LIMIT 10)) || CASE WHEN (SELECT count(*) FROM r) > 10 THEN '...' ELSE '' END""",
)
def _(spark, sf):
    return Q.check_lookup_change(*_two_lookups(spark, sf), "k")


FACT_RULES = [
    ("empty", "error", "SELECT 0"),
    ("missing_columns", "error", "SELECT 0"),
    ("null_hour_ts", "error", "SELECT 0"),
    ("null_pulocationid", "error", "SELECT 0"),
    ("null_demand", "error", "SELECT 0"),
    ("null_row_fingerprint", "error", "SELECT count(*) FROM fact WHERE pulocationid = 0"),
    ("unparseable_hour_ts", "error", "SELECT 0"),
    ("non_positive_demand", "error", "SELECT count(*) FROM fact WHERE demand - 2 <= 0"),
    ("negative_distance", "error", "SELECT count(*) FROM fact WHERE avg_trip_distance - 3 < 0"),
    ("negative_amount", "warning", "SELECT count(*) FROM fact WHERE avg_total_amount - 2 < 0"),
    ("duplicate_key", "error", "SELECT count(*) - count(DISTINCT (date_trunc('day', hour_ts), pulocationid)) FROM fact"),
]


def _faulty_fact(spark, sf):
    signed = I.apply_fingerprint(X.fact(spark, sf), X.KEY)
    return signed.select(
        time.date_trunc("day", "hour_ts").alias("hour_ts"),
        "pulocationid",
        (F.col("demand") - 2).alias("demand"),
        (F.col("avg_trip_distance") - 3).alias("avg_trip_distance"),
        (F.col("avg_total_amount") - 2).alias("avg_total_amount"),
        F.when(F.col("pulocationid") != 0, F.col("row_fingerprint")).alias("row_fingerprint"),
    )


@check("Q5_check_fact", _rules_sql("fact_trips_pickup", FACT_RULES))
def _(spark, sf):
    return Q.check_fact(_faulty_fact(spark, sf))


@check(
    "Q6_check_weather",
    _rules_sql(
        "dim_weather",
        [("empty", "error", "SELECT 0"), ("missing_columns", "error", "SELECT 0"), ("duplicate_key", "error", "SELECT count(*) FROM x5")],
    ),
)
def _(spark, sf):
    rows = X.x5(spark, sf)
    return Q.check_weather(rows.unionByName(rows))


@check(
    "Q7_check_zones",
    _rules_sql(
        "dim_zone",
        [
            ("empty", "error", "SELECT 0"),
            ("missing_columns", "error", "SELECT 0"),
            ("null_id", "error", "SELECT count(*) FROM x4 WHERE service_zone IS NULL"),
            ("duplicate_key", "error", "SELECT 0"),
        ],
    ),
)
def _(spark, sf):
    zones = X.x4(spark, sf)
    return Q.check_zones(zones.withColumn("location_id", F.when(F.col("service_zone").isNotNull(), F.col("location_id"))))


@check(
    "Q8_check_references",
    """WITH o AS (SELECT DISTINCT c_custkey AS k FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events))
       SELECT 'fact_trips_pickup' AS table_name, 'unknown_zone' AS rule, 'error' AS severity, (SELECT count(*) FROM o) AS failing,
         (SELECT string_agg(k, ', ' ORDER BY k) FROM (SELECT k FROM o ORDER BY k LIMIT 20))
           || CASE WHEN (SELECT count(*) FROM o) > 20 THEN '...' ELSE '' END AS detail""",
)
def _(spark, sf):
    return Q.check_references(X.table(spark, sf, "customer"), X.table(spark, sf, "events"), "c_custkey", "user_id")


@check(
    "Q9_assert_expectations",
    """SELECT 'Validation failed:' AS line UNION ALL SELECT '- dim_zone: null_id (' || count(*) || ')' FROM x4 WHERE service_zone IS NULL
       UNION ALL SELECT '- dim_weather: duplicate_key (' || count(*) || ')' FROM x5
       UNION ALL SELECT 'passed: ' || (SELECT count(*) FROM x4) || ' zones'""",
)
def _(spark, sf):
    """What a failed table raises, line by line, and that a sound one raises nothing."""
    zones, days = X.x4(spark, sf), X.x5(spark, sf)
    Q.assert_expectations(Q.check_zones(zones).unionByName(Q.check_weather(days)))
    faulty = zones.withColumn("location_id", F.when(F.col("service_zone").isNotNull(), F.col("location_id")))
    try:
        Q.assert_expectations(Q.check_zones(faulty).unionByName(Q.check_weather(days.unionByName(days))))
        lines = ["nothing raised"]
    except ValueError as e:
        lines = str(e).splitlines()
    passed = zones.agg(F.concat(F.lit("passed: "), F.count("*").cast("string"), F.lit(" zones")).alias("line"))
    return spark.createDataFrame([(x,) for x in lines], "line string").unionByName(passed)


@check(
    "Q10_anomaly_flags",
    """SELECT * FROM (SELECT 'high_demand' AS flag, CAST(count(*) FILTER (demand * 1000 > 3000) AS DOUBLE) AS value FROM wide
         UNION ALL SELECT 'high_amount', count(*) FILTER (avg_total_amount > 500) FROM wide
         UNION ALL SELECT 'zero_distance_rate', CASE WHEN avg(CAST(floor(avg_trip_distance / 30) = 0 AS INTEGER)) > 0.05
           THEN round(avg(CAST(floor(avg_trip_distance / 30) = 0 AS INTEGER)), 6) ELSE 0 END FROM wide
         UNION ALL SELECT 'null_rate:temperature_mean', CASE WHEN avg(CAST(temperature_mean IS NULL AS INTEGER)) > 0.1
           THEN round(avg(CAST(temperature_mean IS NULL AS INTEGER)), 6) ELSE 0 END FROM wide) WHERE value > 0""",
)
def _(spark, sf):
    rows = X.wide(spark, sf).select(
        (F.col("demand") * 1000).alias("demand"),
        "avg_total_amount",
        F.floor(F.col("avg_trip_distance") / 30).cast("double").alias("avg_trip_distance"),
        "temperature_mean",
    )
    return X.rounded(P.anomaly_flags(rows, {**S.ANOMALY, "null_rate": 0.1}))


def _capped(c: str, table: str) -> str:
    return f"SELECT 'histogram_{c}', 40, count(*) FROM {table} WHERE {c} <= (SELECT quantile_cont({c}, 0.995) FROM {table})"


@check(
    "Q13_quality_report",
    """SELECT 'fact_describe' AS report, 3 AS entries, 3 * count(*) AS total FROM fact
       UNION ALL SELECT 'fact_nulls', 5, 0
       UNION ALL SELECT 'top_zones', count(*), CAST(sum(n) AS BIGINT) FROM (SELECT count(*) AS n FROM fact GROUP BY pulocationid ORDER BY 1 DESC, pulocationid LIMIT 15)
       UNION ALL SELECT 'anomalies', CAST(count(*) FILTER (avg_total_amount > 500) > 0 AS BIGINT), count(*) FILTER (avg_total_amount > 500) FROM fact
       UNION ALL SELECT 'weather_describe', 3, 3 * count(*) FROM x5 UNION ALL """
    + " UNION ALL ".join(
        [_capped(c, "fact") for c in ("demand", "avg_trip_distance", "avg_total_amount")]
        + [_capped(c, "x5") for c in S.WEATHER_COLUMNS]
    ),
)
def _(spark, sf):
    report = quality_report(X.fact(spark, sf), X.x5(spark, sf), 2024, 1)
    counted = {"fact_describe": "count", "weather_describe": "count", "anomalies": "value"}
    parts = [
        df.agg(
            F.count("*").alias("entries"), F.coalesce(F.sum(counted.get(name, "n")).cast("long"), F.lit(0)).alias("total")
        ).select(F.lit(name).alias("report"), "entries", "total")
        for name, df in report.items()
    ]
    return X.bag(*parts)


# --- scalar functions ----------------------------------------------------


@check(
    "C1_date_trunc",
    """SELECT event_id, date_trunc('hour', ts) AS h, date_trunc('day', ts) AS d, CAST(date_trunc('month', ts) AS TIMESTAMP) AS m FROM events""",
)
def _(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id", time.date_trunc("hour", "ts").alias("h"), time.date_trunc("day", "ts").alias("d"), time.date_trunc("month", "ts").alias("m")
    )


@check(
    "C2_date_parts",
    """SELECT event_id, month(ts) AS month, hour(ts) AS hour, isodow(ts) - 1 AS day_of_week, CAST(isodow(ts) >= 6 AS BIGINT) AS is_weekend, CAST(ts AS DATE) AS pickup_date,
         strftime(ts, '%Y-%m') AS year_month FROM events""",
)
def _(spark, sf):
    from zonepulse.sources.writers import with_period

    rows = X.table(spark, sf, "events").select("event_id", F.col("ts").alias("hour_ts"))
    return X.rounded(with_period(FT.add_calendar(rows), "hour_ts").select("event_id", "month", "hour", "day_of_week", "is_weekend", "pickup_date", "year_month"))


@check("C3_weekday_numbers", "SELECT l_orderkey, l_linenumber, dayofweek(l_shipdate) AS sun0, isodow(l_shipdate) - 1 AS mon0 FROM lineitem")
def _(spark, sf):
    return X.rounded(
        X.table(spark, sf, "lineitem").select(
            "l_orderkey", "l_linenumber", time.dow_sun0("l_shipdate").alias("sun0"), time.dow_mon0("l_shipdate").alias("mon0")
        )
    )


@check(
    "C4_month_arithmetic",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 2 MONTH AS DATE) AS back2, CAST(CAST(o_orderdate AS DATE) - INTERVAL 36 MONTH AS DATE) AS back36,
         last_day(CAST(o_orderdate AS DATE)) AS last, CAST(date_trunc('month', CAST(o_orderdate AS DATE)) AS DATE) AS first,
         day(last_day(CAST(o_orderdate AS DATE))) AS days FROM orders""",
)
def _(spark, sf):
    d = F.to_date("o_orderdate")
    return X.rounded(
        X.table(spark, sf, "orders").select(
            "o_orderkey",
            time.shift_months(d, -2).alias("back2"),
            time.shift_months(d, -36).alias("back36"),
            time.month_end(d).alias("last"),
            time.month_start(d).alias("first"),
            time.days_in_month(d).alias("days"),
        )
    )


@check(
    "C5_epoch",
    "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds, date_trunc('second', ts) AS back FROM events",
)
def _(spark, sf):
    rows = X.table(spark, sf, "events").withColumn("seconds", time.epoch("ts"))
    return rows.select("event_id", "seconds", time.from_epoch("seconds").alias("back"))


@check("C6_parse_iso", "SELECT event_id, date_trunc('second', ts) AS parsed, CAST(NULL AS TIMESTAMP) AS bad FROM events")
def _(spark, sf):
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+08:00"))
    return X.table(spark, sf, "events").select(
        "event_id", time.parse_iso(iso).alias("parsed"), time.parse_iso(F.concat(F.lit("x"), iso)).alias("bad")
    )


@check(
    "C7_wrapped_offsets",
    "SELECT event_id, (hour(ts) + 21) % 24 AS h3, (dayofweek(ts) + 6) % 7 AS yesterday FROM events",
)
def _(spark, sf):
    return X.rounded(
        X.table(spark, sf, "events").select(
            "event_id", time.wrap(F.hour("ts") - 3, 24).alias("h3"), time.wrap(time.dow_sun0("ts") - 1, 7).alias("yesterday")
        )
    )


@check(
    "C8_math",
    """SELECT event_id, round(sin(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_sin, round(cos(2 * pi() * hour(ts) / 24), 6) + 0.0 AS hour_cos,
         round(2 * abs(value - 50) / (abs(50) + abs(value) + 1e-8), 6) + 0.0 AS term FROM events""",
)
def _(spark, sf):
    rows = X.table(spark, sf, "events").select("event_id", F.col("ts").alias("hour_ts"), "value")
    rows = FT.add_cyclical(FT.add_calendar(rows))
    return X.rounded(rows.select("event_id", "hour_sin", "hour_cos", score.smape_term(F.lit(50), "value").alias("term")))


@check(
    "C9_relative_shift",
    """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_discount = 0 AND l_tax = 0 THEN 0.0 WHEN l_discount = 0 THEN 1.0
         ELSE least(abs(l_tax - l_discount) / abs(l_discount), 1.0) END, 6) AS shift FROM lineitem""",
)
def _(spark, sf):
    return X.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.round(score.relative_shift("l_discount", "l_tax"), 6).alias("shift")
    )


@check(
    "C10_demand_score",
    """SELECT event_id, round(greatest(0.0, least(1.0, (value - 23) / 173)), 4) AS score, 0.0::DOUBLE AS inverted FROM events""",
)
def _(spark, sf):
    return X.table(spark, sf, "events").select(
        "event_id", score.demand_score("value").alias("score"), score.demand_score("value", 5, 5).alias("inverted")
    )


@check(
    "C11_clamp_percent",
    """SELECT event_id, least(1.0, greatest(0.0, value / 100)) AS clamped, CAST(floor(least(1.0, greatest(0.0, value / 100)) * 100 + 0.5) AS BIGINT) || '%' AS pct,
         0.0::DOUBLE AS of_nan FROM events""",
)
def _(spark, sf):
    share = F.col("value") / 100
    nan = F.when(F.col("event_id") >= 0, F.lit(float("nan")))
    return X.table(spark, sf, "events").select(
        "event_id", score.clamp01(share).alias("clamped"), score.percent(share).alias("pct"), score.clamp01(nan).alias("of_nan")
    )


@check(
    "C12_severity",
    """SELECT event_id, CASE WHEN value / 100 >= 0.8 THEN 'Critical' WHEN value / 100 >= 0.55 THEN 'High' WHEN value / 100 >= 0.3 THEN 'Medium' ELSE 'Healthy' END AS severity FROM events""",
)
def _(spark, sf):
    return X.table(spark, sf, "events").select("event_id", score.severity(F.col("value") / 100).alias("severity"))


@check(
    "C13_feature_kind",
    """SELECT feature, data_month, 'numeric_mean_shift' AS kind, 'unknown' AS other, 'categorical_proportion_shift' AS hot FROM drift_rows""",
)
def _(spark, sf):
    return X.drift_rows(spark, sf).select(
        "feature",
        "data_month",
        score.feature_kind("feature").alias("kind"),
        score.feature_kind(F.concat("feature", F.lit("?"))).alias("other"),
        score.feature_kind(F.concat(F.lit("borough_"), F.when(F.col("feature").isNotNull(), "ewr"))).alias("hot"),
    )


@check("C14_text", "SELECT p_partkey, lower(p_type) AS t, replace(p_name, ' ', '_') AS n FROM part")
def _(spark, sf):
    return X.table(spark, sf, "part").select(
        "p_partkey", text.normalise(F.concat(F.lit(" "), "p_type", F.lit(" "))).alias("t"), text.underscore("p_name").alias("n")
    )


@check(
    "C16_conditionals",
    """SELECT hour_ts, pulocationid, coalesce(service_zone, 'none') AS sz, round(coalesce(temperature_mean, 0), 6) + 0.0 AS temperature_mean,
         CAST(coalesce(precipitation_sum, 0) > 0 AS BIGINT) AS is_rainy, CAST(coalesce(precipitation_sum, 0) >= 10 AS BIGINT) AS is_heavy_rain,
         CAST(borough IS NULL AS BIGINT) AS no_borough, CAST(coalesce(lower(trim(borough)) = 'queens', false) AS BIGINT) AS queens FROM wide""",
)
def _(spark, sf):
    rows = X.wide(spark, sf).withColumn("sz", text.first_present("service_zone", default="none"))
    rows = FT.encode_location(FT.add_weather_flags(dims.fill_weather(rows)))
    return X.rounded(
        rows.select("hour_ts", "pulocationid", "sz", "temperature_mean", "is_rainy", "is_heavy_rain", F.col("borough_nan").alias("no_borough"), F.col("borough_queens").alias("queens"))
    )


@check(
    "C17_coercion",
    """SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) AS n, CASE WHEN p_size > 31 THEN NULL ELSE make_date(2024, 1, p_size) END AS d FROM part""",
)
def _(spark, sf):
    d = F.concat(F.lit("2024-01-"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    return X.table(spark, sf, "part").select(
        "p_partkey", text.try_number(F.replace("p_brand", F.lit("Brand#1"), F.lit(""))).alias("n"), text.try_date(d).alias("d")
    )


@check("C20_first_present", "SELECT hour_ts, pulocationid, coalesce(service_zone, borough) AS label FROM wide")
def _(spark, sf):
    return X.wide(spark, sf).select("hour_ts", "pulocationid", text.first_present("service_zone", "borough").alias("label"))


@check("C21_round", "SELECT o_orderkey, round(o_totalprice / 7, 2) AS d2, round(o_totalprice / 7, 4) AS d4 FROM orders")
def _(spark, sf):
    x = F.col("o_totalprice") / 7
    return X.table(spark, sf, "orders").select("o_orderkey", score.rounded(x, 2).alias("d2"), score.rounded(x, 4).alias("d4"))


@check(
    "C22_parse_ids",
    """SELECT l_orderkey, l_linenumber, unnest([l_partkey, l_suppkey, NULL]) AS id FROM lineitem""",
)
def _(spark, sf):
    raw = F.concat("l_partkey", F.lit(", "), "l_suppkey", F.lit(",, x"))
    return X.rounded(
        X.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.explode(text.parse_ids(raw)).alias("id"))
    )


# --- feature job ---------------------------------------------------------

FEATURE_SQL = ", ".join(
    f'round("{f.name}", 6) + 0.0 AS "{f.name}"'
    if f.dataType.typeName() == "double"
    else f'CAST("{f.name}" AS BIGINT) AS "{f.name}"'
    if f.dataType.typeName() in ("integer", "long")
    else f.name
    for f in S.FEATURE_TABLE.fields
)


@check("M1_build_features_rows", f"SELECT {FEATURE_SQL} FROM features")
def _(spark, sf):
    return X.rounded(X.features(spark, sf))


@check(
    "M1_build_features_time",
    """SELECT t.hour_ts, t.pulocationid, t.demand AS target_demand, t.demand_lag_1, t.demand_lag_2, t.demand_lag_24,
         round(t.rolling_mean_3h, 6) AS rolling_mean_3h, hour(t.hour_ts) AS hour, round(coalesce(w.temperature_mean, 0), 6) AS temperature_mean
       FROM time_lags t JOIN wide w ON t.hour_ts = w.hour_ts AND t.pulocationid = w.pulocationid
       WHERE t.demand_lag_1 IS NOT NULL AND t.demand_lag_2 IS NOT NULL AND t.demand_lag_24 IS NOT NULL AND t.rolling_mean_3h IS NOT NULL""",
)
def _(spark, sf):
    rows = X.features(spark, sf, "time")
    return X.rounded(
        rows.select("hour_ts", "pulocationid", "target_demand", *S.LAG_COLUMNS, "hour", "temperature_mean")
    )

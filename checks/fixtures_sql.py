"""Fixture tables in SQL. Order matters: a table may use those above it."""

CTES = {
    # Trips by hour: one event is one trip, the customer's nation is the zone.
    "x1": """
SELECT e.event_id, e.ts AS pickup_datetime, e.ts + INTERVAL 10 MINUTE AS dropoff_datetime,
  c.c_nationkey AS pulocationid, CAST(e.event_id % 25 AS INTEGER) AS dolocationid,
  e.value AS trip_distance, e.value * 2 AS total_amount, e.event_type AS taxi_type
FROM events e JOIN customer c ON e.user_id = c.c_custkey""",
    # Two trip feeds with different column names.
    "x2_a": """
SELECT l_suppkey AS "VendorID", o_orderdate AS tpep_pickup_datetime, l_shipdate AS tpep_dropoff_datetime,
  CAST(o_custkey % 266 AS INTEGER) AS "PULocationID", CAST(l_partkey % 266 AS INTEGER) AS "DOLocationID",
  l_quantity AS trip_distance, l_extendedprice AS total_amount,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE '?' END AS store_and_fwd_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'""",
    "x2_b": """
SELECT o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
  CAST(o_custkey % 266 AS INTEGER) AS "PULocationID", CAST(l_partkey % 266 AS INTEGER) AS "DOLocationID",
  l_quantity AS trip_miles, l_extendedprice AS base_passenger_fare, l_tax AS tolls,
  CASE WHEN l_discount > 0.02 THEN l_discount END AS congestion_surchage,
  CASE l_returnflag WHEN 'A' THEN 'Y' WHEN 'N' THEN 'N' ELSE '?' END AS shared_request_flag
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_linestatus <> 'F'""",
    # The same feeds conformed (the columns the checks look at).
    "conformed": """
SELECT tpep_pickup_datetime AS pickup_datetime, tpep_dropoff_datetime AS dropoff_datetime,
  "PULocationID" AS pulocationid, "DOLocationID" AS dolocationid, trip_distance,
  CAST(NULL AS DOUBLE) AS fare_amount, total_amount, 'yellow' AS taxi_type, "VendorID" AS vendor_id,
  CASE store_and_fwd_flag WHEN 'Y' THEN true WHEN 'N' THEN false END AS store_and_fwd_flag,
  CAST(NULL AS BOOLEAN) AS shared_request_flag, CAST(NULL AS DOUBLE) AS tolls_amount,
  CAST(NULL AS DOUBLE) AS congestion_surcharge
FROM x2_a
UNION ALL
SELECT pickup_datetime, dropoff_datetime, "PULocationID", "DOLocationID", trip_miles, base_passenger_fare,
  0.0::DOUBLE + coalesce(base_passenger_fare, 0) + coalesce(tolls, 0) + coalesce(congestion_surchage, 0),
  'fhvhv', CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN),
  CASE shared_request_flag WHEN 'Y' THEN true WHEN 'N' THEN false END, tolls, congestion_surchage
FROM x2_b""",
    # Monthly series for drift.
    "x3": """
SELECT o_orderkey, o_orderdate AS hour_ts, o_totalprice AS target_demand,
  CAST(o_orderpriority = '1-URGENT' AS INTEGER) AS is_urgent,
  CAST(o_orderstatus = 'P' AS INTEGER) AS status_p, c_nationkey AS pulocationid
FROM orders JOIN customer ON o_custkey = c_custkey""",
    # Zones, with one null service zone; regions stand for boroughs.
    "x4": """
SELECT n_nationkey AS location_id,
  CASE r_name WHEN 'AFRICA' THEN 'Manhattan' WHEN 'AMERICA' THEN 'Brooklyn' WHEN 'ASIA' THEN 'Queens'
    WHEN 'EUROPE' THEN 'Bronx' WHEN 'MIDDLE EAST' THEN 'Staten Island' END AS borough,
  n_name AS zone,
  CASE WHEN n_nationkey = 24 THEN NULL ELSE
    ['Yellow Zone','Boro Zone','Airports','EWR'][n_nationkey % 4 + 1] END AS service_zone
FROM nation JOIN region ON n_regionkey = r_regionkey""",
    # Weather with holes.
    "x5": """
SELECT CAST(x1.pickup_datetime AS DATE) AS date, x4.borough,
  (max(trip_distance) + min(trip_distance)) / 4 AS temperature_mean,
  max(CAST((day(x1.pickup_datetime) * 7 + length(x4.borough) * 3) % 15 AS DOUBLE)) AS precipitation_sum,
  round(max(trip_distance) / 10, 4) AS wind_speed_max
FROM x1 JOIN x4 ON pulocationid = location_id
WHERE (day(x1.pickup_datetime) + length(x4.borough)) % 7 <> 0 GROUP BY 1, 2""",
    # Points and rings.
    "x6": """
SELECT vec_id AS id, label, [[embedding[2*i+1]::DOUBLE, embedding[2*i+2]::DOUBLE] FOR i IN range(32)] AS ring
FROM embeddings""",
    "points": """
SELECT vec_id AS id, label, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings""",
    # Zone-hour demand of the trips.
    "fact": """
SELECT date_trunc('hour', pickup_datetime) AS hour_ts, pulocationid, count(*) AS demand,
  avg(trip_distance) AS avg_trip_distance, avg(total_amount) AS avg_total_amount
FROM x1 GROUP BY 1, 2""",
    "row_lags": """
SELECT hour_ts, pulocationid, demand,
  lag(demand, 1) OVER w AS demand_lag_1, lag(demand, 2) OVER w AS demand_lag_2, lag(demand, 24) OVER w AS demand_lag_24,
  avg(demand) OVER (PARTITION BY pulocationid ORDER BY hour_ts ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS rolling_mean_3h
FROM fact WINDOW w AS (PARTITION BY pulocationid ORDER BY hour_ts)""",
    "time_lags": """
SELECT f.hour_ts, f.pulocationid, f.demand, a.demand AS demand_lag_1, b.demand AS demand_lag_2, c.demand AS demand_lag_24,
  avg(f.demand) OVER (PARTITION BY f.pulocationid ORDER BY f.hour_ts
    RANGE BETWEEN INTERVAL 3 HOURS PRECEDING AND INTERVAL 1 HOUR PRECEDING) AS rolling_mean_3h
FROM fact f
LEFT JOIN fact a ON a.pulocationid = f.pulocationid AND a.hour_ts = f.hour_ts - INTERVAL 1 HOUR
LEFT JOIN fact b ON b.pulocationid = f.pulocationid AND b.hour_ts = f.hour_ts - INTERVAL 2 HOUR
LEFT JOIN fact c ON c.pulocationid = f.pulocationid AND c.hour_ts = f.hour_ts - INTERVAL 24 HOUR""",
    # Fact with its dimensions and calendar.
    "wide": """
SELECT f.*, z.borough, z.zone, z.service_zone, w.temperature_mean, w.precipitation_sum, w.wind_speed_max,
  hour(f.hour_ts) AS hour, isodow(f.hour_ts) - 1 AS day_of_week, month(f.hour_ts) AS month,
  CAST(isodow(f.hour_ts) >= 6 AS INTEGER) AS is_weekend, CAST(f.hour_ts AS DATE) AS pickup_date
FROM fact f LEFT JOIN x4 z ON f.pulocationid = z.location_id
LEFT JOIN x5 w ON CAST(f.hour_ts AS DATE) = w.date AND lower(trim(z.borough)) = lower(trim(w.borough))""",
    "features": """
SELECT w.pulocationid, w.hour_ts, w.demand AS target_demand, w.hour, w.day_of_week, w.month, w.is_weekend,
  sin(2 * pi() * w.hour / 24) AS hour_sin, cos(2 * pi() * w.hour / 24) AS hour_cos,
  sin(2 * pi() * w.day_of_week / 7) AS dow_sin, cos(2 * pi() * w.day_of_week / 7) AS dow_cos,
  coalesce(w.temperature_mean, 0) AS temperature_mean, coalesce(w.precipitation_sum, 0) AS precipitation_sum,
  coalesce(w.wind_speed_max, 0) AS wind_speed_max,
  CAST(coalesce(w.precipitation_sum, 0) > 0 AS INTEGER) AS is_rainy,
  CAST(coalesce(w.precipitation_sum, 0) >= 10 AS INTEGER) AS is_heavy_rain,
  CAST(coalesce(w.temperature_mean, 0) > 25 AS INTEGER) AS is_hot,
  l.demand_lag_1, l.demand_lag_2, l.demand_lag_24, l.rolling_mean_3h,
  CAST(coalesce(lower(w.borough) = 'manhattan', false) AS INTEGER) AS borough_manhattan,
  CAST(coalesce(lower(w.borough) = 'brooklyn', false) AS INTEGER) AS borough_brooklyn,
  CAST(coalesce(lower(w.borough) = 'queens', false) AS INTEGER) AS borough_queens,
  CAST(coalesce(lower(w.borough) = 'bronx', false) AS INTEGER) AS borough_bronx,
  CAST(coalesce(lower(w.borough) = 'staten island', false) AS INTEGER) AS "borough_staten island",
  CAST(coalesce(lower(w.borough) = 'ewr', false) AS INTEGER) AS borough_ewr,
  CAST(w.borough IS NULL AS INTEGER) AS borough_nan,
  CAST(coalesce(w.service_zone = 'Yellow Zone', false) AS INTEGER) AS "service_zone_Yellow_Zone",
  CAST(coalesce(w.service_zone = 'Boro Zone', false) AS INTEGER) AS "service_zone_Boro_Zone",
  CAST(coalesce(w.service_zone = 'Airports', false) AS INTEGER) AS "service_zone_Airports",
  CAST(coalesce(w.service_zone = 'EWR', false) AS INTEGER) AS "service_zone_EWR",
  CAST(w.service_zone IS NULL AS INTEGER) AS "service_zone_nan"
FROM wide w JOIN row_lags l ON w.pulocationid = l.pulocationid AND w.hour_ts = l.hour_ts
WHERE l.demand_lag_24 IS NOT NULL""",
    # Persistence forecast: each hour predicts the next observed one.
    "preds": """
SELECT hour_ts, pulocationid, demand AS label, CAST(demand_lag_1 AS DOUBLE) AS prediction
FROM row_lags WHERE demand_lag_1 IS NOT NULL""",
    "scored_preds": """
SELECT hour_ts, pulocationid, prediction,
  round(greatest(0.0, least(1.0, (prediction - 1.0) / 4.0)), 4) AS score
FROM preds""",
    # Serving requests: every hour of the fact asks for its two busiest-listed zones and one unknown.
    "requests": """
SELECT CAST(epoch(hour_ts) AS BIGINT) AS request_id, hour_ts AS ts,
  list_distinct([min(pulocationid), max(pulocationid), 99]) AS zone_ids
FROM fact GROUP BY hour_ts""",
    "history": """
SELECT pulocationid, hour(hour_ts) AS h, dayofweek(hour_ts) AS d, avg(demand) AS avg_demand FROM fact GROUP BY 1, 2, 3""",
    # Monthly drift tables.
    "monthly": """
SELECT CAST(date_trunc('month', hour_ts) AS DATE) AS data_month, avg(target_demand) AS c1, avg(is_urgent) AS c2,
  avg(status_p) AS c3 FROM x3 GROUP BY 1""",
    "overall": """
SELECT avg(target_demand) AS r1, avg(is_urgent) AS r2, avg(status_p) AS r3 FROM x3""",
    "drift_raw": """
SELECT data_month, 'target_demand' AS feature, r1 AS ref, c1 AS cur FROM monthly, overall
UNION ALL SELECT data_month, 'day_of_week', r2, c2 FROM monthly, overall
UNION ALL SELECT data_month, 'temperature_mean', r3, c3 FROM monthly, overall""",
    "drift_scored": """
SELECT data_month, feature, round(ref, 6) AS reference_value, round(cur, 6) AS current_value,
  round(least(20 * least(abs(cur - ref) / abs(ref), 1.0), 1.0), 4) AS drift_score FROM drift_raw""",
    "drift_rows": """
SELECT data_month, feature, 'numeric_mean_shift' AS feature_type, reference_value, current_value, drift_score,
  CASE WHEN drift_score >= 0.8 THEN 'Critical' WHEN drift_score >= 0.55 THEN 'High'
    WHEN drift_score >= 0.3 THEN 'Medium' ELSE 'Healthy' END AS severity
FROM drift_scored""",
    "drift_months": """
SELECT data_month, round(avg(drift_score), 6) AS avg_feature_drift,
  CAST(count(*) FILTER (drift_score >= 0.55) AS INTEGER) AS high_drift_count,
  CAST(count(*) FILTER (drift_score >= 0.8) AS INTEGER) AS critical_count,
  max(drift_score) FILTER (feature = 'target_demand') AS label_drift_score,
  max(severity) FILTER (feature = 'target_demand') AS label_severity,
  bool_or(drift_score >= 0.3) FILTER (feature = 'target_demand') AS label_should_alert,
  max(drift_score) FILTER (feature = 'temperature_mean') AS model_rmse_ratio,
  max(severity) FILTER (feature = 'temperature_mean') AS model_severity,
  bool_or(drift_score >= 0.95) FILTER (feature = 'temperature_mean') AS model_should_alert
FROM drift_rows GROUP BY 1""",
    "drift_summary": """
SELECT *, CAST(data_month + INTERVAL 2 MONTH AS DATE) AS execution_date,
  CASE WHEN critical_count > 0 OR label_severity = 'Critical' THEN 'Critical'
    WHEN high_drift_count >= 2 OR label_should_alert OR model_should_alert THEN 'High'
    WHEN avg_feature_drift >= 0.3 OR label_drift_score >= 0.3 THEN 'Medium' ELSE 'Low' END AS overall_status,
  false AS training_triggered
FROM drift_months""",
}

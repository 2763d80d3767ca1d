"""Fixture tables as Spark frames; the SQL twins are in ``fixtures_sql``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from zonepulse import schemas as S
from zonepulse.functions.score import demand_score, feature_kind, relative_shift, severity
from zonepulse.operators import drift as D
from zonepulse.operators.conform import conform, union_by_name
from zonepulse.operators.demand import zone_hour_demand
from zonepulse.operators.features import add_calendar, join_weather, join_zone
from zonepulse.operators.lags import lag_features, lag_rows
from zonepulse.plans.features import build_features

# Borough that stands for each region.
BOROUGH_OF = {
    "AFRICA": "Manhattan",
    "AMERICA": "Brooklyn",
    "ASIA": "Queens",
    "EUROPE": "Bronx",
    "MIDDLE EAST": "Staten Island",
}
FIRST_DAY, LAST_DAY = "2024-01-01", "2024-01-31"
KEY = "check-key"


_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table; its footer is read once, later reads name the schema."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def x1(spark, sf):
    e, c = table(spark, sf, "events"), table(spark, sf, "customer")
    return e.join(c, e.user_id == c.c_custkey).select(
        "event_id",
        F.col("ts").alias("pickup_datetime"),
        (F.col("ts") + F.expr("interval 10 minutes")).alias("dropoff_datetime"),
        F.col("c_nationkey").alias("pulocationid"),
        (F.col("event_id") % 25).cast("int").alias("dolocationid"),
        F.col("value").alias("trip_distance"),
        (F.col("value") * 2).alias("total_amount"),
        F.col("event_type").alias("taxi_type"),
    )


def _lines(spark, sf):
    li, o = table(spark, sf, "lineitem"), table(spark, sf, "orders")
    return li.join(o, li.l_orderkey == o.o_orderkey).withColumn(
        "flag", F.when(F.col("l_returnflag") == "A", "Y").when(F.col("l_returnflag") == "N", "N").otherwise("?")
    )


def _ids():
    return [
        (F.col("o_custkey") % 266).cast("int").alias("PULocationID"),
        (F.col("l_partkey") % 266).cast("int").alias("DOLocationID"),
    ]


def x2_a(spark, sf):
    return _lines(spark, sf).filter("l_linestatus = 'F'").select(
        F.col("l_suppkey").alias("VendorID"),
        F.col("o_orderdate").alias("tpep_pickup_datetime"),
        F.col("l_shipdate").alias("tpep_dropoff_datetime"),
        *_ids(),
        F.col("l_quantity").alias("trip_distance"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("flag").alias("store_and_fwd_flag"),
    )


def x2_b(spark, sf):
    return _lines(spark, sf).filter("l_linestatus <> 'F'").select(
        F.col("o_orderdate").alias("pickup_datetime"),
        F.col("l_shipdate").alias("dropoff_datetime"),
        *_ids(),
        F.col("l_quantity").alias("trip_miles"),
        F.col("l_extendedprice").alias("base_passenger_fare"),
        F.col("l_tax").alias("tolls"),
        F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("congestion_surchage"),
        F.col("flag").alias("shared_request_flag"),
    )


def conformed(spark, sf):
    return union_by_name(conform(x2_a(spark, sf), "yellow"), conform(x2_b(spark, sf), "fhvhv"))


def x3(spark, sf):
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    return o.join(c, o.o_custkey == c.c_custkey).select(
        "o_orderkey",
        F.col("o_orderdate").alias("hour_ts"),
        F.col("o_totalprice").alias("target_demand"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("is_urgent"),
        (F.col("o_orderstatus") == "P").cast("int").alias("status_p"),
        F.col("c_nationkey").alias("pulocationid"),
    )


def x4(spark, sf):
    n, r = table(spark, sf, "nation"), table(spark, sf, "region")
    borough = F.lit(None).cast("string")
    for region, name in BOROUGH_OF.items():
        borough = F.when(F.col("r_name") == region, name).otherwise(borough)
    kinds = F.array(*map(F.lit, S.SERVICE_ZONES))
    service = F.when(F.col("n_nationkey") != 24, F.get(kinds, F.col("n_nationkey") % 4))
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        F.col("n_nationkey").alias("location_id"), borough.alias("borough"), F.col("n_name").alias("zone"), service.alias("service_zone")
    )


def x4_raw(spark, sf):
    return x4(spark, sf).select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"), F.col("zone").alias("Zone"), "service_zone"
    )


def x5(spark, sf):
    trips = x1(spark, sf).join(x4(spark, sf), F.col("pulocationid") == F.col("location_id"))
    day, size = F.day("pickup_datetime"), F.length("borough")
    return (
        trips.filter((day + size) % 7 != 0)
        .groupBy(F.to_date("pickup_datetime").alias("date"), "borough")
        .agg(
            ((F.max("trip_distance") + F.min("trip_distance")) / 4).alias("temperature_mean"),
            F.max(((day * 7 + size * 3) % 15).cast("double")).alias("precipitation_sum"),
            F.round(F.max("trip_distance") / 10, 4).alias("wind_speed_max"),
        )
    )


def x6(spark, sf):
    pairs = [
        F.array(F.get("embedding", F.lit(2 * i)).cast("double"), F.get("embedding", F.lit(2 * i + 1)).cast("double"))
        for i in range(32)
    ]
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), "label", F.array(*pairs).alias("ring"))


def points(spark, sf):
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        "label",
        F.get("embedding", F.lit(0)).cast("double").alias("x"),
        F.get("embedding", F.lit(1)).cast("double").alias("y"),
    )


def fact(spark, sf):
    return zone_hour_demand(x1(spark, sf))


def row_lags(spark, sf):
    return lag_features(fact(spark, sf).select("hour_ts", "pulocationid", "demand"), "pulocationid", "hour_ts", "demand")


def wide(spark, sf):
    return (
        fact(spark, sf)
        .transform(join_zone, x4(spark, sf))
        .transform(join_weather, x5(spark, sf))
        .transform(add_calendar)
    )


def features(spark, sf, mode="rows"):
    return build_features(fact(spark, sf), x4(spark, sf), x5(spark, sf), FIRST_DAY, LAST_DAY, mode)


def preds(spark, sf):
    lagged = lag_rows(fact(spark, sf).select("hour_ts", "pulocationid", "demand"), "pulocationid", "hour_ts", "demand", (1,))
    return lagged.filter(F.col("demand_lag_1").isNotNull()).select(
        "hour_ts", "pulocationid", F.col("demand").alias("label"), F.col("demand_lag_1").cast("double").alias("prediction")
    )


def scored_preds(spark, sf):
    return preds(spark, sf).select("hour_ts", "pulocationid", "prediction", demand_score("prediction", 1.0, 5.0).alias("score"))


def requests(spark, sf):
    zones = F.array_distinct(F.array(F.min("pulocationid"), F.max("pulocationid"), F.lit(99)))
    return fact(spark, sf).groupBy(F.col("hour_ts").alias("ts")).agg(zones.alias("zone_ids")).select(
        F.unix_timestamp("ts").alias("request_id"), "ts", "zone_ids"
    )


def drift_rows(spark, sf):
    rows = x3(spark, sf)
    sources = {"target_demand": "target_demand", "day_of_week": "is_urgent", "temperature_mean": "status_p"}
    overall = rows.agg(F.struct(*[F.avg(c).alias(f) for f, c in sources.items()]).alias("r")).scalar()
    monthly = rows.groupBy(F.trunc(F.to_date("hour_ts"), "month").alias("data_month")).agg(
        *[F.avg(c).alias(f) for f, c in sources.items()]
    )
    entries = [F.struct(F.lit(f).alias("feature"), overall[f].alias("ref"), F.col(f).alias("cur")) for f in sources]
    long = monthly.select("data_month", F.inline(F.array(*entries)))
    score = F.round(F.least(20 * relative_shift("ref", "cur"), F.lit(1.0)), 4)
    return long.select(
        "data_month",
        "feature",
        feature_kind("feature").alias("feature_type"),
        F.round("ref", 6).alias("reference_value"),
        F.round("cur", 6).alias("current_value"),
        score.alias("drift_score"),
        severity(score).alias("severity"),
    )


def drift_summary(spark, sf):
    def of(feature, c):
        return F.max(F.when(F.col("feature") == feature, c))

    s = F.col("drift_score")
    months = drift_rows(spark, sf).groupBy("data_month").agg(
        F.round(F.avg(s), 6).alias("avg_feature_drift"),
        F.count_if(s >= S.HIGH).cast("int").alias("high_drift_count"),
        F.count_if(s >= S.CRITICAL).cast("int").alias("critical_count"),
        of("target_demand", s).alias("label_drift_score"),
        of("target_demand", F.col("severity")).alias("label_severity"),
        of("target_demand", s >= S.LABEL_DRIFT_ALERT).alias("label_should_alert"),
        of("temperature_mean", s).alias("model_rmse_ratio"),
        of("temperature_mean", F.col("severity")).alias("model_severity"),
        of("temperature_mean", s >= 0.95).alias("model_should_alert"),
    )
    return months.withColumns(
        {
            "execution_date": F.add_months("data_month", 2),
            "overall_status": D.overall_status(),
            "training_triggered": F.lit(False),
        }
    ).select(*S.DRIFT_SUMMARY.names)


def drift_features(spark, sf):
    """The monthly series under monitored feature names, for the drift job."""
    return (
        x3(spark, sf)
        .transform(add_calendar)
        .select(
            "pulocationid",
            "hour_ts",
            "target_demand",
            "day_of_week",
            "month",
            "is_weekend",
            F.col("is_urgent").alias("borough_manhattan"),
            F.col("status_p").alias("borough_brooklyn"),
        )
    )


def rounded(df: DataFrame, digits: int = 6, cols=None) -> DataFrame:
    """Doubles rounded for comparison, integers widened."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        kind = f.dataType.typeName()
        if kind in ("double", "float") and (cols is None or f.name in cols):
            # Adding zero turns a negative zero into zero.
            c = F.round(c, digits) + F.lit(0.0)
        elif kind in ("integer", "short", "byte"):
            c = c.cast("long")
        out.append(c.alias(f.name))
    return df.select(*out)


def bag(*dfs: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)

"""Monthly jobs from raw rows to stored tables, and the pruning of serving reads."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators import lags as L
from zonepulse.plans import etl
from zonepulse.sources import readers as R, writers as W

TRIPS = "VendorID long, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, PULocationID int, DOLocationID int, trip_distance double, total_amount double"


def at(day, hour, month=1):
    return dt.datetime(2024, month, day, hour)


@pytest.fixture
def feeds(spark):
    rows = [(1, at(5, 9), at(5, 10), 4, 5, 2.0, 10.0), (1, at(5, 9), at(5, 10), 4, 5, 4.0, 20.0), (1, at(6, 9), at(6, 10), 7, 5, 1.0, 5.0)]
    return {"yellow": spark.createDataFrame(rows, TRIPS), "fhvhv": None}


def zones(spark, *ids):
    return spark.createDataFrame([(i,) for i in ids], "location_id int")


def test_fact_job_writes_once_and_again_on_demand(spark, feeds, tmp_path):
    path = str(tmp_path / "fact")
    assert etl.store_fact(spark, feeds, zones(spark, 4, 7), path, 2024, 1, "key")
    first = sorted(spark.read.parquet(path).collect())
    assert [(r.pulocationid, r.demand, r.year_month) for r in first] == [(4, 2, "2024-01"), (7, 1, "2024-01")]
    assert not etl.store_fact(spark, feeds, zones(spark, 4, 7), path, 2024, 1, "key")
    assert etl.store_fact(spark, feeds, zones(spark, 4, 7), path, 2024, 1, "key", overwrite=True)
    assert sorted(spark.read.parquet(path).collect()) == first


def test_fact_job_writes_nothing_if_a_rule_fails(spark, feeds, tmp_path):
    path = str(tmp_path / "fact")
    with pytest.raises(ValueError, match="unknown_zone"):
        etl.store_fact(spark, feeds, zones(spark, 4), path, 2024, 1, "key")
    with pytest.raises(ValueError, match="empty"):
        etl.store_fact(spark, feeds, zones(spark, 4, 7), path, 2024, 2, "key")
    assert not (tmp_path / "fact").exists()


def test_zone_job(spark, tmp_path):
    path = str(tmp_path / "zones")
    raw = spark.createDataFrame([(1, "Queens", "a", "Boro Zone"), (2, "Bronx", "b", "Boro Zone")], S.ZONE_RAW)
    etl.store_zone_dim(raw, path)
    stored = spark.read.csv(path, header=True)
    assert len(list((tmp_path / "zones").glob("part-*.csv"))) == 1
    assert sorted((r.location_id, r.borough, r.zone) for r in stored.collect()) == [("1", "Queens", "a"), ("2", "Bronx", "b")]
    with pytest.raises(ValueError, match="duplicate_key"):
        etl.store_zone_dim(raw.union(raw), str(tmp_path / "twice"))
    assert not (tmp_path / "twice").exists()


def test_weather_job(spark, tmp_path):
    path = str(tmp_path / "weather")
    rows = [(f"2024-01-{d:02d}", "1.5", "0.0", "9.0", b) for d in range(1, 32) for b in S.WEATHER_BOROUGHS]
    raw = spark.createDataFrame(rows, "date string, temperature_mean string, precipitation_sum string, wind_speed_max string, borough string")
    with pytest.raises(ValueError, match="full_month"):
        etl.store_weather_dim(spark, raw.where("date <> '2024-01-31'"), path, 2024, 1)
    assert not R.period_exists(spark, path, "year_month=2024-01")
    assert etl.store_weather_dim(spark, raw, path, 2024, 1)
    assert not etl.store_weather_dim(spark, raw, path, 2024, 1)
    assert spark.read.parquet(path).count() == len(rows)


def test_serving_reads_are_cut_to_the_requested_hours(spark, tmp_path):
    path = str(tmp_path / "fact")
    hour = F.timestamp_add("HOUR", F.col("id"), F.lit("2024-01-01").cast("date").cast("timestamp_ntz"))
    fact = spark.range(24 * 120).select(hour.alias("hour_ts"), F.lit(1).alias("pulocationid"), F.col("id").alias("demand"))
    W.write_period(W.with_period(fact, "hour_ts"), path)
    asked = spark.createDataFrame([(1, at(1, 5, 3)), (1, at(20, 0, 3)), (2, at(3, 0, 3)), (1, None)], "pulocationid int, hour_ts timestamp_ntz")
    found = L.lags_at_offsets(spark.read.parquet(path), asked, "pulocationid", "hour_ts")
    text = found._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*year_month[^\]]*ubquery", text)
    assert re.search(r"DataFilters: \[[^\]]*hour_ts[^\]]*ubquery", text)
    rows = {(r.pulocationid, r.hour_ts): r for r in found.collect()}
    # 1 March is day 60 of a leap year, and its lag of 24 hours lies in the folder before.
    assert rows[1, at(1, 5, 3)].demand_lag_24 == 59 * 24 + 5 and rows[1, at(1, 5, 3)].demand_lag_1 == 60 * 24 + 4
    assert rows[1, at(20, 0, 3)].rolling_mean_3h == 79 * 24 - 2
    assert rows[2, at(3, 0, 3)].demand_lag_1 is None and rows[1, None].demand_lag_1 is None and len(rows) == 4

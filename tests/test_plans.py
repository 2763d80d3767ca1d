"""What the physical plans must show: pruning, pushdown, few exchanges."""

import pytest
from pyspark.sql import functions as F

from zonepulse import schemas as S
from zonepulse.operators import conform as C, demand as D, features as FT, lags as L, profile as P, quality as Q, ranking as K
from zonepulse.plans import etl
from zonepulse.sources import readers as R, writers as W


@pytest.fixture(scope="module")
def trips(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "trips")
    hour = F.timestamp_add("MINUTE", F.col("id"), F.lit("2024-01-01").cast("date").cast("timestamp_ntz"))
    spark.range(100_000).select(
        F.lit(1).cast("long").alias("VendorID"),
        hour.alias("tpep_pickup_datetime"),
        (hour + F.expr("interval 9 minutes")).alias("tpep_dropoff_datetime"),
        (F.col("id") % 260).cast("int").alias("PULocationID"),
        (F.col("id") % 250).cast("int").alias("DOLocationID"),
        (F.col("id") % 30).cast("double").alias("trip_distance"),
        (F.col("id") % 90).cast("double").alias("total_amount"),
        F.col("id").cast("string").alias("unused_text"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return plan(df).count("Exchange hashpartitioning")


def test_fact_job_prunes_and_pushes_down(trips):
    text = plan(etl.build_fact({"yellow": trips, "fhvhv": None}, 2024, 2, "key"))
    assert "unused_text" not in text and "VendorID" not in text
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "LessThan(tpep_pickup_datetime" in pushed
    assert "GreaterThanOrEqual(trip_distance" in pushed
    assert text.count("Exchange") == 1
    assert "partial_count" in text


def test_month_filter_reaches_the_scan(trips):
    text = plan(D.in_month(trips, "tpep_pickup_datetime", 2024, 1))
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in text[text.index("PushedFilters") :]


def test_quality_rules_take_one_scan_and_one_key_exchange(trips):
    fact = D.zone_hour_demand(trips, "tpep_pickup_datetime", "PULocationID").withColumnRenamed("PULocationID", "pulocationid")
    checked = Q.check_fact(fact.withColumn("row_fingerprint", F.lit("x")))
    text = plan(checked)
    assert text.count("FileScan") == 1
    assert exchanges(checked) == 1


def test_many_statistics_one_scan(trips):
    for df in (P.null_rates(trips), P.correlations(trips, ["trip_distance", "total_amount"]), P.anomaly_counts(trips, {"a": F.col("trip_distance") > 1})):
        text = plan(df)
        assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_small_dimension_is_broadcast_by_spark_itself(spark, trips, tmp_path):
    path = str(tmp_path / "zones")
    spark.createDataFrame([(1, "Queens", "z", None)], S.ZONE).write.parquet(path)
    zone = spark.read.parquet(path)
    fact = trips.select(F.col("PULocationID").alias("pulocationid"), F.col("tpep_pickup_datetime").alias("hour_ts"))
    assert "BroadcastHashJoin" in plan(FT.join_zone(fact, zone))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" in plan(FT.join_zone(fact, zone))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lag_windows_share_one_node_and_are_split(trips):
    fact = trips.select(F.col("PULocationID").alias("z"), F.col("tpep_pickup_datetime").alias("t"), F.col("total_amount").alias("v"))
    for mode, nodes in (("rows", 3), ("time", 1)):
        text = plan(L.lag_features(fact, "z", "t", "v", mode))
        assert text.count("- Window [") == nodes
        assert "_span" in text
    # The tails are cut from the rows as dealt out for the window itself, so there is no exchange to cut before.
    tails = plan(L.lag_features(fact, "z", "t", "v", "rows"))
    assert tails.count("WindowGroupLimit") == 1
    assert tails.count("hashpartitioning(z") == tails.count("REPARTITION_BY_COL") + 1


def test_top_k_is_a_heap(trips):
    assert "TakeOrderedAndProject" in plan(K.top_n(trips, "total_amount", "PULocationID", 5))


def test_latest_period_with_literal_pushes_down(trips):
    _, live = R.split_latest_period(trips, "tpep_pickup_datetime", at="2024-02-01")
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan(live)


def test_period_folders_are_pruned_and_hot_ones_split(spark, trips, tmp_path):
    path = str(tmp_path / "by_month")
    rows = W.with_period(trips, "tpep_pickup_datetime")
    assert "RebalancePartitions" in rows.hint("rebalance", "year_month")._jdf.queryExecution().optimizedPlan().toString()
    W.write_period(rows, path)
    text = plan(spark.read.parquet(path).filter("year_month = '2024-02'"))
    assert "PartitionFilters: [isnotnull(year_month" in text
    stored = D.in_window(spark.read.parquet(path), "tpep_pickup_datetime", "2024-02-03", "2024-02-05")
    assert "PartitionFilters: [isnotnull(year_month" in plan(stored) and stored.count() == 3 * 24 * 60
    before = spark.read.parquet(path).count()
    W.write_period(rows.filter("year_month = '2024-02'").limit(5), path)
    after = spark.read.parquet(path).groupBy("year_month").count().collect()
    assert before == 100_000 and {r[0]: r[1] for r in after}["2024-02"] == 5 and len(after) == 3
    assert R.period_exists(spark, path, "year_month=2024-02") and not R.period_exists(spark, path, "year_month=2020-01")


def test_conform_is_one_projection(trips):
    optimized = C.conform(trips, "yellow")._jdf.queryExecution().optimizedPlan().toString()
    assert optimized.count("Project") == 1




def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_payload_lookup_never_brings_a_payload_to_a_request(spark):
    from checks import QUERIES

    text = optimized(QUERIES["S8_payload_at"](spark, "/root/testdata/sf0.001"))
    top = text[: text.index("Generate")]
    assert "Join LeftOuter" in top and "payload" not in top and "from_json" not in top


def test_content_hash_check_deals_rows_out_by_size(spark, monkeypatch):
    from checks import QUERIES
    from zonepulse.operators import integrity as I

    seen = []
    hashed = I.content_hash
    monkeypatch.setattr(I, "content_hash", lambda df: seen.append(optimized(df)) or hashed(df))
    QUERIES["A30_content_hash"](spark, "/root/testdata/sf0.001")
    dealt = [x for x in seen if "epartition" in x or "ebalance" in x]
    assert len(dealt) == 1 and "RebalancePartitions" in dealt[0]

"""Zone-hour demand and the time filters around it."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions.columns import as_col
from zonepulse.functions.time import epoch, hour_bucket, month_end, month_start, shift_months, typed_time

MEASURES = {"avg_trip_distance": "trip_distance", "avg_total_amount": "total_amount"}


def zone_hour_demand(
    trips: DataFrame,
    ts: str = "pickup_datetime",
    zone: str = "pulocationid",
    measures: Mapping[str, str] = MEASURES,
) -> DataFrame:
    """Trips per hour and zone, with averages.

    Partial aggregation runs before the one exchange, so a busy zone sends
    one row per hour and task, however many trips it has.
    """
    averages = [F.avg(as_col(src)).alias(out) for out, src in measures.items()]
    return trips.groupBy(hour_bucket(ts).alias("hour_ts"), as_col(zone).alias(zone)).agg(
        F.count("*").alias("demand"), *averages
    )


PERIOD = "year_month"


def _pruned(df: DataFrame, first: str, last: str) -> DataFrame:
    """Months ``first`` to ``last`` of a table stored in period folders; others are left as they are."""
    return df.filter(F.col(PERIOD).between(first, last)) if PERIOD in df.columns else df


def in_month(df: DataFrame, ts: str, year: int, month: int) -> DataFrame:
    """Half-open month range on the raw column, so that it reaches the scan."""
    this = f"{year}-{month:02d}"
    nxt = f"{year + month // 12}-{month % 12 + 1:02d}"
    inside = (F.col(ts) >= typed_time(df, ts, f"{this}-01")) & (F.col(ts) < typed_time(df, ts, f"{nxt}-01"))
    return _pruned(df, this, this).filter(inside)


def in_window(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows from ``start`` to the end of day ``end``."""
    stop = F.date_add(F.lit(end).cast("date"), 1).cast(df.schema[ts].dataType)
    return _pruned(df, start[:7], end[:7]).filter((F.col(ts) >= typed_time(df, ts, start)) & (F.col(ts) < stop))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def time_bounds(df: DataFrame, ts: str) -> DataFrame:
    return df.agg(F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))


def densify(fact: DataFrame, zone: str = "pulocationid", ts: str = "hour_ts", value: str = "demand", split_hours: int = 744) -> DataFrame:
    """Every hour between a zone's first and last, absent ones with value 0.

    A zone's time is cut into stretches of ``split_hours``, which are dealt out before their hours are made, so one
    stray time far away makes many small pieces rather than one long row.
    """
    ends = fact.groupBy(zone).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    hours = F.floor((epoch("_hi") - epoch("_lo")) / 3600)
    cut = ends.withColumn("_part", F.explode(F.sequence(F.lit(0), F.floor(hours / split_hours)))).repartition(zone, "_part")
    first = F.col("_part") * split_hours
    offset = F.explode(F.sequence(first, F.least(first + split_hours - 1, hours)))
    grid = cut.withColumn("_hour", offset).select(zone, (F.col("_lo") + F.make_dt_interval(hours=F.col("_hour").cast("int"))).cast(fact.schema[ts].dataType).alias(ts))
    return grid.join(fact, [zone, ts], "left").fillna({value: 0})


def run_windows(run_dates: DataFrame, date_col: str = "run_date", first_run: str | None = None) -> DataFrame:
    """Feature and training windows of each run: target month is two months back.

    ``first_run`` names a boolean column; such a run takes the full history.
    """
    target = shift_months(date_col, -2)
    start = month_start(target)
    if first_run is not None:
        start = F.when(F.col(first_run), F.lit("2023-01-01").cast("date")).otherwise(start)
    return run_dates.select(
        date_col,
        start.alias("start_date"),
        month_end(target).alias("end_date"),
        month_start(shift_months(target, -36)).alias("train_start"),
    )

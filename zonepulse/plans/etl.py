"""Monthly jobs: fact, zone dimension, weather dimension."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from zonepulse.operators.conform import clean_trips, conform, union_present
from zonepulse.operators.demand import PERIOD, in_month, zone_hour_demand
from zonepulse.operators.dims import cast_weather, conform_zones
from zonepulse.operators.integrity import apply_fingerprint
from zonepulse.operators.quality import (
    assert_expectations,
    check_fact,
    check_lookup,
    check_references,
    check_weather,
    check_weather_raw,
    check_zones,
)
from zonepulse.operators.ranking import first_per_key
from zonepulse.sources.readers import period_exists
from zonepulse.sources.writers import export_csv, with_period, write_period


def build_fact(
    feeds: Mapping[str, DataFrame | None], year: int, month: int, key: str, strict: bool = False
) -> DataFrame:
    """Raw feeds to one month of signed zone-hour demand.

    The month is cut on the raw pickup time, before the aggregation, and so
    reaches the scan; of the canonical columns only those in use are read.
    """
    conformed = {feed: None if df is None else conform(df, feed) for feed, df in feeds.items()}
    trips = clean_trips(union_present(conformed))
    fact = zone_hour_demand(in_month(trips, "pickup_datetime", year, month))
    return apply_fingerprint(fact, key, strict)


def build_zone_dim(raw: DataFrame) -> DataFrame:
    return first_per_key(conform_zones(raw), ["location_id"])


def build_weather_dim(raw: DataFrame) -> DataFrame:
    return first_per_key(cast_weather(raw), ["date", "borough"])


def _write_checked(df: DataFrame, checks, write) -> None:
    """Check rules first, then write; the frame is computed once. A failed rule raises and nothing is written."""
    df = df.persist()
    try:
        for check in checks:
            assert_expectations(check(df))
        write(df)
    finally:
        df.unpersist()


def _stored(spark: SparkSession, path: str, year: int, month: int) -> bool:
    return period_exists(spark, path, f"{PERIOD}={year}-{month:02d}")


def store_fact(
    spark: SparkSession,
    feeds: Mapping[str, DataFrame | None],
    zones: DataFrame,
    path: str,
    year: int,
    month: int,
    key: str,
    strict: bool = False,
    overwrite: bool = False,
) -> bool:
    """One month from raw feeds to its period folder; False if the folder already holds it and ``overwrite`` is not set."""
    if not overwrite and _stored(spark, path, year, month):
        return False
    _write_checked(
        build_fact(feeds, year, month, key, strict),
        [check_fact, lambda fact: check_references(fact, zones)],
        lambda fact: write_period(with_period(fact, "hour_ts"), path),
    )
    return True


def store_zone_dim(raw: DataFrame, path: str) -> None:
    """The zone lookup, checked before and after, as one CSV file."""
    assert_expectations(check_lookup(raw))
    _write_checked(build_zone_dim(raw), [check_zones], lambda zones: export_csv(zones, path, files=1))


def store_weather_dim(
    spark: SparkSession, raw: DataFrame, path: str, year: int, month: int, overwrite: bool = False
) -> bool:
    """One month of daily weather, checked before and after, to its period folder; False as for ``store_fact``."""
    if not overwrite and _stored(spark, path, year, month):
        return False
    assert_expectations(check_weather_raw(raw, year, month))
    _write_checked(
        build_weather_dim(raw), [check_weather], lambda weather: write_period(with_period(weather, "date"), path)
    )
    return True

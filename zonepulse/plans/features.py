"""The feature table job."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, functions as F

from zonepulse.operators.demand import in_window
from zonepulse.operators.dims import fill_weather
from zonepulse.operators.features import (
    add_calendar,
    add_cyclical,
    add_weather_flags,
    drop_incomplete,
    encode_location,
    join_weather,
    join_zone,
    select_features,
    with_target,
)
from zonepulse.operators.lags import SPLIT_DAYS, lag_features

def build_features(
    fact: DataFrame,
    zone: DataFrame,
    weather: DataFrame,
    start: str,
    end: str,
    mode: str = "rows",
    lookback: int = 0,
    split_days: int | None = SPLIT_DAYS,
    carried: DataFrame | None = None,
) -> DataFrame:
    """Fact and dimensions to model features for ``[start, end]`` days.

    Lags are taken first, on four narrow columns, so the one wide exchange of
    the window carries no join output. ``lookback`` days before the start feed
    the lags but are not returned; ``carried`` rows (hour_ts, pulocationid, demand) from before
    the start do so too, without a read of earlier facts: the last 24 of each zone are all that row lags need.
    """
    early = str(date.fromisoformat(start) - timedelta(days=lookback))
    known = in_window(fact, "hour_ts", early, end).filter(F.col("pulocationid").isNotNull())
    rows = known.select("hour_ts", "pulocationid", "demand")
    if carried is not None:
        earlier = carried.select(*[F.col(f.name).cast(f.dataType) for f in rows.schema.fields])
        rows = rows.unionByName(earlier.filter(F.col("hour_ts") < F.lit(early).cast("date")))
    lagged = lag_features(rows, "pulocationid", "hour_ts", "demand", mode, split_days)
    return (
        in_window(lagged, "hour_ts", start, end)
        .transform(drop_incomplete)
        .transform(join_zone, zone)
        .transform(join_weather, in_days(weather, start, end))
        .transform(add_calendar)
        .transform(add_cyclical)
        .transform(fill_weather)
        .transform(add_weather_flags)
        .transform(encode_location)
        .transform(with_target)
        .transform(select_features)
    )


def in_days(weather: DataFrame, start: str, end: str) -> DataFrame:
    """Dimension rows of the window's days."""
    return weather.filter(F.to_date("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))

"""Zone and weather dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.text import clean_text

# Lookup header to dimension column.
ZONE_NAMES = {"LocationID": "location_id", "Borough": "borough", "Zone": "zone", "service_zone": "service_zone"}


def conform_zones(df: DataFrame) -> DataFrame:
    return df.select(*[as_col(raw).alias(name) for raw, name in ZONE_NAMES.items()])


def cast_weather(df: DataFrame) -> DataFrame:
    """Dates and measures from text; what does not parse becomes null."""
    return df.select(*[as_col(f.name).try_cast(f.dataType).alias(f.name) for f in S.WEATHER.fields])


def fill_weather(df: DataFrame, default: float = 0.0) -> DataFrame:
    return df.fillna({c: default for c in S.WEATHER_COLUMNS})


def trimmed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: clean_text(c) for c in cols})


def restrict_keys(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in the list; a repeated list entry changes nothing."""
    return df.join(ids.select(key).distinct(), key, "left_semi")


def known_category(df: DataFrame, col: str, bad: Sequence[str] = S.UNKNOWN_BOROUGHS) -> DataFrame:
    return df.filter(as_col(col).isNotNull() & ~as_col(col).isin(*bad))


def weather_by_zone(zones: DataFrame, weather: DataFrame) -> DataFrame:
    """Zone id with its borough's weather; nulls where the borough is unknown."""
    named = zones.select("location_id", clean_text("borough").alias("borough"))
    values = weather.select(clean_text("borough").alias("borough"), *[c for c in weather.columns if c != "borough"])
    return named.join(values, "borough", "left").select(
        "location_id", "borough", *[c for c in weather.columns if c != "borough"]
    )


def missing_members(df: DataFrame, col: str, expected: DataFrame) -> DataFrame:
    """Expected members that do not occur in the column."""
    seen = df.select(as_col(col).alias(col)).distinct()
    return expected.select(col).join(seen, col, "left_anti")

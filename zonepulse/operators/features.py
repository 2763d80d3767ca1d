"""Joins and encodings of the feature table."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.text import column_suffix, normalise
from zonepulse.functions.time import dow_mon0
from zonepulse.operators.ranking import first_per_key


def join_zone(fact: DataFrame, zone: DataFrame, fk: str = "pulocationid") -> DataFrame:
    """Fact with zone columns; the dimension is made unique first.

    No hint: Spark broadcasts the zones while they are small by its own size
    check, and otherwise shuffles, splitting skewed keys at run time.
    """
    dim = first_per_key(zone.select("location_id", "borough", "zone", "service_zone"), ["location_id"])
    return fact.join(dim.withColumnRenamed("location_id", fk), fk, "left")


def join_weather(df: DataFrame, weather: DataFrame, ts: str = "hour_ts", borough: str = "borough") -> DataFrame:
    """Daily weather by date and normalised borough; of several rows for both the least counts."""
    keyed = weather.select(
        F.to_date("date").alias("_date"), normalise("borough").alias("_borough"), *S.WEATHER_COLUMNS
    )
    left = df.withColumns({"_date": F.to_date(ts), "_borough": normalise(borough)})
    return left.join(first_per_key(keyed, ["_date", "_borough"]), ["_date", "_borough"], "left").drop("_date", "_borough")


def add_calendar(df: DataFrame, ts: str = "hour_ts") -> DataFrame:
    """Hour, Monday-first weekday, month, weekend flag and date."""
    dow = dow_mon0(ts)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "day_of_week": dow,
            "month": F.month(ts),
            "is_weekend": dow.isin(5, 6).cast("int"),
            "pickup_date": F.to_date(ts),
        }
    )


def add_cyclical(df: DataFrame, periods: Mapping[str, tuple[str, int]] | None = None) -> DataFrame:
    """Sine and cosine of cyclic columns: ``{column: (prefix, period)}``."""
    periods = periods or {"hour": ("hour", 24), "day_of_week": ("dow", 7)}
    out = {}
    for c, (prefix, period) in periods.items():
        angle = F.lit(2 * math.pi) * as_col(c) / F.lit(period)
        out[f"{prefix}_sin"], out[f"{prefix}_cos"] = F.sin(angle), F.cos(angle)
    return df.withColumns(out)


def add_weather_flags(df: DataFrame, rain: float = 0, heavy: float = 10, hot: float = 25) -> DataFrame:
    return df.withColumns(
        {
            "is_rainy": (F.col("precipitation_sum") > rain).cast("int"),
            "is_heavy_rain": (F.col("precipitation_sum") >= heavy).cast("int"),
            "is_hot": (F.col("temperature_mean") > hot).cast("int"),
        }
    )


def one_hot(df: DataFrame, col: str, vocab: Sequence[str], prefix: str, spaces: bool = True) -> DataFrame:
    """0/1 column per known value and one for null; never null itself."""
    c = as_col(col)
    out = {
        f"{prefix}_{v if spaces else column_suffix(v)}": F.coalesce(c == v, F.lit(False)).cast("int") for v in vocab
    }
    out[f"{prefix}_nan"] = c.isNull().cast("int")
    return df.withColumns(out)


def one_hot_decode(df: DataFrame, cols: Sequence[str], labels: Sequence[str], out: str) -> DataFrame:
    """Label of the largest column, the first one on ties."""
    values = F.array(*[as_col(c) for c in cols])
    place = F.array_position(values, F.array_max(values)).cast("int")
    return df.withColumn(out, F.element_at(F.array(*map(F.lit, labels)), F.nullif(place, F.lit(0))))


def encode_location(df: DataFrame) -> DataFrame:
    """Borough and service-zone one-hots in the fixed vocabularies."""
    return (
        df.withColumn("borough", normalise("borough"))
        .transform(one_hot, "borough", S.BOROUGHS, "borough")
        .transform(one_hot, "service_zone", S.SERVICE_ZONES, "service_zone", False)
    )


def with_target(df: DataFrame, col: str = "demand") -> DataFrame:
    return df.withColumn("target_demand", as_col(col))


def drop_incomplete(df: DataFrame, cols: Sequence[str] = S.LAG_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(cols))


def select_features(df: DataFrame) -> DataFrame:
    """The feature table's columns in their one fixed order."""
    return df.select(*[as_col(f.name).cast(f.dataType).alias(f.name) for f in S.FEATURE_TABLE.fields])

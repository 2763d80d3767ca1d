"""Exploratory aggregates of the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions.columns import as_col


def demand_profile(df: DataFrame, keys: Sequence[str], value: str = "demand") -> DataFrame:
    """Mean by each key on its own, as (key, value, avg_demand).

    All keys share one scan and one exchange through grouping sets.
    """
    keys = list(keys)
    sets = df.groupingSets([[as_col(k) for k in [key]] for key in keys], *[as_col(k) for k in keys])
    means = sets.agg(F.avg(as_col(value)).alias("avg_demand"), F.grouping_id().alias("_set"))
    top = len(keys) - 1
    name, shown = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, k in enumerate(keys):
        this = F.col("_set") == (2 ** len(keys) - 1 - 2 ** (top - i))
        name, shown = F.when(this, k).otherwise(name), F.when(this, as_col(k).cast("string")).otherwise(shown)
    return means.select(name.alias("key"), shown.alias("value"), "avg_demand")


def daily_total(df: DataFrame, ts: str, value: str) -> DataFrame:
    return df.groupBy(F.to_date(ts).alias("pickup_date")).agg(F.sum(as_col(value)).alias("total")).orderBy("pickup_date")


def dense_mean(
    df: DataFrame, key: str, domain: Sequence, value: str, fill: float = 0.0, names: Sequence[str] | None = None
) -> DataFrame:
    """Mean per member of a fixed domain; absent members get ``fill``."""
    members = F.array(
        *[F.struct(F.lit(m).alias(key), F.lit(n).alias("name")) for m, n in zip(domain, names or map(str, domain))]
    )
    full = df.sparkSession.range(1).select(F.inline(members))
    means = df.groupBy(as_col(key).alias(key)).agg(F.avg(as_col(value)).alias("mean"))
    return full.join(means, key, "left").withColumn("mean", F.coalesce("mean", F.lit(fill)))


def mean_by(df: DataFrame, key: str, value: str) -> DataFrame:
    means = df.groupBy(as_col(key).alias(key)).agg(F.avg(as_col(value)).alias("mean"))
    return means.orderBy(F.col("mean").desc(), F.col(key).asc())


def busiest_zones(df: DataFrame, k: int = 10, zone: str = "pulocationid", value: str = "target_demand") -> DataFrame:
    return mean_by(df, zone, value).limit(k)

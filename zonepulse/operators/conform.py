"""Differently shaped trip feeds to one schema, cleaned and stacked."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.score import null_safe_total
from zonepulse.functions.text import yn_flag

# Raw column names, by feed.
RENAMES = {
    "VendorID": "vendor_id",
    "RatecodeID": "ratecode_id",
    "PULocationID": "pulocationid",
    "DOLocationID": "dolocationid",
    "trip_miles": "trip_distance",
    "base_passenger_fare": "fare_amount",
    "tips": "tip_amount",
    "tolls": "tolls_amount",
    "congestion_surchage": "congestion_surcharge",
}
FEED_TIMES = {
    "yellow": {"tpep_pickup_datetime": "pickup_datetime", "tpep_dropoff_datetime": "dropoff_datetime"},
    "fhvhv": {},
}
FEED_TOTALS = {
    "fhvhv": ("fare_amount", "tolls_amount", "congestion_surcharge", "airport_fee", "cbd_congestion_fee"),
}


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist.

    If several columns end up under one name, ignoring case, their first
    non-null value wins, the one already so named going first.
    """
    targets: dict[str, list[str]] = {}
    spelling: dict[str, str] = {}
    for c in df.columns:
        out = mapping.get(c, c)
        low = out.lower()
        spelling.setdefault(low, out)
        if c == out or c.lower() == low:
            targets.setdefault(low, []).insert(0, c)
        else:
            targets.setdefault(low, []).append(c)
            spelling[low] = out
    return df.select(*[F.coalesce(*map(as_col, src)).alias(spelling[low]) for low, src in targets.items()])


def unify_times(df: DataFrame, feed: str) -> DataFrame:
    """The feed's own time columns under the common names."""
    times = {old: new for old, new in FEED_TIMES[feed].items() if old in df.columns}
    kept = [c for c in df.columns if c not in times.values()]
    return df.select(*[as_col(c).alias(times.get(c, c)) for c in kept])


def fill_missing(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Add absent columns as typed nulls; names match without regard to case."""
    present = {c.lower() for c in df.columns}
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name.lower() not in present]
    return df.select(*[as_col(c) for c in df.columns], *absent)


def canonical(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns in its order."""
    actual = {c.lower(): c for c in df.columns}
    return df.select(*[as_col(actual[f.name.lower()]).alias(f.name) for f in schema.fields])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """All types in one projection; text that does not parse becomes null."""
    kinds = {f.name: f.dataType for f in schema.fields}
    out = []
    for field in df.schema.fields:
        kind = kinds.get(field.name)
        if kind is None or field.dataType == kind:
            out.append(as_col(field.name))
        elif isinstance(kind, T.BooleanType):
            out.append(yn_flag(field.name).alias(field.name))
        elif isinstance(field.dataType, T.NullType):
            out.append(F.lit(None).cast(kind).alias(field.name))
        else:
            out.append(as_col(field.name).try_cast(kind).alias(field.name))
    return df.select(*out)


def tag(df: DataFrame, col: str, value) -> DataFrame:
    return df.withColumn(col, F.lit(value))


def conform(df: DataFrame, feed: str, schema: T.StructType = S.TRIP) -> DataFrame:
    """One raw feed in the canonical layout, its total filled in where the feed has none."""
    out = tag(df, "taxi_type", feed).transform(unify_times, feed).transform(rename_present, RENAMES)
    out = out.transform(fill_missing, schema)
    if feed in FEED_TOTALS:
        out = out.withColumn("total_amount", null_safe_total(*FEED_TOTALS[feed]))
    return out.transform(canonical, schema).transform(cast_to, schema)


def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def stack(*dfs: DataFrame) -> DataFrame:
    """Bag union in which a frame may lack columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_present(dfs: Mapping[str, DataFrame | None]) -> DataFrame:
    """Stack whichever feeds exist; an error if none does."""
    present = [df for df in dfs.values() if df is not None]
    if not present:
        raise ValueError(f"no feed present among {sorted(dfs)}")
    return stack(*present)


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows in which all the columns are set."""
    return df.filter(_all(as_col(c).isNotNull() for c in cols))


def ordered_times(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.filter(as_col(start) < as_col(end))


def exclude_ids(df: DataFrame, cols: Sequence[str], ids: Sequence[int]) -> DataFrame:
    return df.filter(_all(~as_col(c).isin(*ids) for c in cols))


def non_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with values of zero or more; nulls drop out as well."""
    return df.filter(_all(as_col(c) >= 0 for c in cols))


def _all(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def clean_trips(df: DataFrame, excluded: Sequence[int] = S.EXCLUDED_LOCATION_IDS) -> DataFrame:
    """All row filters of the fact job."""
    return (
        df.transform(require, ["pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid"])
        .transform(ordered_times, "pickup_datetime", "dropoff_datetime")
        .transform(exclude_ids, ["pulocationid", "dolocationid"], excluded)
        .transform(non_negative, ["trip_distance", "total_amount"])
    )

"""Table replacement as frame algebra: what the target looks like afterwards.

Nothing here writes; store the result at a new path (or as period folders)
so that a job never overwrites the files it is reading.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions.time import typed_time


def _keep_and_add(target: DataFrame, new: DataFrame, replaced) -> DataFrame:
    kept = target.filter(~F.coalesce(replaced, F.lit(False)))
    return kept.unionByName(new, allowMissingColumns=True)


def replace_observed_range(target: DataFrame, new: DataFrame, ts: str) -> DataFrame:
    """Drop the closed time range that ``new`` spans, then append it."""
    span = new.agg(F.struct(F.min(ts).alias("lo"), F.max(ts).alias("hi")).alias("span")).scalar()
    return _keep_and_add(target, new, F.col(ts).between(span["lo"], span["hi"]))


def replace_window(target: DataFrame, new: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Drop ``[start, end + 1 day)``, then append."""
    lo = typed_time(target, ts, start)
    hi = F.date_add(F.lit(end).cast("date"), 1).cast(target.schema[ts].dataType)
    return _keep_and_add(target, new, (F.col(ts) >= lo) & (F.col(ts) < hi))


def replace_month(target: DataFrame, new: DataFrame, date_col: str, year: int, month: int) -> DataFrame:
    """Drop one calendar month, then append."""
    first = F.lit(f"{year}-{month:02d}-01").cast("date")
    kind = target.schema[date_col].dataType
    inside = (F.col(date_col) >= first.cast(kind)) & (F.col(date_col) < F.add_months(first, 1).cast(kind))
    return _keep_and_add(target, new, inside)


def upsert(target: DataFrame, new: DataFrame, key: Sequence[str], update_cols: Sequence[str]) -> DataFrame:
    """Insert new keys; for known keys take only ``update_cols`` from the new row.

    Both sides are unique on the key, so the full join adds no rows.
    """
    key = list(key)
    old = target.withColumn("_old", F.lit(True)).alias("o")
    fresh = new.withColumn("_new", F.lit(True)).alias("n")
    joined = old.join(fresh, key, "full_outer")
    out = []
    for c in target.columns:
        if c in key:
            out.append(F.col(c))
        elif c not in new.columns:
            out.append(F.col(f"o.{c}").alias(c))
        elif c in update_cols:
            out.append(F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c))
        else:
            out.append(F.when(F.col("_old"), F.col(f"o.{c}")).otherwise(F.col(f"n.{c}")).alias(c))
    return joined.select(*out)


def replace_children(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Drop every target row whose key occurs in ``new``, then append."""
    kept = target.join(new.select(key).distinct(), key, "left_anti")
    return kept.unionByName(new, allowMissingColumns=True)


def set_where(df: DataFrame, key: str, value, col: str, new) -> DataFrame:
    """Conditional update of one column."""
    hit = F.col(key) == F.lit(value).cast(df.schema[key].dataType)
    return df.withColumn(col, F.when(hit, F.lit(new)).otherwise(F.col(col)))

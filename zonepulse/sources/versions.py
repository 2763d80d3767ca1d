"""Tables in month folders under one root, and a numbered file that says which folders count.

A job writes the months it changes to a new folder and then publishes a version: one small file, renamed into place, that
names the folders of all tables. Other months keep their files. Readers follow the latest version, so a job that dies before
the rename leaves the tables as they were, and tables published together are seen together. One writer at a time; a second
one that comes to the same number fails.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonepulse.functions.columns import as_col

MONTH = "_month"
#: Folder of rows without a time.
NO_MONTH = "none"


@dataclass
class Version:
    """``folders``: for each table, the folder of each month, relative to the root."""

    number: int = 0
    folders: dict[str, dict[str, str]] = field(default_factory=dict)


class _Files:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.path(root.rstrip("/"))
        self.fs = self.root.getFileSystem(self.conf)
        self.gateway = spark.sparkContext._gateway

    def path(self, *parts):
        return self.jvm.org.apache.hadoop.fs.Path(*parts)

    def under(self, *names: str):
        return self.path(self.root, "/".join(names))

    def names(self, folder) -> list[str]:
        return sorted(s.getPath().getName() for s in self.fs.listStatus(folder)) if self.fs.exists(folder) else []

    def text(self, file) -> str:
        stream = self.fs.open(file)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, file, text: str) -> None:
        """Write aside, then rename; an existing file is never replaced."""
        aside = self.path(file.getParent(), f".{uuid.uuid4().hex}")
        stream = self.fs.create(aside, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        none = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.root.toUri(), self.conf).rename(aside, file, none)


def current(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The latest version, or the one of that number; an empty one where none is published."""
    files = _Files(spark, root)
    found = [n for n in files.names(files.under("_versions")) if n.endswith(".json") and not n.startswith(".")]
    if number is not None:
        found = [n for n in found if int(n[:-5]) == number]
    if not found:
        return Version()
    return Version(int(found[-1][:-5]), json.loads(files.text(files.under("_versions", found[-1]))))


def publish(spark: SparkSession, root: str, old: Version, changes: Mapping[str, Mapping[str, str | None]]) -> Version:
    """The version after ``old``: each table's months with new folders, or without those given as None."""
    folders = {t: dict(months) for t, months in old.folders.items()}
    for table, months in changes.items():
        mine = folders.setdefault(table, {})
        for month, folder in months.items():
            if folder is None:
                mine.pop(month, None)
            else:
                mine[month] = folder
    new = Version(old.number + 1, folders)
    files = _Files(spark, root)
    files.fs.mkdirs(files.under("_versions"))
    files.put(files.under("_versions", f"{new.number:012d}.json"), json.dumps(folders, sort_keys=True))
    return new


def read_version(
    spark: SparkSession, root: str, table: str, schema: T.StructType, version: Version | None = None, first: str | None = None, last: str | None = None
) -> DataFrame:
    """A table at a version (default: the latest); of months ``first`` to ``last`` only, if given. Other folders are not opened."""
    held = (version or current(spark, root)).folders.get(table, {})
    chosen = [f for m, f in sorted(held.items()) if (first is None or m >= first) and (last is None or m <= last)]
    if not chosen:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root.rstrip('/')}/{f}" for f in chosen])


def _with_month(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn(MONTH, F.coalesce(F.date_format(as_col(ts).cast("date"), "yyyy-MM"), F.lit(NO_MONTH)))


def stage(df: DataFrame, root: str, table: str, ts: str) -> dict[str, str]:
    """Write a table's rows to a new folder; the folder of each month in it. Nothing reads them until they are published."""
    folder = f"{table}/{uuid.uuid4().hex}"
    _with_month(df, ts).hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(f"{root.rstrip('/')}/{folder}")
    files = _Files(df.sparkSession, root)
    return {n.split("=", 1)[1]: f"{folder}/{n}" for n in files.names(files.under(folder)) if n.startswith(f"{MONTH}=")}


def staged_replacement(new: DataFrame, root: str, table: str, ts: str, lo, hi, old: Version, closed: bool = False) -> dict[str, str | None]:
    """Changes that drop a table's rows with ``lo <= ts < hi`` (``closed``: or equal to ``hi``) and add ``new``.

    Only the months that the window or the new rows meet are read and written.
    """
    spark, held = new.sparkSession, old.folders.get(table, {})
    kind = new.schema[ts].dataType
    bounds = F.struct(F.lit(lo).cast(kind).cast("date").alias("a"), F.lit(hi).cast(kind).cast("date").alias("b"))
    ends = spark.range(1).select(F.date_format(bounds["a"], "yyyy-MM"), F.date_format(bounds["b"], "yyyy-MM")).first()
    # One row per month: as many as the table has folders.
    fresh = {r[0] for r in _with_month(new, ts).select(MONTH).distinct().collect()}
    touched = {m for m in held if m != NO_MONTH and ends[0] is not None and ends[0] <= m <= ends[1]} | (fresh & set(held))
    upper = F.col(ts) <= F.lit(hi).cast(kind) if closed else F.col(ts) < F.lit(hi).cast(kind)
    inside = F.coalesce((F.col(ts) >= F.lit(lo).cast(kind)) & upper, F.lit(False))
    kept = read_version(spark, root, table, new.schema, Version(folders={table: {m: held[m] for m in touched}})).filter(~inside)
    written = stage(kept.unionByName(new), root, table, ts)
    return {m: written.get(m) for m in touched | set(written)}


def replace_between(new: DataFrame, root: str, table: str, ts: str, lo, hi, closed: bool = False) -> Version:
    """Replace a table's rows of a half-open (or closed) time range and publish."""
    spark = new.sparkSession
    old = current(spark, root)
    return publish(spark, root, old, {table: staged_replacement(new, root, table, ts, lo, hi, old, closed)})


def replace_observed(new: DataFrame, root: str, table: str, ts: str) -> Version:
    """Replace the closed range that ``new`` spans; without any time in it, only add its rows."""
    lo, hi = new.agg(F.min(ts), F.max(ts)).first()
    return replace_between(new, root, table, ts, lo, hi, closed=True)


def replace_days(new: DataFrame, root: str, table: str, ts: str, start: str, end: str) -> Version:
    """Replace ``[start, end + 1 day)``."""
    after = new.sparkSession.range(1).select(F.date_add(F.lit(end).cast("date"), 1)).first()[0]
    return replace_between(new, root, table, ts, start, after)


def replace_one_month(new: DataFrame, root: str, table: str, date_col: str, year: int, month: int) -> Version:
    """Replace one calendar month."""
    after = f"{year + month // 12}-{month % 12 + 1:02d}-01"
    return replace_between(new, root, table, date_col, f"{year}-{month:02d}-01", after)


def expire(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete versions before the last ``keep``, and folders that none of the rest names; how many folders went.

    Not while a job runs: its folders are not named yet.
    """
    files = _Files(spark, root)
    numbers = sorted(int(n[:-5]) for n in files.names(files.under("_versions")) if n.endswith(".json") and not n.startswith("."))
    if not numbers:
        return 0
    held = [current(spark, root, n).folders for n in numbers[-keep:]]
    named = {f.rsplit("/", 1)[0] for folders in held for months in folders.values() for f in months.values()}
    tables = {t for folders in held for t in folders}
    gone = [f"{t}/{n}" for t in sorted(tables) for n in files.names(files.under(t)) if f"{t}/{n}" not in named]
    for n in numbers[:-keep]:
        files.fs.delete(files.under("_versions", f"{n:012d}.json"), False)
    for folder in gone:
        files.fs.delete(files.under(folder), True)
    return len(gone)

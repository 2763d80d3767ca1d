"""Scans: monthly trip files, CSV dimensions, tables and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.time import date_trunc, hour_bucket, typed_time


def trip_path(root: str, dataset: str, year: int, month: int) -> str:
    return f"{root.rstrip('/')}/taxi/{dataset}_tripdata_{year}-{month:02d}.parquet"


def read_trips(spark: SparkSession, root: str, dataset: str, year: int, month: int) -> DataFrame:
    """One feed and month; the column set is whatever the file footer says."""
    return spark.read.parquet(trip_path(root, dataset, year, month))


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV by its header, in the order of the fixed layout."""
    return _by_header(spark, path, S.ZONE_RAW)


def _by_header(spark: SparkSession, path: str, layout: T.StructType) -> DataFrame:
    """All-string CSV whose columns are found by name, whatever their case or order; text that does not parse is null."""
    raw = spark.read.csv(path, header=True)
    found = {c.lower(): c for c in raw.columns}
    absent = [f.name for f in layout.fields if f.name.lower() not in found]
    if absent:
        raise ValueError(f"{path} lacks the columns {absent}")
    return raw.select(*[as_col(found[f.name.lower()]).try_cast(f.dataType).alias(f.name) for f in layout.fields])


def read_zones_lower(spark: SparkSession, path: str) -> DataFrame:
    """Zone lookup CSV under lower-case headers, keyed by ``location_id``."""
    raw = read_zones(spark, path)
    return raw.toDF(*[c.lower() for c in raw.columns]).withColumnRenamed("locationid", "location_id")


def read_weather_csv(spark: SparkSession, path: str) -> DataFrame:
    """All-string CSV, cast afterwards; text that does not parse becomes null."""
    return _by_header(spark, path, S.WEATHER)


def read_table(spark: SparkSession, name: str, root: str | None = None, jdbc: dict | None = None) -> DataFrame:
    """A named table: Parquet under ``root`` by default, else one JDBC partition."""
    if jdbc is None:
        return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet" if root else name)
    options = {"fetchsize": "1000", "numPartitions": "1", **jdbc}
    return spark.read.format("jdbc").options(dbtable=name, **options).load()


def range_predicates(column: str, lo: int, hi: int, n: int) -> list[str]:
    """``n`` disjoint predicates that together cover every row, nulls with the first."""
    n = max(1, min(n, hi - lo))
    cuts = [lo + (hi - lo) * i // n for i in range(1, n)]
    if not cuts:
        return ["1 = 1"]
    first = f"{column} < {cuts[0]} OR {column} IS NULL"
    middle = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:])]
    return [first, *middle, f"{column} >= {cuts[-1]}"]


def read_table_range(
    spark: SparkSession, query: str, column: str, lo: int, hi: int, n: int, jdbc: dict | None = None
) -> DataFrame:
    """Range-split scan of a query, one JDBC partition per range.

    Without ``jdbc`` the query runs on Spark's own tables, whose files are
    already split, and the ranges only label the rows (``range_id``).
    """
    predicates = range_predicates(column, lo, hi, n)
    if jdbc is not None:
        options = dict(jdbc)
        url = options.pop("url")
        return spark.read.jdbc(url, f"({query}) AS source_query", predicates=predicates, properties=options)
    label = F.lit(None).cast("int")
    for i, predicate in reversed(list(enumerate(predicates))):
        label = F.when(F.expr(predicate), i).otherwise(label)
    return spark.sql(query).withColumn("range_id", label)


def file_profile(spark: SparkSession, path: str) -> DataFrame:
    """Row count and column names of a Parquet file; reads no column data."""
    df = spark.read.parquet(path)
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count("*").alias("rows")).select("rows", names.alias("columns"))


def explode_payload(
    df: DataFrame, json_col: str, fields: dict[str, tuple[str, str]], tag: tuple[str, str], section: str = "daily"
) -> DataFrame:
    """Parallel arrays inside a JSON payload to rows.

    ``fields`` maps an output name to (payload array, type); ``tag`` is
    (output name, source column) for the value that labels the payload.
    """
    parsed = _parse_payload(json_col, section, [name for name, _ in fields.values()])
    zipped = F.arrays_zip(*[parsed[name].alias(out) for out, (name, _) in fields.items()])
    rows = df.select(F.explode(zipped).alias("_p"), as_col(tag[1]).alias(tag[0]))
    return rows.select(*[F.col("_p")[out].try_cast(kind).alias(out) for out, (_, kind) in fields.items()], tag[0])


def payload_at(
    df: DataFrame, json_col: str, ts_col: str, fields: dict[str, str], section: str = "hourly", time_field: str = "time"
) -> DataFrame:
    """The array slot whose time is the request's hour; nulls if there is none.

    Works inside the row, so a payload never has to be exploded or joined. It is parsed for every row; where many requests
    share a payload, ``payload_lookup`` parses it once.
    """
    parsed = _parse_payload(json_col, section, [time_field, *fields.values()])
    slot = F.array_position(parsed[time_field], _slot_time(ts_col)).cast("int")
    return df.withColumns(
        {
            out: F.when(slot > 0, F.try_element_at(parsed[name], slot)).try_cast("double")
            for out, name in fields.items()
        }
    )


def payload_lookup(
    df: DataFrame,
    payloads: DataFrame,
    on: list[str],
    json_col: str,
    ts_col: str,
    fields: dict[str, str],
    section: str = "hourly",
    time_field: str = "time",
) -> DataFrame:
    """As ``payload_at`` for payloads in a table of their own, one for each value of the columns ``on``.

    Each payload is parsed once, its slots become rows (the first of equal times), and the requests join them on ``on`` and the
    hour. A request without payload or slot stays, with nulls. Columns of ``payloads`` other than ``on`` are dropped.
    """
    parsed = _parse_payload(json_col, section, [time_field, *fields.values()])
    none = F.expr("cast(array() AS array<string>)")
    arrays = [F.coalesce(parsed[name], none).alias(f"_v{i}") for i, name in enumerate(fields.values())]
    held = payloads.select(*on, parsed[time_field].alias("_times"), F.arrays_zip(parsed[time_field].alias("_time"), *arrays).alias("_zipped"))
    slots = held.select(*on, "_times", F.posexplode("_zipped").alias("_at", "_slot"))
    first = slots.where(F.array_position("_times", F.col("_slot._time")) == F.col("_at") + 1)
    values = [F.col(f"_slot._v{i}").try_cast("double").alias(out) for i, out in enumerate(fields)]
    asked = df.drop(*fields).withColumn("_time", _slot_time(ts_col))
    return asked.join(first.select(*on, "_slot._time", *values), [*on, "_time"], "left").drop("_time")


def _slot_time(ts_col: str):
    return F.date_format(hour_bucket(ts_col), "yyyy-MM-dd'T'HH:mm")


def _parse_payload(json_col: str, section: str, arrays: list[str]):
    inner = T.StructType([T.StructField(a, T.ArrayType(T.StringType())) for a in arrays])
    return F.from_json(as_col(json_col), T.StructType([T.StructField(section, inner)]))[section]


def split_latest_period(df: DataFrame, ts: str, unit: str = "month", at: str | None = None):
    """(rows before, rows from) the start of the latest period, or of the given one.

    ``at`` is a literal and so prunes files; without it a one-row maximum is
    planned as a scalar subquery of both halves.
    """
    if at is not None:
        start = typed_time(df, ts, at)
    else:
        latest = df.agg(date_trunc(unit, F.max(ts)).cast(df.schema[ts].dataType).alias("start"))
        start = latest.scalar()
    return df.filter(F.col(ts) < start), df.filter(F.col(ts) >= start)


def period_exists(spark: SparkSession, path: str, period: str | None = None) -> bool:
    """True if the period's folder already holds Parquet part files."""
    target = f"{path.rstrip('/')}/{period}" if period else path
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(target)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(folder, "part-*.parquet"))
    return found is not None and len(found) > 0


def load_model(path: str):
    """A saved pipeline; assembler and regressor travel together."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)

"""Order, top-k, de-duplication and ranks that do not need one big task."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from zonepulse.functions.columns import as_col

#: Sampled rows for each range of a rank.
SAMPLE = 32


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key, the least by all columns (or by ``order`` first).

    A minimum over a struct pre-aggregates on the map side, so a key with very
    many copies costs one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    lead = list(order or [])
    ordered = lead + [c for c in rest if c not in lead]
    best = F.min(F.struct(*[as_col(c) for c in ordered])).alias("_best")
    rows = df.groupBy(*keys).agg(best)
    return rows.select(*[as_col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def sorted_by(df: DataFrame, cols: Sequence[str], desc: bool = False) -> DataFrame:
    return df.orderBy(*[as_col(c).desc() if desc else as_col(c).asc() for c in cols])


def top_n(df: DataFrame, score: str, tie: str, n: int) -> DataFrame:
    """Highest scores first; plans as a per-task heap and one merge."""
    return df.orderBy(as_col(score).desc(), as_col(tie).asc()).limit(n)


def rank_within(df: DataFrame, part: Sequence[str], dist: str, tie: str, name: str = "rank") -> DataFrame:
    """Rank inside a group by ascending distance."""
    return _rank(df, part, [(dist, False), (tie, False)], name)


def rank_by(df: DataFrame, score: str, tie: str, within: Sequence[str] = (), name: str = "rank") -> DataFrame:
    """Rank by descending score (a number), ties by ascending id; over the whole table or inside groups."""
    return _rank(df, within, [(score, True), (tie, False)], name)


def _ascending(df: DataFrame, col: str, desc: bool) -> list[Column]:
    """Columns whose ascending order is the wanted one: nulls first and NaN last, or the reverse."""
    c = as_col(col)
    kind = df.select(c).schema[0].dataType
    if not desc:
        return [c]
    if not isinstance(kind, T.NumericType):
        raise TypeError(f"a descending rank needs a number, not {col} of type {kind.simpleString()}")
    falling = F.bitwise_not(c) if isinstance(kind, T.IntegralType) else -c
    no_number = F.isnan(c) if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType) else F.lit(False)
    return [c.isNull(), ~F.coalesce(no_number, F.lit(False)), falling]


def _literals(rows: Sequence, kind: T.StructType) -> Column:
    """Rows as an array of structs of that type."""
    def literal(value, field):
        plain = value is None or isinstance(field, (T.BooleanType, T.NumericType, T.StringType, T.TimestampType)) and not isinstance(field, T.DecimalType)
        return F.lit(value if plain else str(value)).cast(field)

    structs = [F.struct(*[literal(r[f.name], f.dataType).alias(f.name) for f in kind.fields]) for r in rows]
    return F.array(*structs).cast(T.ArrayType(kind))


def _place(key: Column, borders: Column, step: int = 16) -> Column:
    """How many of the sorted borders come before the key: first among every ``step``-th, then between two of those."""
    coarse = F.size(F.filter(F.transform(F.sequence(F.lit(step), F.greatest(F.size(borders), F.lit(step)), F.lit(step)), lambda i: F.get(borders, i - 1)), lambda b: b < key))
    return coarse * step + F.size(F.filter(F.slice(borders, coarse * step + 1, step), lambda b: b < key))


def _rank(df: DataFrame, part: Sequence[str], order: Sequence[tuple[str, bool]], name: str) -> DataFrame:
    """Row number per group, by one way for groups of any size.

    Borders from a sample cut the order of (group, order) into about as many ranges as there are shuffle partitions. A
    window numbers the rows of each range and group, so no task sorts more than a range's rows however large a group is. A group
    that goes on over borders has its earlier rows counted, and their number is added: at most one group enters a range from the one before, so
    these are a few numbers per range. The input is read for the sample, for the counts (both read the key columns
    only) and for the result, and must give the same rows each time.
    """
    spark = df.sparkSession
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2)
    group = [as_col(p).alias(f"_g{i}") for i, p in enumerate(part)]
    key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate([*map(as_col, part), *[x for col, desc in order for x in _ascending(df, col, desc)]])])
    keys = df.select(key.alias("_key"))
    sampled = keys.orderBy(F.rand(7)).limit(SAMPLE * ranges).orderBy("_key")
    found = sampled.collect()
    borders = _literals([r["_key"] for r in found[SAMPLE // 2 :: SAMPLE]], keys.schema["_key"].dataType)
    placed = df.withColumn("_range", _place(key, borders))
    counts = placed.select("_range", *group).groupBy("_range", *[f"_g{i}" for i in range(len(part))]).agg(F.count("*").alias("n"))
    parts = counts.groupBy(*[f"_g{i}" for i in range(len(part))]).agg(F.array_sort(F.collect_list(F.struct("_range", "n"))).alias("parts"))
    # A range border makes one group go on; so these are at most two entries per range.
    wide = parts.filter(F.size("parts") > 1).collect()
    number = F.row_number().over(Window.partitionBy("_range", *map(as_col, part)).orderBy(*[as_col(c).desc() if desc else as_col(c).asc() for c, desc in order])).cast("long")
    if wide:
        entries = []
        for row in wide:
            before = 0
            for at in row["parts"]:
                entries.append((at["_range"], *row[:-1], before))
                before += at["n"]
        kinds = [("_range", "int"), *[(f"_g{i}", df.select(as_col(p)).schema[0].dataType) for i, p in enumerate(part)], ("before", "long")]
        schema = T.StructType([T.StructField(n, T.LongType() if k == "long" else T.IntegerType() if k == "int" else k) for n, k in kinds])
        table = spark.createDataFrame([e for e in entries if e[-1]], schema)
        by_range = table.agg(F.map_from_entries(F.collect_list(F.struct("_range", F.struct(*schema.names[1:])))).alias("m")).scalar()
        mine = F.try_element_at(by_range, F.col("_range"))
        same = reduce(lambda a, b: a & b, [mine[f"_g{i}"].eqNullSafe(as_col(p)) for i, p in enumerate(part)], mine["before"].isNotNull())
        number = number + F.when(same, mine["before"]).otherwise(F.lit(0))
    return placed.select(*[as_col(c) for c in df.columns], number.alias(name))


def ordered_union(first: DataFrame, second: DataFrame, key: Sequence[str]) -> DataFrame:
    """Distinct keys of both frames with ``priority`` 0 (first) or 1 (second only)."""
    key = list(key)
    both = first.select(*key, F.lit(0).alias("priority")).unionByName(
        second.select(*key, F.lit(1).alias("priority"))
    )
    return both.groupBy(*key).agg(F.min("priority").alias("priority"))

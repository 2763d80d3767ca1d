"""Data-quality rules: (table_name, rule, severity, failing, detail) rows.

All rules of a table are aggregates of one pass; a rule with ``failing`` 0
has passed. Duplicate keys need the one exchange on the key, and the other
counts ride along on it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.functions.text import try_date, try_number
from zonepulse.functions.time import days_in_month
from zonepulse.operators.integrity import content_hash

ERROR, WARNING = "error", "warning"


def _rule(table: str, rule: str, severity: str, failing, detail=None) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(rule).alias("rule"),
        F.lit(severity).alias("severity"),
        F.coalesce(failing.cast("long"), F.lit(0)).cast("long").alias("failing"),
        (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
    )


def _schema_rules(df: DataFrame, table: str, required: Sequence[str]) -> list[Column]:
    missing = S.missing_columns(df, required)
    detail = F.lit(", ".join(missing)) if missing else None
    return [
        _rule(table, "empty", ERROR, (F.coalesce("_rows", F.lit(0)) == 0).cast("int")),
        _rule(table, "missing_columns", ERROR, F.lit(len(missing)), detail),
    ]


def expectations(
    df: DataFrame,
    table: str,
    required: Sequence[str],
    key: Sequence[str] = (),
    rules: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Emptiness, required columns, row conditions and duplicate keys of one table.

    If required columns are missing only the schema rules are reported.
    """
    rules = dict(rules or {})
    if S.missing_columns(df, required):
        key, rules = (), {}
    hits = [F.count_if(cond).alias(f"_r{i}") for i, (_, cond) in enumerate(rules.values())]
    if key:
        per_key = df.groupBy(*[as_col(k).alias(f"_k{i}") for i, k in enumerate(key)]).agg(
            F.count("*").alias("_n"), *hits
        )
        row = per_key.agg(
            F.sum("_n").alias("_rows"),
            F.sum(F.col("_n") - 1).alias("_dupes"),
            *[F.sum(f"_r{i}").alias(f"_r{i}") for i in range(len(rules))],
        )
    else:
        row = df.agg(F.count("*").alias("_rows"), *hits)
    out = _schema_rules(df, table, required)
    out += [_rule(table, name, sev, F.col(f"_r{i}")) for i, (name, (sev, _)) in enumerate(rules.items())]
    if key:
        out.append(_rule(table, "duplicate_key", ERROR, F.col("_dupes")))
    return row.select(F.inline(F.array(*out)))


def check_trips(df: DataFrame, feed: str) -> DataFrame:
    """Raw trips: not empty, required columns there."""
    return expectations(df, feed, S.REQUIRED[feed])


def check_lookup(df: DataFrame) -> DataFrame:
    rules = {"null_id": (ERROR, F.col("LocationID").isNull())} if "LocationID" in df.columns else {}
    return expectations(df, "lookup", S.REQUIRED["lookup"], ["LocationID"], rules)


def check_fact(df: DataFrame) -> DataFrame:
    rules: dict[str, tuple[str, Column]] = {}
    if not S.missing_columns(df, S.REQUIRED["fact_trips_pickup"]):
        for c in ("hour_ts", "pulocationid", "demand", "row_fingerprint"):
            rules[f"null_{c}"] = (ERROR, F.col(c).isNull())
        parsed = F.col("hour_ts").try_cast("timestamp_ntz")
        rules["unparseable_hour_ts"] = (ERROR, parsed.isNull())
        rules["non_positive_demand"] = (ERROR, try_number("demand") <= 0)
        rules["negative_distance"] = (ERROR, try_number("avg_trip_distance") < 0)
        rules["negative_amount"] = (WARNING, try_number("avg_total_amount") < 0)
    return expectations(df, "fact_trips_pickup", S.REQUIRED["fact_trips_pickup"], S.KEYS["fact_trips_pickup"], rules)


def check_weather(df: DataFrame) -> DataFrame:
    return expectations(df, "dim_weather", S.REQUIRED["dim_weather"], S.KEYS["dim_weather"])


def check_zones(df: DataFrame) -> DataFrame:
    rules = {"null_id": (ERROR, F.col("location_id").isNull())} if "location_id" in df.columns else {}
    return expectations(df, "dim_zone", S.REQUIRED["dim_zone"], S.KEYS["dim_zone"], rules)


def day_coverage(df: DataFrame, date: str, key: str, year: int, month: int) -> DataFrame:
    """Distinct days per key against the length of the month."""
    expected = days_in_month(F.lit(f"{year}-{month:02d}-01").cast("date"))
    return df.groupBy(key).agg(F.count_distinct(try_date(date)).alias("days")).withColumn("expected_days", expected)


def check_weather_raw(
    df: DataFrame, year: int, month: int, boroughs: Sequence[str] = S.WEATHER_BOROUGHS
) -> DataFrame:
    """Raw weather: schema, boroughs, dates, duplicates, full months, no negatives."""
    if S.missing_columns(df, S.REQUIRED["weather"]):
        return expectations(df, "weather", S.REQUIRED["weather"])
    typed = df.withColumn("_date", try_date("date"))
    base = expectations(
        typed,
        "weather",
        S.REQUIRED["weather"],
        ["_date", "borough"],
        {
            "unparseable_date": (ERROR, F.col("_date").isNull()),
            "negative_precipitation": (ERROR, try_number("precipitation_sum") < 0),
            "negative_wind": (ERROR, try_number("wind_speed_max") < 0),
        },
    )
    expected = df.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, boroughs))).alias("borough"))
    seen = day_coverage(df, "date", "borough", year, month)
    days = expected.join(seen, "borough", "left").select(
        "borough", F.coalesce("days", F.lit(0)).alias("days"), F.col("days").isNull().alias("_absent")
    )
    short = F.col("days") != days_in_month(F.lit(f"{year}-{month:02d}-01").cast("date"))
    missing = days.agg(
        F.count_if("_absent").alias("n"),
        F.concat_ws(", ", F.array_sort(F.collect_set(F.when(F.col("_absent"), F.col("borough"))))).alias("names"),
    ).select(F.inline(F.array(_rule("weather", "missing_boroughs", ERROR, F.col("n"), F.nullif("names", F.lit(""))))))
    coverage = days.select(
        F.lit("weather").alias("table_name"),
        F.concat(F.lit("full_month:"), "borough").alias("rule"),
        F.lit(ERROR).alias("severity"),
        short.cast("long").alias("failing"),
        F.when(short, F.concat(F.col("days").cast("string"), F.lit(" days"))).alias("detail"),
    )
    return base.unionByName(missing).unionByName(coverage)


def key_diff(cur: DataFrame, prev: DataFrame, key: str) -> DataFrame:
    """Ids added and removed, as (key, change)."""
    now, before = _ids(cur, key), _ids(prev, key)
    added = now.join(before, key, "left_anti").withColumn("change", F.lit("added"))
    removed = before.join(now, key, "left_anti").withColumn("change", F.lit("removed"))
    return added.unionByName(removed)


def except_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    return a.select(key).subtract(b.select(key))


def orphans(fact: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Distinct fact ids the dimension lacks; de-duplicated before the join."""
    return _ids(fact, fk).join(_ids(dim, pk).withColumnRenamed(pk, fk), fk, "left_anti")


def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(as_col(key).try_cast("long").alias(key)).filter(F.col(key).isNotNull()).distinct()


def _first_ids(ids: DataFrame, key: str, k: int) -> DataFrame:
    """Count of ids and the ``k`` lowest as text; only ``k`` ids are ever listed."""
    listed = F.transform(F.array_sort(F.collect_list(key)), lambda x: x.cast("string"))
    text = ids.orderBy(key).limit(k).agg(F.concat_ws(", ", listed).alias("_text")).scalar()
    return ids.agg(F.count("*").alias("n")).select(
        "n",
        F.when(F.col("n") > k, F.concat(text, F.lit("..."))).when(F.col("n") > 0, text).alias("listed"),
    )


def check_lookup_change(cur: DataFrame, prev: DataFrame | None, key: str = "LocationID") -> DataFrame:
    """Warnings: no previous lookup, content changed, ids added, ids removed."""
    if prev is None:
        return cur.agg(F.count("*").alias("_n")).select(
            F.inline(F.array(_rule("lookup", "no_previous", WARNING, F.lit(1))))
        )
    a = content_hash(cur).select(F.struct("n", "hash").alias("h"))
    b = content_hash(prev).select(F.struct("n", "hash").alias("h"))
    changed = a.select((F.col("h") != b.scalar()).cast("long").alias("n")).select(
        F.inline(F.array(_rule("lookup", "changed", WARNING, F.col("n"))))
    )
    parts = [changed]
    for rule, x, y in (("ids_added", cur, prev), ("ids_removed", prev, cur)):
        ids = _ids(x, key).join(_ids(y, key), key, "left_anti")
        parts.append(
            _first_ids(ids, key, 10).select(
                F.inline(F.array(_rule("lookup", rule, WARNING, F.col("n"), F.col("listed"))))
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def check_references(fact: DataFrame, zones: DataFrame, fk: str = "pulocationid", pk: str = "location_id") -> DataFrame:
    """Fact zone ids that the dimension lacks, the first 20 listed."""
    ids = orphans(fact, zones, fk, pk)
    return _first_ids(ids, fk, 20).select(
        F.inline(F.array(_rule("fact_trips_pickup", "unknown_zone", ERROR, F.col("n"), F.col("listed"))))
    )


def duplicate_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows beyond the first of each key."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    return counts.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("n"))


def assert_expectations(results: DataFrame) -> None:
    """Print warnings, raise on errors; only the failed rules reach the driver."""
    failed = results.filter(F.col("failing") > 0).collect()
    for r in failed:
        if r["severity"] == WARNING:
            print(f"WARNING: {r['table_name']}: {r['rule']} ({r['failing']}) {r['detail'] or ''}".rstrip())
    errors = [r for r in failed if r["severity"] == ERROR]
    if errors:
        lines = [f"{r['table_name']}: {r['rule']} ({r['failing']}) {r['detail'] or ''}".rstrip() for r in errors]
        raise ValueError("Validation failed:\n- " + "\n- ".join(lines))

"""Lag and rolling features per zone, with the zone's history split by date.

A window over one zone alone would put all its rows into one task. Here each
zone is cut into spans of ``split_days``, and a span also receives the few
earlier rows its first rows look back to (its halo). Every (zone, span) is a
window partition of its own, and the result is the same as without the cut.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from zonepulse.functions.columns import as_col
from zonepulse.functions.score import mean_nonzero
from zonepulse.functions.time import date_trunc, dow_sun0, epoch, hour_bucket, wrap
from zonepulse.operators.demand import PERIOD

SPLIT_DAYS = 31
HOUR = 3600


def _span(ts: Column, split_days: int) -> Column:
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date"))
    return F.floor(days / split_days).cast("int")


def _plus_hours(ts: Column, hours: int) -> Column:
    return ts + F.make_dt_interval(hours=F.lit(hours))


def _row_halo(df: DataFrame, zone: str, ts: str, value: str, depth: int, split_days: int) -> DataFrame:
    """(zone, ts, value, _span, _halo): the rows, and before each span the ``depth`` rows that precede it.

    The rows are dealt out once, before they part into both uses, so the source is read once. Only the last ``depth`` rows of a span can be looked back to. They are cut
    out, and one zone holds one short list per span.
    """
    spans = df.select(
        as_col(zone), as_col(ts), as_col(value), _span(as_col(ts), split_days).alias("_span")
    ).repartition(zone, "_span")
    latest = Window.partitionBy(zone, "_span").orderBy(F.col(ts).desc())
    tails = (
        spans.withColumn("_rn", F.row_number().over(latest))
        .filter(F.col("_rn") <= depth)
        .groupBy(zone, "_span")
        .agg(F.array_sort(F.collect_list(F.struct(ts, value))).alias("_tail"))
    )
    # A span in the list has at least one row, so ``depth`` spans back are enough.
    earlier = Window.partitionBy(zone).orderBy("_span").rowsBetween(-depth, -1)
    before = F.flatten(F.collect_list("_tail").over(earlier))
    halo = (
        tails.withColumn("_before", before)
        .select(zone, "_span", F.explode(F.slice("_before", F.greatest(F.size("_before") - depth + 1, F.lit(1)), depth)).alias("_row"))
        .select(zone, F.col("_row")[ts].alias(ts), F.col("_row")[value].alias(value), "_span", F.lit(True).alias("_halo"))
    )
    return spans.withColumn("_halo", F.lit(False)).unionByName(halo.repartition(zone, "_span"))


def _with_row_windows(df: DataFrame, zone: str, ts: str, value: str, depth: int, split_days: int | None, make) -> DataFrame:
    """Add row-offset window columns made by ``make(window)``; other columns stay."""
    if split_days is None:
        return df.withColumns(make(Window.partitionBy(zone).orderBy(ts)))
    w = Window.partitionBy(zone, "_span").orderBy(ts)
    columns = make(w)
    carried = [c for c in df.columns if c not in (zone, ts, value)]
    if carried:
        # Payload columns ride in one struct; a halo row has none.
        packed = df.select(zone, ts, F.struct(as_col(value).alias("v"), *[as_col(c) for c in carried]).alias("_v"))
        halo = _row_halo(packed, zone, ts, "_v", depth, split_days)
        out = halo.withColumn(value, F.col("_v")["v"]).withColumns(columns).filter(~F.col("_halo"))
        return out.select(
            *[F.col("_v")[c].alias(c) if c in carried else as_col(c) for c in df.columns], *[as_col(c) for c in columns]
        )
    out = _row_halo(df, zone, ts, value, depth, split_days).withColumns(columns).filter(~F.col("_halo"))
    return out.select(*[as_col(c) for c in df.columns], *[as_col(c) for c in columns])


def latest_rows(df: DataFrame, zone: str, ts: str, depth: int = 24) -> DataFrame:
    """The last ``depth`` rows of each zone; every task sends at most that many of a zone.

    Kept rows and new ones go in together, so a state of last rows grows by merging.
    """
    latest = Window.partitionBy(zone).orderBy(F.col(ts).desc())
    return df.withColumn("_rn", F.row_number().over(latest)).filter(F.col("_rn") <= depth).drop("_rn")


def lag_rows(
    df: DataFrame,
    zone: str,
    ts: str,
    value: str,
    n: Sequence[int] = (1, 2, 24),
    split_days: int | None = SPLIT_DAYS,
) -> DataFrame:
    """Value ``n`` rows back per zone, whatever the time gap."""
    return _with_row_windows(
        df, zone, ts, value, max(n), split_days, lambda w: {f"{value}_lag_{k}": F.lag(value, k).over(w) for k in n}
    )


def rolling_mean_rows(
    df: DataFrame,
    zone: str,
    ts: str,
    value: str,
    frame: tuple[int, int] = (-3, -1),
    split_days: int | None = SPLIT_DAYS,
    name: str = "rolling_mean_3h",
) -> DataFrame:
    """Mean of the preceding rows, the current one left out; short frames count."""
    return _with_row_windows(
        df, zone, ts, value, -frame[0], split_days, lambda w: {name: F.avg(value).over(w.rowsBetween(*frame))}
    )


def row_features(df: DataFrame, zone: str, ts: str, value: str, split_days: int | None = SPLIT_DAYS) -> DataFrame:
    """The four lag features by row offset, in one window pass."""

    def make(w):
        lags = {f"{value}_lag_{k}": F.lag(value, k).over(w) for k in (1, 2, 24)}
        return {**lags, "rolling_mean_3h": F.avg(value).over(w.rowsBetween(-3, -1))}

    return _with_row_windows(df, zone, ts, value, 24, split_days, make)


def _time_halo(df: DataFrame, ts: str, hours: int, split_days: int) -> DataFrame:
    """Each row in its own span, and again in the next one if that looks back to it."""
    own, later = _span(as_col(ts), split_days), _span(_plus_hours(as_col(ts), hours), split_days)
    return df.withColumn("_span", F.explode(F.sequence(own, later))).withColumn("_halo", F.col("_span") != own)


def _with_time_windows(df: DataFrame, zone: str, ts: str, hours: int, split_days: int | None, make) -> DataFrame:
    if split_days is None:
        base, part = df.withColumn("_halo", F.lit(False)), [zone]
    else:
        base, part = _time_halo(df, ts, hours, split_days), [zone, "_span"]
    base = base.withColumn("_epoch", epoch(ts))
    columns = make(Window.partitionBy(*part).orderBy("_epoch"))
    return base.withColumns(columns).filter(~F.col("_halo")).select(*[as_col(c) for c in df.columns], *[as_col(c) for c in columns])


def trailing_mean(
    df: DataFrame,
    zone: str,
    ts: str,
    value: str,
    hours: int = 3,
    split_days: int | None = SPLIT_DAYS,
    name: str = "trailing_mean",
) -> DataFrame:
    """Mean over the preceding ``hours`` by clock time, the current hour left out."""
    return _with_time_windows(
        df, zone, ts, hours, split_days, lambda w: {name: F.avg(value).over(w.rangeBetween(-hours * HOUR, -HOUR))}
    )


def time_features(df: DataFrame, zone: str, ts: str, value: str, split_days: int | None = SPLIT_DAYS) -> DataFrame:
    """The four lag features by exact hour, in one window pass over the fact itself."""

    def make(w):
        lags = {f"{value}_lag_{k}": F.max(value).over(w.rangeBetween(-k * HOUR, -k * HOUR)) for k in (1, 2, 24)}
        return {**lags, "rolling_mean_3h": F.avg(value).over(w.rangeBetween(-3 * HOUR, -HOUR))}

    return _with_time_windows(df, zone, ts, 24, split_days, make)


def lag_features(
    df: DataFrame, zone: str, ts: str, value: str, mode: str = "rows", split_days: int | None = SPLIT_DAYS
) -> DataFrame:
    """``rows`` counts observed rows back, ``time`` looks at the exact hour."""
    if mode not in ("rows", "time"):
        raise ValueError(f"unknown lag mode {mode!r}")
    return (row_features if mode == "rows" else time_features)(df, zone, ts, value, split_days)


def _spanned(fact: DataFrame, at: DataFrame, ts: str, back: int) -> DataFrame:
    """Fact rows from ``back`` hours before the first requested hour to the last; the bounds are one-row subqueries."""
    kind = fact.schema[ts].dataType
    lo = _plus_hours(hour_bucket(F.min(ts)), -back)
    hi = hour_bucket(F.max(ts))
    inside = (F.col(ts) >= at.agg(lo.cast(kind)).scalar()) & (F.col(ts) <= at.agg(hi.cast(kind)).scalar())
    if PERIOD in fact.columns:
        month = [at.agg(F.date_format(x, "yyyy-MM")).scalar() for x in (lo, hi)]
        inside &= F.col(PERIOD).between(*month)
    return fact.filter(inside)


def lags_at_offsets(
    fact: DataFrame, at: DataFrame, zone: str, ts: str, value: str = "demand", hours: Sequence[int] = (1, 2, 24)
) -> DataFrame:
    """Demand at fixed hours before each requested (zone, time), and the mean of the last three.

    Requests are de-duplicated and spread over the few hours they can touch,
    so the fact is met by an equi-join on (zone, hour). Fact times are whole
    hours; a request may lie between them. The fact is cut to the hours that the
    requests span, so its scan skips row groups and period folders outside.
    """
    wanted = at.select(zone, ts).distinct()
    fact = _spanned(fact, at, ts, max(3, *hours))
    offsets = F.array(*[F.lit(h) for h in sorted({0, 1, 2, 3, *hours})])
    probes = wanted.withColumn("_h", F.explode(offsets)).withColumn(
        "_hour", hour_bucket(ts) - F.make_dt_interval(hours=F.col("_h"))
    )
    facts = fact.select(as_col(zone).alias(zone), as_col(ts).alias("_hour"), as_col(value).alias("_value"))
    hits = probes.join(facts, [zone, "_hour"], "left")
    gap = epoch(ts) - epoch("_hour")
    exact = [F.max(F.when(gap == h * HOUR, F.col("_value"))).alias(f"{value}_lag_{h}") for h in hours]
    recent = F.avg(F.when(gap.between(HOUR, 3 * HOUR), F.col("_value"))).alias("rolling_mean_3h")
    return hits.groupBy(zone, ts).agg(*exact, recent)


def hour_dow_history(fact: DataFrame, zone: str, ts: str, value: str = "demand") -> DataFrame:
    """Mean value by zone, hour of day and weekday (Sunday = 0)."""
    return fact.groupBy(as_col(zone).alias(zone), F.hour(ts).alias("hour_of_day"), dow_sun0(ts).alias("day_of_week")).agg(
        F.avg(as_col(value)).alias("avg_demand")
    )


def history_sums(fact: DataFrame, zone: str, ts: str, value: str = "demand") -> DataFrame:
    """(zone, hour_of_day, day_of_week, data_month, total, n): what the means of ``hour_dow_history`` are made of, by month.

    Sums of months add up, so a new month is one small aggregation of its own facts.
    """
    slot = [as_col(zone).alias(zone), F.hour(ts).alias("hour_of_day"), dow_sun0(ts).alias("day_of_week"), date_trunc("month", ts).cast("date").alias("data_month")]
    return fact.groupBy(*slot).agg(F.sum(as_col(value).cast("double")).alias("total"), F.count(as_col(value)).alias("n"))


def history_means(sums: DataFrame, zone: str) -> DataFrame:
    """``hour_dow_history`` from the sums of any months."""
    merged = sums.groupBy(zone, "hour_of_day", "day_of_week").agg((F.sum("total") / F.nullif(F.sum("n"), F.lit(0))).alias("avg_demand"))
    return merged


def history_fallbacks(at: DataFrame, history: DataFrame, zone: str, ts: str) -> DataFrame:
    """Historical means for each requested slot: h-1, h-2, h-3 on the weekday, h on the day before."""
    wanted = at.select(zone, ts).distinct()
    hour, dow = F.hour(ts), dow_sun0(ts)
    slots = F.array(
        *[
            F.struct(F.lit(name).alias("slot"), h.alias("h"), d.alias("d"))
            for name, h, d in (
                ("lag_1", wrap(hour - 1, 24), dow),
                ("lag_2", wrap(hour - 2, 24), dow),
                ("lag_3", wrap(hour - 3, 24), dow),
                ("lag_24", hour, wrap(dow - 1, 7)),
            )
        ]
    )
    probes = wanted.withColumn("_s", F.explode(slots)).select(
        zone, ts, F.col("_s.slot"), F.col("_s.h").alias("hour_of_day"), F.col("_s.d").alias("day_of_week")
    )
    found = probes.join(history, [zone, "hour_of_day", "day_of_week"], "left")
    wide = found.groupBy(zone, ts).agg(
        *[
            F.coalesce(F.max(F.when(F.col("slot") == s, F.col("avg_demand"))), F.lit(0.0)).alias(f"hist_{s}")
            for s in ("lag_1", "lag_2", "lag_3", "lag_24")
        ]
    )
    return wide.withColumn("hist_rolling", mean_nonzero("hist_lag_1", "hist_lag_2", "hist_lag_3"))


def with_history_fallback(lags: DataFrame, history: DataFrame, zone: str, ts: str, value: str = "demand") -> DataFrame:
    """Missing lags from the weekday-and-hour mean, then zero."""
    joined = lags.join(history_fallbacks(lags, history, zone, ts), [zone, ts], "left")

    def filled(actual, hist):
        return F.coalesce(as_col(actual).cast("double"), as_col(hist), F.lit(0.0))

    return joined.select(
        zone,
        ts,
        *[filled(f"{value}_lag_{h}", f"hist_lag_{h}").alias(f"{value}_lag_{h}") for h in (1, 2, 24)],
        filled("rolling_mean_3h", "hist_rolling").alias("rolling_mean_3h"),
    )


def serving_lags(
    requests: DataFrame, fact: DataFrame, zone: str = "pulocationid", ts: str = "hour_ts", history: DataFrame | None = None
) -> DataFrame:
    """Lag features for requested (zone, time) pairs, with historical fallback.

    With ``history`` (the means, kept by month as sums) the fact is read for the requested hours only.
    """
    means = hour_dow_history(fact, zone, ts) if history is None else history
    return with_history_fallback(lags_at_offsets(fact, requests, zone, ts), means, zone, ts)

"""Column profiles: describe, null rates, value counts, histograms, anomaly counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from zonepulse import schemas as S
from zonepulse.functions.columns import as_col
from zonepulse.operators.quantiles import exact_quantiles


def to_long(row: DataFrame, names: Sequence[str], measures: Mapping[str, object], label: str = "column") -> DataFrame:
    """A one-row wide aggregate (``{measure}__{i}``) to one row per name."""
    entries = [
        F.struct(F.lit(n).alias(label), *[F.col(f"{m}__{i}").alias(m) for m in measures]) for i, n in enumerate(names)
    ]
    return row.select(F.inline(F.array(*entries)))


def wide_agg(df: DataFrame, names: Sequence[str], measures: Mapping[str, object]) -> DataFrame:
    """Every measure of every column in one pass."""
    return df.agg(*[make(as_col(n)).alias(f"{m}__{i}") for i, n in enumerate(names) for m, make in measures.items()])


def describe(df: DataFrame, cols: Sequence[str], digits: int = 2, quartiles: Mapping | None = None) -> DataFrame:
    """count, mean, std, min, quartiles and max per column, rounded.

    ``quartiles`` may hold the result of an earlier ``exact_quantiles``.
    """
    quartiles = quartiles or exact_quantiles(df, cols, (0.25, 0.5, 0.75), interpolate=True)
    measures = {
        "count": F.count,
        "mean": lambda c: F.round(F.avg(c), digits),
        "std": lambda c: F.round(F.stddev(c), digits),
        "min": lambda c: F.round(F.min(c.cast("double")), digits),
        "max": lambda c: F.round(F.max(c.cast("double")), digits),
    }
    long = to_long(wide_agg(df, cols, measures), cols, measures)
    for name, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)):
        value = F.lit(None).cast("double")
        for c in cols:
            value = F.when(F.col("column") == c, F.lit(quartiles[c][p]).cast("double")).otherwise(value)
        long = long.withColumn(name, F.round(value, digits))
    return long.select("column", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def null_rates(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and share per column, one pass."""
    cols = list(cols or df.columns)
    measures = {
        "n": lambda c: F.count_if(c.isNull()),
        "rate": lambda c: F.avg(c.isNull().cast("int")),
    }
    return to_long(wide_agg(df, cols, measures), cols, measures)


def top_values(df: DataFrame, col: str, k: int = 15) -> DataFrame:
    counts = df.filter(as_col(col).isNotNull()).groupBy(as_col(col).alias("value")).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), F.col("value").asc()).limit(k)


def cap_outliers(df: DataFrame, col: str, q: float = 0.995, quantiles: Mapping | None = None) -> DataFrame:
    """Rows up to the (interpolated) quantile."""
    cap = (quantiles or exact_quantiles(df, [col], [q], interpolate=True))[col][q]
    return df.filter(as_col(col) <= F.lit(cap).cast("double"))


def _value_range(df: DataFrame, col: str) -> dict[str, Column]:
    """Least and greatest value of a column as literals: one pass over the source, however often they are used."""
    c = as_col(col).cast("double")
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    return {"lo": F.lit(lo).cast("double"), "hi": F.lit(hi).cast("double")}


def _with_empty_bins(counts: DataFrame, bins: int, key: str) -> DataFrame:
    domain = counts.sparkSession.range(bins).select(F.col("id").cast("int").alias(key))
    return domain.join(counts, key, "left")


def histogram(df: DataFrame, col: str, bins: int = 40) -> DataFrame:
    """Equal-width bins, left-closed, the last one closed on both sides."""
    span = _value_range(df, col)
    flat = span["lo"] == span["hi"]
    lo = F.when(flat, span["lo"] - 0.5).otherwise(span["lo"])
    hi = F.when(flat, span["hi"] + 0.5).otherwise(span["hi"])
    width = (hi - lo) / bins
    x = as_col(col).cast("double")
    bin_ = F.least(F.floor((x - lo) / width), F.lit(bins - 1)).cast("int")
    counts = df.filter(x.isNotNull()).groupBy(bin_.alias("bin")).agg(F.count("*").alias("n"))
    return _with_empty_bins(counts, bins, "bin").select(
        "bin",
        (lo + F.col("bin") * width).alias("lo"),
        (lo + (F.col("bin") + 1) * width).alias("hi"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def binned_mean(df: DataFrame, x: str, y: str, bins: int = 10) -> DataFrame:
    """Mean of ``y`` in equal-width, right-closed bins of ``x``; empty bins stay."""
    rows = df.filter(as_col(x).isNotNull() & as_col(y).isNotNull())
    span = _value_range(rows, x)
    width = (span["hi"] - span["lo"]) / bins
    place = F.ceil((as_col(x).cast("double") - span["lo"]) / F.nullif(width, F.lit(0.0)))
    bin_ = F.greatest(F.least(F.coalesce(place, F.lit(1)), F.lit(bins)), F.lit(1)).cast("int") - 1
    means = rows.groupBy(bin_.alias("bin")).agg(F.avg(as_col(y)).alias("mean"))
    return _with_empty_bins(means, bins, "bin").select(
        "bin",
        (span["lo"] + F.col("bin") * width).alias("lo"),
        (span["lo"] + (F.col("bin") + 1) * width).alias("hi"),
        "mean",
    )


def anomaly_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Count and share of rows that meet each condition; one pass."""
    entries, aggs = [], [F.count("*").alias("_rows")]
    for i, (name, cond) in enumerate(rules.items()):
        aggs.append(F.count_if(cond).alias(f"_n{i}"))
        share = F.col(f"_n{i}") / F.nullif(F.col("_rows"), F.lit(0))
        entries.append(F.struct(F.lit(name).alias("rule"), F.col(f"_n{i}").alias("n"), share.alias("rate")))
    return df.agg(*aggs).select(F.inline(F.array(*entries)))


def anomaly_flags(df: DataFrame, thresholds: Mapping[str, float] = S.ANOMALY) -> DataFrame:
    """(flag, value) for each statistical rule the table breaks; one pass."""
    t = thresholds
    n = F.count("*")

    def share(cond):
        return F.count_if(cond) / F.nullif(n, F.lit(0))

    demand, amount, distance = F.col("demand"), F.col("avg_total_amount"), F.col("avg_trip_distance")
    checks: list[tuple[str, Column, Column]] = [("empty", F.when(n == 0, 1).otherwise(0), F.lit(0))]
    if "demand" in df.columns:
        checks.append(("zero_demand_rate", share(demand == 0), F.lit(t["zero_demand_rate"])))
        checks.append(("high_demand", F.count_if(demand > t["high_demand"]), F.lit(0)))
    if "avg_total_amount" in df.columns:
        checks.append(("negative_amount", F.count_if(amount < 0), F.lit(0)))
        checks.append(("high_amount", F.count_if(amount > t["high_amount"]), F.lit(0)))
    if "avg_trip_distance" in df.columns:
        checks.append(("negative_distance", F.count_if(distance < 0), F.lit(0)))
        checks.append(("zero_distance_rate", share(distance == 0), F.lit(t["zero_distance_rate"])))
    for c in df.columns:
        checks.append((f"null_rate:{c}", share(as_col(c).isNull()), F.lit(t["null_rate"])))
    row = df.agg(*[value.cast("double").alias(f"v{i}") for i, (_, value, _) in enumerate(checks)])
    entries = [
        F.struct(F.lit(name).alias("flag"), F.col(f"v{i}").alias("value"), limit.cast("double").alias("_limit"))
        for i, (name, _, limit) in enumerate(checks)
    ]
    return row.select(F.inline(F.array(*entries))).filter(F.col("value") > F.col("_limit")).drop("_limit")


def correlations(df: DataFrame, cols: Sequence[str], target: str | None = None) -> DataFrame:
    """Pearson r of each pair (or of each column with the target); one pass.

    A pair is computed once; its mirror image and the diagonal are filled in.
    """
    cols = list(cols)
    if target is not None:
        pairs = [(c, target) for c in cols]
    else:
        pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    row = df.agg(
        *[F.corr(as_col(a).cast("double"), as_col(b).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = []
    for i, (a, b) in enumerate(pairs):
        shown = [(a, b)] if target is not None or a == b else [(a, b), (b, a)]
        entries += [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.col(f"r{i}").alias("r")) for x, y in shown]
    return row.select(F.inline(F.array(*entries)))

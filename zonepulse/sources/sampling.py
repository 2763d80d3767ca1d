"""Row samples."""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, functions as F


def sample_rows(df: DataFrame, frac: float = 0.05, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """A share of the rows, however many that are; with a key the same rows come back every time.

    With a key a row stays if the first eight hexadecimal digits of SHA-256 over seed and key lie in the lowest share.
    """
    if not key:
        return df.sample(False, frac, seed)
    if frac >= 1:
        return df
    digits = F.substring(F.sha2(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]), 256), 1, 8)
    return df.where(digits < f"{int(frac * 2**32):08x}")


def dev_sample(df: DataFrame, frac: float = 1.0, seed: int = 42) -> DataFrame:
    """Percentage sample for trial runs; the whole table at 1.0."""
    return df if frac >= 1.0 else df.sample(False, frac, seed)


def sample_n(df: DataFrame, n: int, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Uniform sample of ``n`` rows; with a key the same rows come back every time.

    Each row draws a number and the ``n`` lowest stay. Rows far above the
    expected cut are dropped in their own task, so that about ``n`` rows, not
    ``n`` per task, are sorted. The margin is six standard deviations.
    """
    total = df.count()
    share = min(1.0, (n + 6 * sqrt(n) + 50) / max(total, 1))
    if key:
        draw = (F.xxhash64(F.lit(seed), *key) / F.lit(2.0**64)) + 0.5
        order = ["_draw", *key]
    else:
        draw, order = F.rand(seed), ["_draw"]
    return df.withColumn("_draw", draw).filter(F.col("_draw") <= share).orderBy(*order).limit(n).drop("_draw")

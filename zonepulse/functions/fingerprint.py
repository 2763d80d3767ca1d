"""Row fingerprints and order-free content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from zonepulse.functions.columns import as_col


def fingerprint(cols: Sequence[str], key: str, strict: bool = False) -> Column:
    """SHA-256 over the row text and a secret key.

    The plain form joins non-null values with ``||`` and so can give two rows
    one payload; ``strict`` writes each value with its length and marks nulls.
    """
    if not key:
        raise ValueError("a fingerprint needs a non-empty key")
    texts = [as_col(c).cast("string") for c in cols]
    if strict:
        texts = [
            F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("null")) for t in texts
        ]
    return F.sha2(F.concat_ws("||", *texts, F.lit(key)), 256)


def content_hash(df):
    """One row (n, hash) that does not depend on row order.

    The xor alone cancels equal pairs, so an exact decimal sum goes with it.
    """
    row = F.xxhash64(*[as_col(c) for c in df.columns])
    total = F.sum(row.cast("decimal(38,0)"))
    mixed = F.concat_ws(":", F.bit_xor(row).cast("string"), total.cast("string"))
    return df.agg(F.count("*").alias("n"), F.coalesce(mixed, F.lit("")).alias("hash"))

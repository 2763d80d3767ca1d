"""Tamper evidence: sign rows, check them, count failures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions.columns import as_col
from zonepulse.functions.fingerprint import content_hash, fingerprint

__all__ = ["apply_fingerprint", "content_hash", "tampered_count", "verify_fingerprint"]

FINGERPRINT = "row_fingerprint"


def _signed_columns(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != FINGERPRINT]


def apply_fingerprint(df: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Add (or renew) the row fingerprint over all other columns."""
    return df.withColumn(FINGERPRINT, fingerprint(_signed_columns(df), key, strict))


def verify_fingerprint(df: DataFrame, key: str, strict: bool = False) -> DataFrame:
    """Verdict per row; a missing fingerprint is not authentic."""
    expected = fingerprint(_signed_columns(df), key, strict)
    return df.withColumn("is_authentic", as_col(FINGERPRINT).eqNullSafe(expected))


def tampered_count(df: DataFrame, key: str, strict: bool = False) -> DataFrame:
    checked = verify_fingerprint(df, key, strict)
    return checked.agg(F.count_if(~F.col("is_authentic")).alias("n"))

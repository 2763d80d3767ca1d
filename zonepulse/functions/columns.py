"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def as_col(c: Column | str) -> Column:
    """A name becomes a column reference; names may hold spaces or dots."""
    return F.col(f"`{c}`") if isinstance(c, str) else c

"""Text cleaning and safe coercion."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse.functions.columns import as_col


def yn_flag(c: Column | str) -> Column:
    """Y is true, N is false, all else is null."""
    text = as_col(c).cast("string")
    return F.when(text == "Y", True).when(text == "N", False)


def clean_text(c: Column | str) -> Column:
    return F.trim(as_col(c))


def normalise(c: Column | str) -> Column:
    """Lower case and trimmed, the form both sides of a borough join use."""
    return F.lower(F.trim(as_col(c)))


def column_suffix(value: str) -> str:
    """Label to column-name suffix."""
    return value.replace(" ", "_")


def underscore(c: Column | str) -> Column:
    return F.replace(as_col(c), F.lit(" "), F.lit("_"))


def try_number(c: Column | str) -> Column:
    return as_col(c).try_cast("double")


def try_date(c: Column | str) -> Column:
    return as_col(c).try_cast("date")


def parse_ids(c: Column | str) -> Column:
    """``"1, 2,,3"`` to an int array; blanks are skipped, a non-number becomes null."""
    parts = F.transform(F.split(as_col(c), ","), lambda p: F.trim(p))
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: p.try_cast("int"))


def first_present(*cols: Column | str, default=None) -> Column:
    """First non-null candidate."""
    candidates = [as_col(c) for c in cols]
    if default is not None:
        candidates.append(F.lit(default))
    return F.coalesce(*candidates)

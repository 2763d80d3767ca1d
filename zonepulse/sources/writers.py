"""Sinks. A rebalance hint sizes the files, so a hot period is split and small ones merge."""

from __future__ import annotations

from pyspark.sql import DataFrame

from zonepulse.functions.columns import as_col
from zonepulse.functions.time import date_trunc
from pyspark.sql import functions as F


def with_period(df: DataFrame, ts: str, name: str = "year_month") -> DataFrame:
    return df.withColumn(name, F.date_format(date_trunc("month", ts), "yyyy-MM"))


def write_period(df: DataFrame, path: str, period_col: str = "year_month") -> None:
    """Overwrite only the period folders present in ``df``."""
    (
        df.hint("rebalance", period_col)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(period_col)
        .parquet(path)
    )


def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV folder with headers; ``files`` fixes the file count for small dimensions."""
    out = df.hint("rebalance") if files is None else df.repartition(files)
    out.write.mode("overwrite").csv(path, header=True)


def replace_all(df: DataFrame, path: str) -> None:
    df.hint("rebalance").write.mode("overwrite").parquet(path)


def write_table_jdbc(df: DataFrame, url: str, table: str, batch: int = 5000, writers: int = 2, **options) -> None:
    """JDBC append with a bounded number of writers."""
    (
        df.repartition(writers)
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch), **options)
        .mode("append")
        .save()
    )


def export_drift(report: dict[str, DataFrame], path: str) -> None:
    """One CSV folder per drift frame; lists, structs and maps become JSON text, as a CSV field holds text only."""
    for name, frame in report.items():
        nested = {f.name: F.to_json(as_col(f.name)) for f in frame.schema.fields if f.dataType.typeName() in ("array", "struct", "map")}
        export_csv(frame.withColumns(nested) if nested else frame, f"{path.rstrip('/')}/{name}")


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)

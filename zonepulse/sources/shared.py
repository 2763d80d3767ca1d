"""The folder all executors see, and lineage cuts that live in it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is set, one below the warehouse, which every executor must see.

    A warehouse on a local disk will do only in local mode.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
        if found.startswith(("file:", "/")) and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and fixes row placement."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str = "part") -> DataFrame:
    """Written to the shared folder and read again: as ``cut_lineage``, and the planner knows its size, so that it broadcasts what is small."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

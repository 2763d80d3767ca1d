"""Tables written to the cluster's shared folder to cut lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zonepulse.sources.shared import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read again: survives lost executors, is planned once."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """As ``stored``, with the table's path, for ``delete`` after its last reader."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path), path


def release(spark: SparkSession) -> None:
    """Let go of what finished jobs have shuffled; Spark deletes such files once the driver has collected its garbage."""
    spark.sparkContext._jvm.java.lang.System.gc()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)

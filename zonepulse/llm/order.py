"""Deals rows out by ranges of an integer key, one range per partition."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Stands for a missing key, before all others.
NULL_KEY = -(2**63)


def range_parts(df: DataFrame, key: str) -> tuple[DataFrame, int]:
    """Adds ``part``: the number of the range of ``key`` (null first) that a row is in, and says how many there are.

    The borders are quantiles of the key column alone, as many as the session has shuffle partitions.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("as_double", F.coalesce(F.col(key), F.lit(NULL_KEY)).cast("double"))
    steps = [i / parts for i in range(1, parts)]
    borders = sorted(set(keyed.approxQuantile("as_double", steps, 1 / (4 * parts)) if steps else []))
    borders = borders or [0.0]
    cut = Bucketizer(splits=[-float("inf"), *borders, float("inf")], inputCol="as_double", outputCol="bucket")
    dealt = cut.transform(keyed).withColumn("part", F.col("bucket").cast("int")).drop("as_double", "bucket")
    return dealt, len(borders) + 1

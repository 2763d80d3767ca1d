import numpy as np
import pytest
from pyspark.sql import functions as F

from zonepulse.operators.quantiles import exact_quantiles


@pytest.mark.parametrize("direct_rows", [50_000, 100, 3])
def test_matches_numpy_with_ties_and_nulls(spark, direct_rows):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7.5).otherwise(F.rand(1) * 100).alias("x"),
        F.when(F.col("id") % 5 != 0, (F.col("id") * 17 % 1009).cast("double")).alias("y"),
    )
    data = {c: np.array([r[0] for r in df.select(c).collect() if r[0] is not None]) for c in ("x", "y")}
    probs = [0.0, 0.005, 0.25, 0.4, 0.5, 0.9, 0.995, 1.0]
    linear = exact_quantiles(df, ["x", "y"], probs, interpolate=True, direct_rows=direct_rows)
    lower = exact_quantiles(df, ["x", "y"], probs, direct_rows=direct_rows)
    for c in ("x", "y"):
        for p in probs:
            assert linear[c][p] == pytest.approx(np.quantile(data[c], p), rel=1e-12)
            assert lower[c][p] == np.quantile(data[c], p, method="inverted_cdf")


def test_empty_column(spark):
    df = spark.range(5).select(F.lit(None).cast("double").alias("x"))
    assert exact_quantiles(df, ["x"], [0.5]) == {"x": {0.5: None}}

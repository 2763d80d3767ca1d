"""Zone outlines: box, normalisation, decimation, centres."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from zonepulse.functions.columns import as_col
from zonepulse.functions.geometry import decimate, normalise_ring, ring_center, split_parts


def _axis(ring: str, axis: int, pick) -> F.Column:
    return pick(F.transform(as_col(ring), lambda p: p[axis].cast("double")))


def bounding_box(df: DataFrame, ring: str) -> DataFrame:
    """min/max over all points; each row reduces its own ring first."""
    return df.agg(
        F.min(_axis(ring, 0, F.array_min)).alias("min_x"),
        F.min(_axis(ring, 1, F.array_min)).alias("min_y"),
        F.max(_axis(ring, 0, F.array_max)).alias("max_x"),
        F.max(_axis(ring, 1, F.array_max)).alias("max_y"),
    )


def normalise_points(df: DataFrame, ring: str, precision: int = 6) -> DataFrame:
    """Rings scaled to the common unit box, y flipped."""
    box = bounding_box(df, ring).select(F.struct("min_x", "min_y", "max_x", "max_y").alias("box")).scalar()
    boxed = df.withColumn("_box", box)
    return boxed.withColumn(ring, normalise_ring(ring, F.col("_box"), precision)).drop("_box")


def zone_polygons(df: DataFrame, points: str, offsets: str, precision: int = 6, step: int = 4) -> DataFrame:
    """Multi-part outlines to ``polygons``: normalised, split by part, decimated."""
    boxed = normalise_points(df, points, precision)
    rings = F.transform(split_parts(points, offsets), lambda r: decimate(r, step))
    return boxed.withColumn("polygons", rings).drop(points, offsets)


def centers(df: DataFrame, id_col: str, ring: str) -> DataFrame:
    """(id, x, y) from the vertex mean of a ring."""
    return df.select(as_col(id_col).alias("id"), ring_center(ring).alias("_c")).select("id", "_c.x", "_c.y")

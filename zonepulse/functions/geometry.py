"""Ring expressions over ``array<array<double>>`` point lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from zonepulse.functions.columns import as_col


def _mean_of(ring: Column, axis: int) -> Column:
    total = F.aggregate(ring, F.lit(0.0), lambda acc, p: acc + p[axis].cast("double"))
    return F.when(F.size(ring) > 0, total / F.size(ring)).otherwise(0.0)


def ring_center(ring: Column | str) -> Column:
    """Vertex mean as struct(x, y); an empty or absent ring gives (0, 0)."""
    r = F.coalesce(as_col(ring), F.array().cast("array<array<double>>"))
    return F.struct(_mean_of(r, 0).alias("x"), _mean_of(r, 1).alias("y"))


def decimate(ring: Column | str, step: int = 4, min_points: int = 30) -> Column:
    """Every ``step``-th point plus the last one, for rings of more than ``min_points``."""
    r = as_col(ring)
    if step <= 1:
        return r
    kept = F.filter(r, lambda _, i: i % step == 0)
    last = F.element_at(r, -1)
    closed = F.when(F.element_at(kept, -1) == last, kept).otherwise(F.concat(kept, F.array(last)))
    return F.when(F.size(r) > min_points, closed).otherwise(r)


def split_parts(points: Column | str, offsets: Column | str) -> Column:
    """Cut one point list into rings that start at the given offsets; empty rings go."""
    p, o = as_col(points), as_col(offsets)
    stops = F.concat(F.slice(o, 2, F.greatest(F.size(o) - 1, F.lit(0))), F.array(F.size(p)))
    spans = F.arrays_zip(o.alias("start"), stops.alias("stop"))
    rings = F.transform(
        spans, lambda s: F.slice(p, s["start"] + 1, F.greatest(s["stop"] - s["start"], F.lit(0)))
    )
    return F.filter(rings, lambda r: F.size(r) > 0)


def normalise_ring(ring: Column | str, box: Column, precision: int = 6) -> Column:
    """Scale to the unit box with y pointing down."""
    floor_ = F.lit(1e-12)
    dx = F.greatest(box["max_x"] - box["min_x"], floor_)
    dy = F.greatest(box["max_y"] - box["min_y"], floor_)
    return F.transform(
        as_col(ring),
        lambda p: F.array(
            F.round((p[0] - box["min_x"]) / dx, precision),
            F.round(1.0 - (p[1] - box["min_y"]) / dy, precision),
        ),
    )

"""Connected components of an edge table, by large-star and small-star steps as Spark joins.

Between the steps each task joins up what its own edges link, so that a round is needed only for what lies apart, and a node's
least neighbour, which is an aggregate, serves as test of the end, as input of the next step and as result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonepulse.llm.scratch import stored

#: Edges that a task joins up at a time.
EDGES = 1 << 20


def roots(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, least node that is reachable by these edges) of every node that is not the least itself."""
    nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    u, v = place[: len(a)], place[len(a) :]
    root = np.arange(len(nodes))
    while len(u):
        # Roots hang themselves on the least root they touch, then every node on its root.
        np.minimum.at(root, np.maximum(u, v), np.minimum(u, v))
        while (root[root] != root).any():
            root = root[root]
        u, v = root[u], root[v]
        u, v = u[u != v], v[u != v]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def _joined_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's edges (a, b), each node on the least that ``EDGES`` of them reach."""
    held: list[pa.RecordBatch] = []

    def found() -> pa.RecordBatch:
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in ("a", "b"))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in roots(a, b)], names=["a", "b"])

    for batch in batches:
        held.append(batch)
        if sum(x.num_rows for x in held) >= EDGES:
            yield found()
            held.clear()
    if held:
        yield found()


def _contracted(edges: DataFrame) -> DataFrame:
    return stored(edges.mapInArrow(_joined_up, "a long, b long"), "edges")


def _least(edges: DataFrame) -> DataFrame:
    """(node, least and greatest of its smaller neighbours, whether it has larger ones) of every node."""
    ends = edges.select(F.col("a").alias("node"), F.col("b").alias("m"), F.lit(False).alias("hub")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("m"), F.lit(True).alias("hub"))
    )
    return stored(ends.groupBy("node").agg(F.min("m").alias("m"), F.max("m").alias("most"), F.max("hub").alias("hub")), "least")


def _star(edges: DataFrame, least: DataFrame, large: bool) -> DataFrame:
    """Hang each node's larger (or its smaller) neighbours on the smallest of its neighbourhood."""
    own = least.select(F.col("node").alias("u"), "m")
    if large:
        return edges.join(own, F.col("b") == F.col("u")).select("a", F.coalesce("m", "b").alias("b"))
    lower = edges.join(own, F.col("a") == F.col("u")).where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return lower.unionAll(least.where("m IS NOT NULL").select(F.col("node").alias("a"), F.col("m").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node that has an edge (a, b); component is the smallest node reachable.

    Each step is written to the shared folder; steps end when every node hangs on one that hangs on none. The number of steps grows
    with the logarithm of a component's size at most, a node's neighbours are aggregated, never collected, and a task holds ``EDGES`` edges.
    """
    long = lambda c: c.cast("long")
    now = _contracted(edges.select(long(F.greatest("a", "b")).alias("a"), long(F.least("a", "b")).alias("b")).where("a != b"))
    small = False
    while True:
        least = _least(now)
        forked, deep = least.agg(F.expr("bool_or(m != most)"), F.expr("bool_or(hub AND m IS NOT NULL)")).first()
        if not forked and not deep:
            return least.select("node", F.coalesce("m", "node").alias("component"))
        # Steps of both kinds take turns; one that could change nothing is left out.
        small = forked and not (deep and small)
        now = _contracted(stored(_star(now, least, not small), "star"))

"""Exact k nearest points through a nested split of the plane.

``build_tree`` cuts the points into strips along the wider side of their box, each crowded strip along the wider side of its
own box, and so on until a cell holds few points, however they cluster. A cell's path is its name; boxes are those of the points
in it. Every round is one grouped aggregation and one join on the cell.

A probe takes a first reach from the smallest cell around it that has enough points, and then goes down the tree into every
child whose box lies within that reach. Only points of the cells it ends in become pairs. What is excluded for
a probe is counted per cell, so cells with nothing left for it are not entered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window, functions as F

from zonepulse.sources.shared import written

#: Children of a cell, one hexadecimal digit of its path.
FAN = 16
DIGITS = "0123456789abcdef"
#: Quantiles of a cell from which its borders are picked.
GRID = 64
#: How many times the mean distance of these quantiles is a gap between clumps; at most GRID / GAP gaps can be.
GAP = 8


@dataclass
class Tree:
    """``points`` (id, x, y, node: its leaf); ``nodes`` (node, n, x0, x1, y0, y1, leaf, wide, borders); ``children`` (parent, kids); ``depth``: longest path."""

    points: DataFrame
    nodes: DataFrame
    children: DataFrame
    depth: int


def _located(df: DataFrame) -> DataFrame:
    return df.filter(F.col("x").isNotNull() & F.col("y").isNotNull() & ~F.isnan("x") & ~F.isnan("y"))


def _few_per_place(points: DataFrame, k: int) -> DataFrame:
    """The ``k`` lowest ids of each place: no other can be among the first k by (distance, id)."""
    here = Window.partitionBy("x", "y").orderBy("id")
    return points.withColumn("_n", F.row_number().over(here)).filter(F.col("_n") <= k).drop("_n")


def _borders(per_leaf: int) -> Column:
    """Where a crowded cell is cut along its wider side; a border belongs to the part below it.

    As many parts as make them about square, but all that the cell needs where these are few.
    """
    parts = F.col("n") / per_leaf
    wide, narrow = F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")), F.least(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0"))
    square = F.when((narrow > 0) & (parts > 4), F.least(parts, F.sqrt(parts * (wide / narrow)))).otherwise(parts)
    m = F.least(F.greatest(F.ceil(square), F.lit(2)), F.lit(FAN)).cast("int")
    quantiles = F.when(F.col("wide"), F.col("bx")).otherwise(F.col("by"))
    lo = F.when(F.col("wide"), F.col("x0")).otherwise(F.col("y0"))
    hi = F.when(F.col("wide"), F.col("x1")).otherwise(F.col("y1"))
    picked = F.transform(F.sequence(F.lit(1), m - 1), lambda i: F.get(quantiles, F.floor(i * GRID / m).cast("int") - 1))
    useful = F.array_sort(F.array_distinct(F.filter(picked, lambda b: (b >= lo) & (b < hi))))
    # Where points stand in clumps, cut between them: through a clump, cells would be thin slices of it.
    steps = F.transform(F.sequence(F.lit(1), F.lit(GRID - 2)), lambda i: F.struct(F.get(quantiles, i - 1).alias("a"), F.get(quantiles, i).alias("b")))
    gaps = F.transform(F.filter(steps, lambda s: s["b"] - s["a"] > (hi - lo) * (GAP / GRID)), lambda s: s["a"] + (s["b"] - s["a"]) / 2)
    # One value may fill all quantiles; then the middle parts it from the rest, or the least value where no number lies between.
    middle = lo + (hi - lo) / 2
    return F.when(F.size(gaps) > 0, gaps).when(F.size(useful) > 0, useful).otherwise(F.array(F.when(middle < hi, middle).otherwise(lo)))


def _child() -> Column:
    """Path of the child a position lies in."""
    at = F.when(F.col("wide"), F.col("x")).otherwise(F.col("y"))
    return F.concat("node", F.substring(F.lit(DIGITS), F.size(F.filter("borders", lambda b: b < at)) + 1, F.lit(1)))


def build_tree(points: DataFrame, k: int) -> Tree:
    """Split ``points`` (id, x, y) into cells of about 2 * k until none holds more than 3 * k, or all that it holds lie at one place."""
    spark = points.sparkSession
    per_leaf = 2 * k
    probs = [i / GRID for i in range(1, GRID)]
    here = written(points.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"), F.lit("").alias("node")))
    nodes, settled, depth = None, None, 0
    while True:
        stats = here.groupBy("node").agg(
            F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"),
            F.percentile_approx("x", probs, 1000).alias("bx"), F.percentile_approx("y", probs, 1000).alias("by"),
        )
        leaf = (F.col("n") <= 3 * k) | ((F.col("x0") == F.col("x1")) & (F.col("y0") == F.col("y1")))
        stats = stats.withColumns({"leaf": leaf, "wide": F.col("x1") - F.col("x0") >= F.col("y1") - F.col("y0")})
        open_cells = Observation()
        stats = stats.withColumn("borders", F.when(~F.col("leaf"), _borders(per_leaf))).drop("bx", "by")
        level = written(stats.observe(open_cells, F.count_if(~F.col("leaf")).alias("n")))
        nodes = level if nodes is None else nodes.unionByName(level)
        crowded = level.filter(~F.col("leaf")).select("node", "wide", "borders")
        if not open_cells.get["n"]:
            settled = here if settled is None else settled.unionByName(here)
            return Tree(settled, nodes, written(_children(nodes)), depth)
        done = here.join(level.filter("leaf").select("node"), "node", "left_semi").select("id", "x", "y", "node")
        settled = done if settled is None else settled.unionByName(done)
        here = written(here.join(crowded, "node").select("id", "x", "y", _child().alias("node")))
        depth += 1


def _box_distance() -> tuple[Column, Column]:
    """Distances from (x, y) to the nearest and to the farthest place of a box."""
    def gap(a: str) -> Column:
        return F.greatest(F.col(f"{a}0") - F.col(a), F.col(a) - F.col(f"{a}1"), F.lit(0.0))

    def far(a: str) -> Column:
        return F.greatest(F.abs(F.col(f"{a}1") - F.col(a)), F.abs(F.col(a) - F.col(f"{a}0")))

    near, most = (F.sqrt(F.pow(f("x"), 2) + F.pow(f("y"), 2)) for f in (gap, far))
    return near, most


def _leaf_of(tree: Tree, probes: DataFrame) -> DataFrame:
    """Probes with the path down to their cell; it ends before a child without points has children of its own."""
    placed = probes.withColumn("node", F.lit(""))
    splits = tree.nodes.filter(~F.col("leaf")).select("node", "wide", "borders")
    for level in range(tree.depth):
        at = splits.filter(F.length("node") == level)
        placed = placed.join(at, "node", "left").withColumn("node", F.coalesce(_child(), "node")).drop("wide", "borders")
    return placed


def _children(nodes: DataFrame) -> DataFrame:
    """(parent, kids): each split cell with its children and their boxes, at most ``FAN``."""
    kid = F.struct("node", "n", "x0", "x1", "y0", "y1", "leaf").alias("kid")
    parent = F.substring(F.col("node"), F.lit(1), F.length("node") - 1)
    return nodes.filter(F.length("node") > 0).groupBy(parent.alias("parent")).agg(F.collect_list(kid).alias("kids"))


def _with_used(df: DataFrame, used: DataFrame) -> DataFrame:
    """``n_used``: how many points of the row's node its group excludes."""
    same = F.col("_used_by").eqNullSafe(F.col("group")) & (F.col("_cell") == F.col("node"))
    return df.join(used, same, "left").withColumn("n_used", F.coalesce("_used", F.lit(0))).drop("_used_by", "_cell", "_used")


def _down(tree: Tree, front: DataFrame, carried: Sequence[str], used: DataFrame | None) -> DataFrame:
    """From (carried, x, y, reach, node) to the leaves below each node within the reach; a row that is at a leaf stays there."""
    rest = [*carried, "x", "y", "reach"]
    current = front.select(*rest, "node")
    for _ in range(tree.depth):
        spread = current.join(tree.children, F.col("node") == F.col("parent"), "left").select(*rest, F.col("node").alias("_at"), F.explode_outer("kids").alias("_kid"))
        spread = spread.select(*rest, "_at", "_kid.*").filter(F.col("node").isNull() | (_box_distance()[0] <= F.col("reach")))
        if used is not None:
            spread = _with_used(spread, used).filter(F.col("node").isNull() | (F.col("n") > F.col("n_used")))
        current = spread.select(*rest, F.coalesce("node", "_at").alias("node"))
    return current


def _pairs(tree: Tree, found: DataFrame, carried: Sequence[str], excluded: DataFrame | None) -> DataFrame:
    """Probes with the points of their leaves, within the reach."""
    other = tree.points.select(F.col("id").alias("near_id"), F.col("x").alias("px"), F.col("y").alias("py"), "node")
    gap = F.sqrt(F.pow(F.col("px") - F.col("x"), 2) + F.pow(F.col("py") - F.col("y"), 2))
    pairs = found.join(other, "node").select(*carried, "near_id", gap.alias("dist"))
    if excluded is not None:
        barred = excluded.select(F.col("group").alias("_g"), F.col("id").alias("_barred"))
        pairs = pairs.join(barred, F.col("_g").eqNullSafe(F.col("group")) & (F.col("_barred") == F.col("near_id")), "left_anti")
    return pairs


def _best(pairs: DataFrame, key: Sequence[str], k: int) -> DataFrame:
    order = Window.partitionBy(*key).orderBy("dist", "near_id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(tree: Tree, probes: DataFrame, key: Sequence[str], k: int, excluded: DataFrame | None = None) -> DataFrame:
    """(key, near_id, dist, rank): the ``k`` nearest points of each probe (key, x, y), ties to the lower id.

    ``excluded`` (group, id) bars points for the probes of a group; ``group`` is then part of the key. Both sides must be unique.
    """
    _, pairs = candidates(tree, probes, key, k, excluded)
    return _best(pairs, key, k)


def candidates(tree: Tree, probes: DataFrame, key: Sequence[str], k: int, excluded: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The pairs that give each probe its reach, and those among which its nearest are."""
    carried = [c for c in key if c not in ("x", "y")]
    used = None
    if excluded is not None:
        paths = F.transform(F.sequence(F.lit(0), F.length("node")), lambda i: F.substring(F.col("node"), F.lit(1), i))
        used = excluded.join(tree.points, "id").select(F.col("group").alias("_used_by"), F.explode(paths).alias("_cell"))
        used = written(used.groupBy("_used_by", "_cell").agg(F.count("*").alias("_used")))
    placed = written(_leaf_of(tree, probes.select(*carried, "x", "y")))
    above = F.transform(F.sequence(F.lit(0), F.length("node")), lambda i: F.substring(F.col("node"), F.lit(1), i))
    steps = placed.select(*carried, "x", "y", F.explode(above).alias("node")).join(tree.nodes.select("node", "n", "x0", "x1", "y0", "y1"), "node")
    left = F.col("n")
    if used is not None:
        steps = _with_used(steps, used)
        left = left - F.col("n_used")
    # The smallest cell around the probe with enough points; where there is none, the root, and any distance will do.
    enough = F.when(left >= k, F.col("node"))
    start = steps.groupBy(*key).agg(F.max_by(F.struct("node", _box_distance()[1].alias("reach")), F.length(enough)).alias("s"))
    front = written(start.select(*key, F.coalesce("s.node", F.lit("")).alias("node"), F.coalesce("s.reach", F.lit(float("inf"))).alias("reach")))
    first = _pairs(tree, _down(tree, front, carried, used), [*carried, "x", "y"], excluded)
    # Rounding in the last place must not cut off a tie.
    reach = _best(first, key, k).groupBy(*key).agg(F.when(F.count("*") == k, F.max("dist") * (1 + 1e-12)).alias("_r"))
    again = placed.select(*carried, "x", "y").distinct().join(reach, list(key), "left").select(
        *carried, "x", "y", F.coalesce("_r", F.lit(float("inf"))).alias("reach"), F.lit("").alias("node")
    )
    second = _pairs(tree, _down(tree, written(again), carried, used), [*carried, "x", "y"], excluded)
    return first, second


def nearest(points: DataFrame, probes: DataFrame, k: int = 4) -> DataFrame:
    """(id, near_id, dist, rank): the ``k`` nearest other points of each probe.

    Both frames hold ``id, x, y``; rows without a position are left out. Ties go to the lower id. Probes at one place
    are searched once, for one point more than ``k``, as a probe may itself be among the points.
    """
    tree = build_tree(_few_per_place(_located(points.select("id", "x", "y")), k + 1), k + 1)
    asked = _located(probes.select("id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"))).distinct()
    found = search(tree, asked.select("x", "y").distinct(), ["x", "y"], k + 1)
    mine = asked.join(found, ["x", "y"]).filter(F.col("near_id") != F.col("id")).select("id", "near_id", "dist")
    return _best(mine, ["id"], k)


def nearest_allowed(points: DataFrame, probes: DataFrame, excluded: DataFrame, k: int = 4) -> DataFrame:
    """(group, id, near_id, dist, rank): the ``k`` nearest points of each probe (group, id, x, y) that its group does not exclude."""
    tree = build_tree(_located(points.select("id", "x", "y")), k)
    asked = _located(probes.select("group", "id", "x", "y")).distinct()
    return search(tree, asked, ["group", "id", "x", "y"], k, excluded.select("group", "id").distinct()).drop("x", "y")


def k_nearest(points: DataFrame, selected: DataFrame, k: int = 4) -> DataFrame:
    """Nearest points of each selected one, none of which is itself selected."""
    chosen = selected.select("id").distinct()
    others = points.join(chosen, "id", "left_anti")
    return nearest(others, points.join(chosen, "id", "left_semi"), k)

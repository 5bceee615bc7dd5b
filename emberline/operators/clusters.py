"""Density clusters of points within groups, and connected components of an edge table."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from ..storage import save


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the least node that each node of ``edges`` (u, v, either direction once) is connected with.

    Labels take the least of their neighbours' and then their label's label, so rounds grow with the logarithm of a
    component's diameter, not with the diameter.
    """
    both = save(edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    labels = save(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "node"), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "v"), "v").groupBy("u").agg(F.min("root").alias("heard"))
        closer = labels.join(heard, F.col("node") == F.col("u")).select("node", F.least("root", "heard").alias("root"))
        closer = save(closer, "labels")
        jumped = closer.join(closer.select(F.col("node").alias("root"), F.col("root").alias("further")), "root", "left")
        after = save(jumped.select("node", F.least("root", F.coalesce("further", "root")).alias("root")), "labels")
        if not labels.join(after.withColumnRenamed("root", "new"), "node").where("root <> new").limit(1).count():
            return after
        labels = after


def _apart(a: str = "", b: str = "other_") -> Column:
    return F.sqrt(F.pow(F.col(f"{a}x") - F.col(f"{b}x"), 2) + F.pow(F.col(f"{a}y") - F.col(f"{b}y"), 2))


def _beside(rows: DataFrame, cells: tuple[int, ...] = (-2, -1, 0, 1, 2)) -> DataFrame:
    """Each row once for every cell that can hold a point within reach of it: (cx, cy) is then that cell."""
    for c in ("cx", "cy"):
        rows = rows.withColumn(c, F.explode(F.array(*[F.col(c) + i for i in cells])))
    return rows


def _linked_cells(cores: DataFrame, group: str, reach: float) -> DataFrame:
    """(u, v) of cells, named by u and v, that have cores within ``reach`` of each other, each cell with itself too.

    Most neighbours are settled by their boxes (too far) or by the outermost cores in eight directions (near enough). Of the others, those
    cores meet that are within reach of the other cell's box."""
    sides = {"w": F.col("x"), "s": F.col("y"), "sw": F.col("x") + F.col("y"), "nw": F.col("x") - F.col("y")}
    at = F.struct("x", "y")
    outer = F.array(*[f(at, side) for side in sides.values() for f in (F.min_by, F.max_by)])
    name = F.concat_ws("|", group, "cx", "cy")
    cells = cores.groupBy(group, "cx", "cy").agg(outer.alias("outer"), F.min("x").alias("x_lo"), F.max("x").alias("x_hi"), F.min("y").alias("y_lo"), F.max("y").alias("y_hi"))
    cells = save(cells.withColumn("cell", name), "core_cells")
    box = ["cell", "outer", "x_lo", "x_hi", "y_lo", "y_hi"]
    right = cells.select(group, "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in box])
    pairs = _beside(cells).join(right, [group, "cx", "cy"]).where(F.col("cell") < F.col("b_cell"))
    gap = lambda c: F.greatest(F.lit(0.0), F.col(f"{c}_lo") - F.col(f"b_{c}_hi"), F.col(f"b_{c}_lo") - F.col(f"{c}_hi"))
    near = lambda p, q: F.sqrt(F.pow(p["x"] - q["x"], 2) + F.pow(p["y"] - q["y"], 2)) <= reach
    pairs = pairs.where(F.sqrt(F.pow(gap("x"), 2) + F.pow(gap("y"), 2)) <= reach)
    pairs = save(pairs.withColumn("linked", F.exists("outer", lambda p: F.exists("b_outer", lambda q: near(p, q)))).drop("outer", "b_outer"), "cell_pairs")
    named = cores.select(name.alias("cell"), "x", "y")
    to_box = lambda b: F.sqrt(sum(F.pow(F.greatest(F.lit(0.0), F.col(f"{b}{c}_lo") - F.col(c), F.col(c) - F.col(f"{b}{c}_hi")), 2) for c in "xy"))
    open_pairs = pairs.where(~F.col("linked"))
    left = open_pairs.join(named, "cell").where(to_box("b_") <= reach).select("cell", "b_cell", "x", "y")
    other = open_pairs.join(named.withColumnRenamed("cell", "b_cell"), "b_cell").where(to_box("") <= reach)
    met = left.join(other.select("cell", "b_cell", F.col("x").alias("other_x"), F.col("y").alias("other_y")), ["cell", "b_cell"]).where(_apart() <= reach)
    found = pairs.where("linked").select("cell", "b_cell").unionByName(met.select("cell", "b_cell").distinct()).unionByName(cells.select("cell", F.col("cell").alias("b_cell")))
    return found.select(F.col("cell").alias("u"), F.col("b_cell").alias("v"))


def density_clusters(points: DataFrame, group: str, reach: float, least: int) -> DataFrame:
    """(pid, cluster) of points (group, pid unique over all, x, y): cores have ``least`` points of their group within
    ``reach``, themselves included; linked cores are one cluster, named after its least core; a point near a core that
    isn't one itself belongs to the least such cluster. Points near no core have no row.

    Points lie on a grid whose cells are as wide as ``reach`` / sqrt(2), so that all points of a cell are within reach of each other: a cell
    with ``least`` points has cores only, and only the points of other cells, fewer than ``least`` in each, are compared with their
    neighbours. Cells with cores are linked instead of points."""
    side = reach / math.sqrt(2) * (1 - 1e-12)
    placed = points.select(group, "pid", "x", "y", F.floor(F.col("x") / side).alias("cx"), F.floor(F.col("y") / side).alias("cy"))
    counts = placed.groupBy(group, "cx", "cy").agg(F.count("*").alias("n"))
    placed = save(placed.join(counts, [group, "cx", "cy"]), "placed_points")
    others = placed.select(group, "cx", "cy", F.col("x").alias("other_x"), F.col("y").alias("other_y"))
    sparse = placed.where(F.col("n") < least).drop("n")
    dense_enough = _beside(sparse).join(others, [group, "cx", "cy"]).where(_apart() <= reach).groupBy("pid").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    some = sparse.join(dense_enough.select("pid"), "pid", "left_semi").select(group, "pid", "x", "y", "cx", "cy")
    cores = save(placed.where(F.col("n") >= least).select(group, "pid", "x", "y", "cx", "cy").unionByName(some), "cores")
    roots = components(_linked_cells(cores, group, reach))
    named = cores.withColumn("node", F.concat_ws("|", group, "cx", "cy")).join(roots, "node")
    names = named.groupBy("root").agg(F.min("pid").alias("cluster"))
    of_core = save(named.join(names, "root").select(group, "pid", "x", "y", "cx", "cy", "cluster"), "clustered_cores")
    edge = _beside(sparse.join(of_core.select("pid"), "pid", "left_anti"))
    beside = of_core.select(group, "cx", "cy", F.col("x").alias("other_x"), F.col("y").alias("other_y"), "cluster")
    border = edge.join(beside, [group, "cx", "cy"]).where(_apart() <= reach).groupBy("pid").agg(F.min("cluster").alias("cluster"))
    return of_core.select("pid", "cluster").unionByName(border)

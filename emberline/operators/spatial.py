"""Containment, nearest feature and connected cells as equi-joins on buckets.

Features are tables of segments (fid, x1, y1, x2, y2); a point is a segment of length 0, a polygon's
inside is where a ray crosses its segments an odd number of times. No geometry type is needed.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.scalars import project
from ..storage import save

#: Bucket sizes in metres, at most: a hit within the bucket size is exact. Points without one go on to buckets WIDER times as large,
#: until one bucket holds everything. The first buckets are as wide as DENSE times the mean spacing of a role's segments, so that a point meets
#: about as many whatever their number is.
BUCKET, WIDER, DENSE = 4_000.0, 5.0, 1.5


def box_segments(boxes: DataFrame, fid: str, west="west", south="south", east="east", north="north", projected: bool = True) -> DataFrame:
    """Sides of axis-aligned boxes; a box without extent gives one segment of length 0."""
    corners = [(west, south, east, south), (east, south, east, north), (east, north, west, north), (west, north, west, south)]
    sides = F.array(*[F.struct(*[F.col(c).alias(n) for c, n in zip(side, ("x1", "y1", "x2", "y2"))]) for side in corners])
    point = (F.col(west) == F.col(east)) & (F.col(south) == F.col(north))
    out = boxes.select(F.col(fid).alias("fid"), F.explode(F.when(point, F.slice(sides, 1, 1)).otherwise(sides)).alias("s")).select("fid", "s.*")
    if not projected:
        return out
    ends = [xy for n in "12" for xy in zip((f"x{n}", f"y{n}"), project(F.col(f"y{n}"), F.col(f"x{n}")))]
    return out.select("fid", *[c.alias(n) for n, c in ends])


def point_segments(points: DataFrame, fid: str, x="x", y="y") -> DataFrame:
    return points.select(F.col(fid).alias("fid"), F.col(x).alias("x1"), F.col(y).alias("y1"), F.col(x).alias("x2"), F.col(y).alias("y2"))


def segment_distance() -> Column:
    """From (x, y) to the nearest point of (x1, y1)-(x2, y2)."""
    dx, dy = F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")
    square = dx * dx + dy * dy
    along = ((F.col("x") - F.col("x1")) * dx + (F.col("y") - F.col("y1")) * dy) / F.when(square > 0, square)
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    return F.sqrt(F.pow(F.col("x") - F.col("x1") - t * dx, 2) + F.pow(F.col("y") - F.col("y1") - t * dy, 2))


def _cells(envelopes: DataFrame, cell: float | Column, reach: float | Column) -> DataFrame:
    """Each row once for every bucket that its envelope (x_lo, x_hi, y_lo, y_hi), widened by ``reach``, touches."""
    span = lambda lo, hi: F.sequence(F.floor((F.col(lo) - reach) / cell), F.floor((F.col(hi) + reach) / cell))
    return envelopes.withColumn("cx", F.explode(span("x_lo", "x_hi"))).withColumn("cy", F.explode(span("y_lo", "y_hi")))


def _bucketed(points: DataFrame, cell: float | Column) -> DataFrame:
    return points.withColumn("cx", F.floor(F.col("x") / cell)).withColumn("cy", F.floor(F.col("y") / cell))


def cut(segments: DataFrame, longest: float | Column) -> DataFrame:
    """Segments longer than ``longest`` in parts of that length at most, so that a part's envelope touches few buckets."""
    length = F.greatest(F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1")))
    parts = F.greatest(F.lit(1), F.ceil(length / longest)).cast("int")
    at = lambda c, k: F.when(k == 0, F.col(f"{c}1")).when(k == F.col("parts"), F.col(f"{c}2")).otherwise(F.col(f"{c}1") + (F.col(f"{c}2") - F.col(f"{c}1")) * k / F.col("parts"))
    split = segments.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    ends = {f"{c}{n}": at(c, F.col("part") + n - 1) for c in "xy" for n in (1, 2)}
    return split.select(*[ends[c].alias(c) if c in ends else F.col(c) for c in segments.columns])


def _inside(tests: DataFrame, segments: DataFrame, bands: DataFrame) -> DataFrame:
    """``tests`` (fid, band, test, x, y) whose ray crosses the segments of polygon fid an odd number of times. A point meets only the segments
    that reach into its own band of y. ``bands`` (fid, band): as high as the polygon's segments on average, so that a band holds hardly more
    segments than a ray meets, and all bands together about two of each."""
    rows = F.sequence(F.floor(F.least("y1", "y2") / F.col("band")), F.floor(F.greatest("y1", "y2") / F.col("band")))
    slabs = segments.join(bands, "fid").select("fid", "x1", "y1", "x2", "y2", F.explode(rows).alias("slab"))
    straddles = (F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))
    rise = F.col("y2") - F.col("y1")
    crosses = straddles & (F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / F.when(rise != 0, rise) + F.col("x1"))
    met = tests.withColumn("slab", F.floor(F.col("y") / F.col("band"))).join(slabs, ["fid", "slab"]).where(crosses)
    return met.groupBy("fid", "test").agg(F.count("*").alias("n")).where(F.col("n") % 2 == 1).select("fid", "test")


#: Polygons up to so many cells wide are compared with the points of their cells; wider ones settle whole cells first. Envelopes wider than
#: COARSE cells are listed over buckets of that width.
SMALL, COARSE = 4, 25


def containing(points: DataFrame, segments: DataFrame, cell: float = 4_000.0) -> DataFrame:
    """(pid, fid) of each point (pid, x, y) and each polygon that contains it by the even-odd rule: rings of one fid may be holes or further parts.

    For a wide polygon the cells that hold points are listed. A cell that no segment touches lies inside or outside as a
    whole: its centre is tested once for all of its points. The other points within an envelope are tested one by one."""
    points, segments = save(points.select("pid", "x", "y"), "points"), save(segments.select("fid", "x1", "y1", "x2", "y2"), "segments")  # read by every branch
    envelopes = segments.groupBy("fid").agg(
        F.min(F.least("x1", "x2")).alias("x_lo"), F.max(F.greatest("x1", "x2")).alias("x_hi"),
        F.min(F.least("y1", "y2")).alias("y_lo"), F.max(F.greatest("y1", "y2")).alias("y_hi"), F.avg(F.abs(F.col("y2") - F.col("y1"))).alias("band"),
    )
    envelopes = save(envelopes.withColumn("band", F.when(F.col("band") > 0, F.col("band")).otherwise(cell)), "envelopes")  # one band for both sides of the join
    bands = envelopes.select("fid", "band")
    width = F.greatest(F.col("x_hi") - F.col("x_lo"), F.col("y_hi") - F.col("y_lo"))
    placed = _bucketed(points, cell)
    within_box = F.col("x").between(F.col("x_lo"), F.col("x_hi")) & F.col("y").between(F.col("y_lo"), F.col("y_hi"))
    one = placed.join(_cells(envelopes.where(width <= cell * SMALL), cell, 0.0), ["cx", "cy"]).where(within_box).select("fid", "band", "pid", "x", "y")
    wide = envelopes.where(width > cell * SMALL)
    held = placed.select("cx", "cy").distinct()
    listed = _cells(wide.where(width <= cell * COARSE), cell, 0.0).join(held, ["cx", "cy"]).select("fid", "band", F.col("cx").alias("px"), F.col("cy").alias("py"))
    grouped = held.select(F.col("cx").alias("px"), F.col("cy").alias("py"), *[F.floor(F.col(c) / COARSE).alias(c) for c in ("cx", "cy")])
    reaches = lambda c, p: (F.col(p) * cell <= F.col(f"{c}_hi")) & ((F.col(p) + 1) * cell >= F.col(f"{c}_lo"))
    widest = grouped.join(_cells(wide.where(width > cell * COARSE), cell * COARSE, 0.0), ["cx", "cy"]).where(reaches("x", "px") & reaches("y", "py"))
    listed = listed.unionByName(widest.select("fid", "band", "px", "py"))
    sides = _cells(_envelopes(cut(segments.join(wide.select("fid"), "fid", "left_semi"), cell)), cell, cell * 1e-6)
    touched = sides.select("fid", F.col("cx").alias("px"), F.col("cy").alias("py"), F.lit(True).alias("touched")).distinct()
    listed = listed.join(touched, ["fid", "px", "py"], "left")
    edge = listed.where("touched").join(placed.select("pid", "x", "y", F.col("cx").alias("px"), F.col("cy").alias("py")), ["px", "py"])
    one = one.unionByName(edge.select("fid", "band", "pid", "x", "y"))
    centre = lambda c: (F.col(c) + 0.5) * cell
    whole = listed.where("touched IS NULL").select("fid", "band", F.struct("px", "py").alias("test"), centre("px").alias("x"), centre("py").alias("y"))
    inner = _inside(whole, segments, bands).select("fid", F.col("test.px").alias("cx"), F.col("test.py").alias("cy"))
    return _inside(one.withColumnRenamed("pid", "test"), segments, bands).select(F.col("test").alias("pid"), "fid").unionByName(placed.join(inner, ["cx", "cy"]).select("pid", "fid"))


def _envelopes(segments: DataFrame) -> DataFrame:
    return segments.select(
        "*", F.least("x1", "x2").alias("x_lo"), F.greatest("x1", "x2").alias("x_hi"),
        F.least("y1", "y2").alias("y_lo"), F.greatest("y1", "y2").alias("y_hi"),
    )


def _spacing(points: DataFrame, segments: DataFrame) -> tuple[float, dict[str, float]]:
    """The larger side of the box around everything, and for each role the side of a square that holds one of its segments on average."""
    ends = lambda rows, role, x, y: rows.select(role.alias("role"), F.least(*x).alias("x_lo"), F.greatest(*x).alias("x_hi"), F.least(*y).alias("y_lo"), F.greatest(*y).alias("y_hi"))
    both = ends(points, F.lit(None).cast("string"), ("x", "x"), ("y", "y")).unionByName(ends(segments, F.col("role"), ("x1", "x2"), ("y1", "y2")))
    found = both.groupBy("role").agg(F.count("*").alias("n"), *[f(c).alias(c) for f, c in ((F.min, "x_lo"), (F.max, "x_hi"), (F.min, "y_lo"), (F.max, "y_hi"))]).collect()
    known = [r for r in found if r.x_lo is not None and r.y_lo is not None]
    across = lambda rs: max((max(r[f"{c}_hi"] for r in rs) - min(r[f"{c}_lo"] for r in rs) for c in "xy"), default=0.0) if rs else 0.0
    return across(known), {r.role: max(across([r]), 1.0) / math.sqrt(r.n) for r in known if r.role is not None}


def nearest_by_role(points: DataFrame, segments: DataFrame, roles: list[str], bucket: float = BUCKET, which: bool = True, reach: float | None = None) -> DataFrame:
    """(pid, role, dist, fid): for each point and role the nearest segment of that role, ties to the smaller fid.
    Without ``which`` fid is null: the least distance alone is a hash aggregate, its feature is not. With ``reach`` only
    segments up to that distance count.

    A grid is the index: points meet segments of the neighbouring buckets only, and what finds none there looks further.
    One bucket join serves all roles (``segments`` has a column role), each with buckets of its own width; no row where a role has no
    segment. Segments that lie on each other are one, of the smallest fid.
    """
    if which:
        least = lambda met: met.groupBy("pid", "role").agg(F.min(F.struct("dist", "fid")).alias("b")).select("pid", "role", "b.*")
    else:
        least = lambda met: met.groupBy("pid", "role").agg(F.min("dist").alias("dist")).withColumn("fid", F.lit(None).cast("long"))
    points = save(points.select("pid", "x", "y"), "points")  # read by every pass
    segments = save(segments.groupBy("role", "x1", "y1", "x2", "y2").agg(F.min("fid").alias("fid")), "segments")
    extent, spacing = _spacing(points, segments)
    spacing = {r: s for r, s in spacing.items() if r in roles}
    furthest = float("inf") if reach is None else reach
    cells, found = {r: min(bucket, furthest, DENSE * s) for r, s in spacing.items()}, []
    if not cells:
        return least(points.select("pid", F.lit("").alias("role"), F.lit(0.0).alias("dist"), F.lit(None).cast(segments.schema["fid"].dataType).alias("fid")).limit(0))
    left = points.select("pid", "x", "y", F.explode(F.array(*map(F.lit, cells))).alias("role"))
    while True:
        cell = F.element_at(F.create_map(*[F.lit(v) for rc in cells.items() for v in rc]), F.col("role"))
        last = [r for r, c in cells.items() if c > extent or c >= furthest]
        sides = _cells(_envelopes(cut(segments.where(F.col("role").isin(*cells)), cell)), cell, cell)
        met = _bucketed(left, cell).join(sides, ["role", "cx", "cy"]).withColumn("dist", segment_distance())
        near = F.col("dist") <= cell
        exact = least(met.where(near if reach is not None else near | F.col("role").isin(*last)))
        if len(last) == len(cells):
            found.append(exact)
            return reduce(DataFrame.unionByName, found)
        exact = save(exact, "nearest")
        found.append(exact)
        cells = {r: min(c * WIDER, furthest) for r, c in cells.items() if r not in last}
        left = left.where(F.col("role").isin(*cells)).join(exact.select("pid", "role"), ["pid", "role"], "left_anti")
        open_roles = {r.role for r in left.select("role").distinct().collect()}
        cells = {r: c for r, c in cells.items() if r in open_roles}
        if not cells:
            return reduce(DataFrame.unionByName, found)


def nearest(points: DataFrame, segments: DataFrame, bucket: float = BUCKET, which: bool = True) -> DataFrame:
    """(pid, dist, fid) of each point's nearest segment, ties to the smaller fid; no row if there is no segment."""
    return nearest_by_role(points, segments.withColumn("role", F.lit("")), [""], bucket, which).drop("role")


def within(points: DataFrame, segments: DataFrame, radius: float) -> DataFrame:
    """(pid, dist, fid) of each point's nearest segment up to ``radius``."""
    return nearest_by_role(points, segments.withColumn("role", F.lit("")), [""], radius, reach=radius).drop("role")

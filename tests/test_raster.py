"""Pixels of tiles: windows over tile edges, ties, missing data, and which files a query opens."""

import random
from collections import Counter

from emberline.operators.raster import DEGREE, Raster
from emberline.stores import new_folder


def raster(spark, values, side=4):
    r = Raster(spark, new_folder(spark, "raster"), 1.0, side)
    r.write(spark.createDataFrame([(a, b, v) for (a, b), v in values.items()], "row long, col long, value int"))
    return r


def test_points_and_windows_over_tile_edges(spark):
    rng = random.Random(1)
    values = {(r, c): rng.choice([0, 1, 1, 2, 3]) for r in range(-6, 9) for c in range(-6, 9) if rng.random() < 0.9}
    points = [(i, rng.uniform(-6, 8), rng.uniform(-6, 8)) for i in range(150)]
    frame = spark.createDataFrame(points, "pid long, latitude double, longitude double")
    r, metres = raster(spark, values), 1.3 * DEGREE
    from math import cos, floor, radians

    own = {i: values.get((floor(a), floor(b)), 0) for i, a, b in points}
    assert {x.pid: x.value for x in r.at(frame).collect()} == {i: v for i, v in own.items() if v}
    want = {}
    for i, a, b in points:
        high = 1.3 * cos(radians(a))
        box = Counter(values.get((p, q), 0) for p in range(floor(a - high), floor(a + high) + 1) for q in range(floor(b - 1.3), floor(b + 1.3) + 1))
        box.pop(0, None)
        if box:
            want[i] = min(box, key=lambda v: (-box[v], v))
    assert {x.pid: x.value for x in r.majority(frame, metres).collect()} == want


def test_only_the_points_tiles_are_read(spark):
    r = raster(spark, {(4 * i, 4 * i): 1 + i % 3 for i in range(40)})
    points = spark.createDataFrame([(1, 4.5, 4.5), (2, 8.5, 8.5)], "pid long, latitude double, longitude double")
    found = r.at(points)
    assert {x.pid: x.value for x in found.collect()} == {1: 2, 2: 3}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan
    read = r._pixels_of(points.select(*r._placed(r.index(points.latitude), r.index(points.longitude))))
    assert sorted(x.value for x in read.collect()) == [2, 3]

"""Containment by slabs and settled cells against the even-odd rule over all segments."""

import math
import random

import pytest

from emberline.operators import spatial

SEGMENTS = "fid string, x1 double, y1 double, x2 double, y2 double"


def ring(fid, cx, cy, r, n, wave=0.0):
    at = [(cx + r * (1 + wave * math.sin(9 * t)) * math.cos(t), cy + r * (1 + wave * math.sin(9 * t)) * math.sin(t)) for t in (2 * math.pi * i / n for i in range(n))]
    return [(fid, *a, *b) for a, b in zip(at, at[1:] + at[:1])]


def inside(x, y, sides):
    return sum((y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 for _, x1, y1, x2, y2 in sides) % 2 == 1


SHAPES = {
    "wavy": ring("wavy", 0, 0, 100, 3000, 0.2) + ring("wavy", 10, 0, 30, 400) + ring("wavy", 170, 60, 12, 50),  # a hole and an island
    "small": ring("small", 20, 20, 0.6, 12),
    "box": [("box", -80, -90, 90, -90), ("box", 90, -90, 90, 95), ("box", 90, 95, -80, 95), ("box", -80, 95, -80, -90)],
    "far": ring("far", 5_000, 5_000, 3, 20),
}


@pytest.mark.parametrize("cell", [2.0, 9.0, 1_000.0])
def test_even_odd(spark, cell):
    rng = random.Random(cell)
    points = [(i, rng.uniform(-150, 220), rng.uniform(-150, 150)) for i in range(1500)] + [(9000 + i, 19 + 0.1 * i, 20.0) for i in range(25)] + [(9999, 5_000.0, 5_001.0)]
    sides = [s for rows in SHAPES.values() for s in rows]
    got = spatial.containing(spark.createDataFrame(points, "pid long, x double, y double"), spark.createDataFrame([(f, *map(float, p)) for f, *p in sides], SEGMENTS), cell)
    want = sorted((i, f) for i, x, y in points for f, rows in SHAPES.items() if inside(x, y, rows))
    assert sorted((r.pid, r.fid) for r in got.collect()) == want


def test_points_on_corners_and_cell_edges(spark):
    square = [("sq", 0.0, 0.0, 4.0, 0.0), ("sq", 4.0, 0.0, 4.0, 4.0), ("sq", 4.0, 4.0, 0.0, 4.0), ("sq", 0.0, 4.0, 0.0, 0.0)]
    points = [(10 * i + j, float(i), float(j)) for i in range(-1, 6) for j in range(-1, 6)]
    got = spatial.containing(spark.createDataFrame(points, "pid long, x double, y double"), spark.createDataFrame(square, SEGMENTS), 1.0)
    assert sorted(r.pid for r in got.collect()) == sorted(p for p, x, y in points if inside(x, y, square))


def test_cut_keeps_ends_and_length(spark):
    rows = spark.createDataFrame([("a", 0.0, 0.0, 10.0, -7.0), ("b", 1.0, 1.0, 1.0, 1.0)], SEGMENTS)
    parts = [tuple(r) for r in spatial.cut(rows, 3.0).collect()]
    a = [p[1:] for p in parts if p[0] == "a"]
    assert len(a) == 4 and a[0][:2] == (0.0, 0.0) and a[-1][2:] == (10.0, -7.0) and all(p[2:] == q[:2] for p, q in zip(a, a[1:]))
    assert [p for p in parts if p[0] == "b"] == [("b", 1.0, 1.0, 1.0, 1.0)]

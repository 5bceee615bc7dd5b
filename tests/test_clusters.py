"""Grid clusters against the plain definition over all pairs."""

import math
import random

import pytest

from emberline.operators import clusters


def plain(points, reach, least):
    """{pid: cluster} from all pairs of a group."""
    near = {p: [q for q in points if q[0] == p[0] and math.dist(p[2:], q[2:]) <= reach] for p in points}
    cores = {p for p in points if len(near[p]) >= least}
    name = {p: p[1] for p in cores}
    while True:
        new = {p: min(name[q] for q in near[p] if q in cores) for p in cores}
        if new == name:
            break
        name = new
    out = {p[1]: name[p] for p in cores}
    return out | {p[1]: min(name[q] for q in near[p] if q in cores) for p in points if p not in cores and any(q in cores for q in near[p])}


def found(spark, points, reach, least):
    rows = spark.createDataFrame(points, "day string, pid long, x double, y double")
    return {r.pid: r.cluster for r in clusters.density_clusters(rows, "day", reach, least).collect()}


@pytest.mark.parametrize("least, spread", [(1, 9.0), (3, 6.0), (6, 3.0)])
def test_equals_all_pairs(spark, least, spread):
    rng = random.Random(least)
    points = [(rng.choice(["a", "b"]), i, rng.gauss(0, spread), rng.gauss(0, spread)) for i in range(400)]
    points += [("a", 1000 + i, 3.0, 3.0) for i in range(30)]  # one place
    points += [("b", 2000 + i, 40.0 + 0.01 * i, 40.0 + 0.9 * (i % 2)) for i in range(60)]
    assert found(spark, points, 1.0, least) == plain(points, 1.0, least)


def test_full_cells_link_by_inner_points(spark):
    """Two arcs whose outermost points are too far apart, but whose inner points aren't."""
    points = [("a", i, 0.70 - 0.012 * abs(i - 10) ** 1.5, 0.05 * i) for i in range(21)]
    points += [("a", 100 + i, 1.69 + 0.012 * abs(i - 10) ** 1.5, 0.05 * i) for i in range(21)]
    points += [("a", 200, 0.7, 0.5), ("a", 201, 1.69, 0.5)]
    assert found(spark, points, 1.0, 5) == plain(points, 1.0, 5)


def test_negative_places_and_empty(spark):
    points = [("a", i, -5.0 - 0.4 * i, -0.001 * i) for i in range(12)] + [("a", 99, 500.0, 500.0)]
    assert found(spark, points, 1.0, 3) == plain(points, 1.0, 3)
    assert found(spark, [], 1.0, 3) == {}

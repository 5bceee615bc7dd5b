"""Nearest features and containment: against brute force, and with few comparisons where features are dense."""

import math
import random

from pyspark.sql import functions as F

from emberline.operators import spatial

POINT = "pid int, x double, y double"
SEGMENT = "fid long, x1 double, y1 double, x2 double, y2 double, role string"


def distance(x, y, s):
    dx, dy = s[3] - s[1], s[4] - s[2]
    square = dx * dx + dy * dy
    t = max(0.0, min(1.0, ((x - s[1]) * dx + (y - s[2]) * dy) / square)) if square else 0.0
    return math.hypot(x - s[1] - t * dx, y - s[2] - t * dy)


def test_dense_features_are_met_a_few_at_a_time(spark, monkeypatch):
    rng, met, plain = random.Random(3), spark.sparkContext.accumulator(0), spatial.segment_distance
    spot = lambda: (rng.uniform(0, 7000), rng.uniform(0, 7000))
    points = [(i, *spot()) for i in range(200)]
    sides = [(i, x, y, x, y, "a") for i, (x, y) in enumerate(spot() for _ in range(2000))]
    sides += [(5000 + i, *s[1:]) for i, s in enumerate(sides)]  # the same places again

    def add(d):
        met.add(1)
        return d

    counting = F.udf(add, "double")
    monkeypatch.setattr(spatial, "segment_distance", lambda: counting(plain()))
    got = spatial.nearest_by_role(spark.createDataFrame(points, POINT), spark.createDataFrame(sides, SEGMENT), ["a"]).collect()
    assert met.value < 200 * 200  # of 200 * 4000
    want = {i: min((distance(x, y, s), s[0]) for s in sides) for i, x, y in points}
    assert {r.pid: r.fid for r in got} == {i: fid for i, (_, fid) in want.items()}
    assert all(abs(r.dist - want[r.pid][0]) < 1e-6 for r in got)


def test_roles_of_different_density(spark):
    rng = random.Random(4)
    points = [(i, rng.uniform(-9000, 9000), rng.uniform(-9000, 9000)) for i in range(60)] + [(99, 90_000.0, 5.0), (100, None, None)]
    sides = [(i, x, y, x + rng.uniform(-900, 900), y + rng.uniform(-900, 900), "many") for i, (x, y) in enumerate((rng.uniform(-9000, 9000), rng.uniform(-9000, 9000)) for _ in range(300))]
    sides += [(1000, -40_000.0, 7.0, 40_000.0, 7.0, "few"), (1001, 1.0, 1.0, 1.0, 1.0, "unasked")]
    table, segments = spark.createDataFrame(points, POINT), spark.createDataFrame(sides, SEGMENT)
    got = {(r.pid, r.role): r for r in spatial.nearest_by_role(table, segments, ["many", "few", "none"]).collect()}
    want = {(i, role): min((distance(x, y, s), s[0]) for s in sides if s[5] == role) for i, x, y in points if x is not None for role in ("many", "few")}
    assert got.keys() == want.keys() and all(got[k].fid == fid and abs(got[k].dist - d) < 1e-6 for k, (d, fid) in want.items())
    for radius in (150.0, 3000.0):
        near = {r.pid: r.fid for r in spatial.within(table, segments.where("role = 'many'").drop("role"), radius).collect()}
        assert near == {i: fid for (i, role), (d, fid) in want.items() if role == "many" and d <= radius}
    assert spatial.within(table, segments.drop("role").limit(0), 10.0).count() == 0


def test_many_corners_in_bands_of_their_own(spark):
    ring = [(500 * math.cos(a) * (1 + 0.2 * math.sin(9 * a)), 500 * math.sin(a)) for a in (2 * math.pi * i / 3000 for i in range(3000))]
    square = [(-300.0, -300.0), (300.0, -300.0), (300.0, 300.0), (-300.0, 300.0)]
    closed = lambda fid, corners: [(fid, *a, *b) for a, b in zip(corners, corners[1:] + corners[:1])]
    sides = closed(1, ring) + closed(1, [(x / 4, y / 4) for x, y in square]) + closed(2, square) + [(3, 0.0, 0.0, 5.0, 0.0)]
    rng = random.Random(5)
    points = [(i, rng.uniform(-600, 600), rng.uniform(-600, 600)) for i in range(300)]

    def inside(x, y, fid):
        cross = [1 for f, x1, y1, x2, y2 in sides if f == fid and (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1]
        return len(cross) % 2 == 1

    want = {(i, fid) for i, x, y in points for fid in (1, 2, 3) if inside(x, y, fid)}
    for cell in (4000.0, 60.0):  # as small polygons, and as wide ones
        found = spatial.containing(spark.createDataFrame(points, POINT), spark.createDataFrame(sides, "fid int, x1 double, y1 double, x2 double, y2 double"), cell)
        assert {(r.pid, r.fid) for r in found.collect()} == want


def test_sample_points_of_one_place_are_searched_once(spark, tmp_path, monkeypatch):
    import datetime as dt

    from emberline.plans import offshore

    day = dt.datetime(2024, 1, 5, 12)
    spark.createDataFrame([(2, day, 0, 1.0)], "event_id long, ts timestamp, user_id long, value double").write.parquet(f"{tmp_path}/events.parquet")
    keys = [(102,), (102 + 158_800,), (102 + 2 * 158_800,), (303,), (303 + 158_800,)]  # the same place again each 158,800
    spark.createDataFrame([(k, 1) for k, in keys], "c_custkey long, c_nationkey int").write.parquet(f"{tmp_path}/customer.parquet")
    searched, plain = [], spatial.within
    monkeypatch.setattr(spatial, "within", lambda points, *rest: searched.append(points.count()) or plain(points, *rest))
    got = {r.sample_id for r in offshore.isolated_points(spark, str(tmp_path)).collect()}
    assert got == {"G000000303", "G000159103"} and searched == [2]

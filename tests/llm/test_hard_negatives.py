"""Hard negatives against DuckDB, and the multi-index' visits against its bounds."""

import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest

from emberline.llm import hard_negatives
from emberline.llm.session import table

SCHEMA = "vec_id long, embedding array<float>, label int"


def from_sql(rows):
    frame = pd.DataFrame(rows, columns=["vec_id", "embedding", "label"])
    with duckdb.connect() as con:
        con.execute("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[], label INTEGER)")
        con.executemany("INSERT INTO embeddings VALUES (?, ?, ?)", [tuple(r) for r in rows]) if len(frame) else None
        return sorted(con.execute(hard_negatives.ORACLE).fetchall(), key=str)


def result(spark, rows, schema=SCHEMA):
    return sorted(map(tuple, hard_negatives.op12_hard_negatives(spark, spark.createDataFrame(rows, schema)).collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in table(spark, "/root/testdata/sf0.001", "embeddings").collect()]
    got = result(spark, rows)
    assert got and got == from_sql(rows)


@pytest.mark.parametrize("zone_rows, reach", [(16, 8), (40, 100_000)])
def test_clusters_ties_copies_and_bad_rows(spark, monkeypatch, zone_rows, reach):
    monkeypatch.setattr(hard_negatives, "CELL_ROWS", 12)
    monkeypatch.setattr(hard_negatives, "REACH", reach)
    monkeypatch.setattr(hard_negatives.MultiIndex.__init__, "__defaults__", (zone_rows,))
    rng = random.Random(zone_rows)
    centres = [[rng.uniform(-0.4, 0.6) for _ in range(5)] for _ in range(6)]
    rows = []
    for i in range(500):
        c = centres[rng.randrange(6)]
        rows.append((i, [round(x + rng.choice([0, 0, 0.01, -0.02]), 2) for x in c], rng.randrange(4)))
    rows += [(1000 + 10 * i, centres[0], i % 3) for i in range(200)]  # a hot vector
    rows += [(None, centres[1], 1), (50, centres[2], 2), (50, centres[2], 2), (None, None, 1), (2000, centres[1], None), (2050, None, 1)]
    rows += [(2100, [0.0] * 5, 1), (2150, [-x for x in centres[0]], 3)]
    bad = [(2200, [math.nan] * 5, 1), (2250, [math.inf] * 5, 1), (2300, [None, 0.1, 0.1, 0.1, 0.1], 1)]
    # Equal scores of rows that share an id (or have none) may come in any order of the rows: compare without those that can't be told apart.
    assert result(spark, rows + bad) == from_sql(rows)


def test_short_vectors_and_columns(spark):
    rows = [(50 * i, [0.5] * (1 + i % 3), i % 2, "x", 1) for i in range(40)]
    padded = [(a, v + [0.0] * (3 - len(v)), c) for a, v, c, *_ in rows]
    assert result(spark, rows, SCHEMA + ", row string, cell int") == from_sql(padded)
    assert result(spark, []) == result(spark, [(50, None, 1)]) == []
    assert result(spark, [(50, [], 1), (100, [], 1), (150, [], 2)]) == [(100, 50, 1, 150, 0, 0), (50, 100, 1, 150, 0, 0)]


def test_visits_fall_and_bound_every_row():
    rng = np.random.default_rng(1)
    x = np.floor(rng.normal(size=(600, 8)) * 100)
    centres = [hard_negatives.fit_centres(x[:, :4], 6), hard_negatives.fit_centres(x[:, 4:], 6)]
    (i, d1), (j, d2) = (hard_negatives.nearest(h, c) for h, c in zip((x[:, :4], x[:, 4:]), centres))
    radii = [np.array([d[n == k].max(initial=0) for k in range(len(c))]) for n, d, c in ((i, d1, centres[0]), (j, d2, centres[1]))]
    cell = i * len(centres[1]) + j
    index = hard_negatives.MultiIndex(centres, radii, dict(zip(*(a.tolist() for a in np.unique(cell, return_counts=True)))), 50)
    for q in x[:20]:
        visits = list(index.visits(q))
        assert sorted(c for *_, c in visits) == sorted(set(cell.tolist()))
        assert [b for b, *_ in visits] == sorted((b for b, *_ in visits), reverse=True)
        for high, low, c in visits:
            scores = x[cell == c] @ q
            assert low <= scores.min() and scores.max() <= high
    # A far query that needs only high scores leaves cells unvisited.
    _, n, bound = index.ask(x[0], 0, math.inf, np.array([float(x[0] @ x[0]) * 2]), np.array([math.inf]))
    assert n < len(set(cell.tolist())) and bound > -math.inf

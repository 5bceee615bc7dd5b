"""Hard negatives by an exact search over an inverted multi-index.

A vector's two halves are each assigned to the nearest of K centres of that half; the two numbers make its cell. The rows of
a cell score at most ``q1.c1 + |q1| r1`` (first half) plus the same of the second half, where r is the largest distance of
any row from its half's centre. A heap visits a query's cells by falling sums of these half bounds (multi-sequence order) and
stops when every window of the query is certified: it holds its k rows and no cell left can reach the last of them, or the
window's lower end. A window is a range of scores: any score for the positives, a share of the positive's score for its negatives.

Cells are gathered into zones of bounded size; a query is sent to the zones of the cells it visits, in rounds of growing reach.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .session import save

#: Rows of a cell on average, while there are at most CENTRES of a half; rows that the centres are fitted to.
CELL_ROWS, CENTRES, SAMPLE_ROWS, FIT_ROUNDS = 256, 256, 16_384, 8
#: Rows of a zone; rows that a query reaches in its first round, and how many times as many in each further one.
ZONE_ROWS, REACH, WIDER = 16_384, 16_384, 8

_VECTORS = "row long, vec_id long, label long, v array<double>"
_ASKED = pa.schema([("row", pa.int64()), ("zone", pa.int32()), ("cells", pa.list_(pa.int32())), ("visited", pa.int32()), ("bound", pa.float64())])
_FOUND = pa.schema([("row", pa.int64()), ("window", pa.int32()), ("candidate", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def prepared(vectors: DataFrame) -> DataFrame:
    """row (tells rows of one id apart), vec_id, label (the next of ten where vec_id is divisible by 7) and integer components ``v``.

    Rows with a null label, a null vector, or a null, NaN or infinite component take no part; a row without an id does, last in
    ties. Missing trailing components count as 0. Written once, so that rows keep their numbers."""
    x, label = F.col("embedding"), F.col("label").cast("long")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    good = vectors.where(x.isNotNull() & label.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("double")).alias("v"),
    )
    good = save(good, "vectors")
    width = max(good.agg(F.max(F.size("v"))).first()[0] or 1, 1)
    short = F.concat("v", F.array_repeat(F.lit(0.0), F.lit(width) - F.size("v")))
    return good.withColumn("v", F.when(F.size("v") < width, short).otherwise(F.col("v")))


def fit_centres(x: np.ndarray, k: int) -> np.ndarray:
    """At most k centres by Lloyd's rounds from evenly spread rows; any number of rows, also none."""
    centres = np.unique(x[np.linspace(0, max(len(x) - 1, 0), min(k, len(x))).astype(int)], axis=0) if len(x) else np.zeros((1, x.shape[1]))
    for _ in range(FIT_ROUNDS if len(x) else 0):
        near = nearest(x, centres)[0]
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        count = np.bincount(near, minlength=len(centres))
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of and distance to the nearest centre; the distance from the differences, as rounding must not make it small."""
    near = ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
    return near, np.sqrt(((x - centres[near]) ** 2).sum(axis=1))


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


class MultiIndex:
    """Centres and radii of both halves, rows and zones of the cells that have any: at most CENTRES ** 2 of them."""

    def __init__(self, centres: list[np.ndarray], radii: list[np.ndarray], rows: dict[int, int], zone_rows: int = ZONE_ROWS):
        self.centres, self.cut = centres, centres[0].shape[1]
        self.radii = [r * (1 + 1e-9) + 1e-6 for r in radii]  # a little over, so that rounding never makes a bound too small
        self.rows, self.zones, self.zone_count, filled = rows, {}, 0, 0
        for cell in sorted(rows):
            if filled + rows[cell] > zone_rows and filled:
                self.zone_count, filled = self.zone_count + 1, 0
            parts = -(-rows[cell] // zone_rows)  # a large cell has zones of its own
            self.zones[cell] = (self.zone_count, parts)
            self.zone_count, filled = (self.zone_count + parts, 0) if parts > 1 else (self.zone_count, filled + rows[cell])
        self.zone_count += bool(filled)

    def visits(self, q: np.ndarray) -> Iterator[tuple[float, float, int]]:
        """(upper bound, lower bound, cell) of the cells that hold rows, by falling upper bound."""
        high, low, order = [], [], []
        for half, (c, r) in zip((q[: self.cut], q[self.cut :]), zip(self.centres, self.radii)):
            middle, reach = c @ half, math.sqrt(float(half @ half)) * (1 + 1e-9) * r + 1e-3
            order.append(np.argsort(-(middle + reach), kind="stable").tolist())
            high.append((middle + reach).tolist()), low.append((middle - reach).tolist())
        (first, second), width = order, len(order[1])
        todo, seen = [(-(high[0][first[0]] + high[1][second[0]]), 0, 0)], {(0, 0)}
        while todo:
            bound, a, b = heapq.heappop(todo)
            i, j = first[a], second[b]
            if i * width + j in self.rows:
                yield -bound, low[0][i] + low[1][j], i * width + j
            for x, y in ((a + 1, b), (a, b + 1)):
                if x < len(first) and y < width and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(todo, (-(high[0][first[x]] + high[1][second[y]]), x, y))

    def ask(self, q: np.ndarray, visited: int, reach: float, needs: np.ndarray, highs: np.ndarray) -> tuple[dict[int, list[int]], int, float]:
        """The zones and cells of the next visits, how many cells are then visited in all, and the bound of those left (-inf: none).

        needs: what a score has to reach to matter to each window. A cell whose rows all score above every window is passed over."""
        zones, rows, n, least, most = {}, 0, 0, needs.min(), highs.max()
        for bound, low, cell in self.visits(q):
            if n >= visited:
                if bound < least or rows >= reach:
                    return zones, n, bound
                if low <= most:
                    first, parts = self.zones[cell]
                    for zone in range(first, first + parts):
                        zones.setdefault(zone, []).append(cell)
                    rows += self.rows[cell]
            n += 1
        return zones, n, -math.inf


def build_index(vectors: DataFrame) -> tuple[DataFrame, MultiIndex]:
    """``vectors`` with cell and zone, and the index. Centres are fitted to the SAMPLE_ROWS rows of smallest hash; every row is indexed."""
    spark = vectors.sparkSession
    n = vectors.count()
    sample = vectors.orderBy(F.xxhash64("row", F.lit(12)), "row").limit(SAMPLE_ROWS).select("v").collect()
    x = np.array([r.v for r in sample]) if sample else np.zeros((0, 1))
    cut, k = -(-x.shape[1] // 2), min(CENTRES, max(1, math.ceil(math.sqrt(n / CELL_ROWS))))
    centres = [fit_centres(x[:, :cut], k), fit_centres(x[:, cut:], k)]
    width = x.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _vectors(batch.column("v"), width)
            (i, d1), (j, d2) = nearest(v[:, :cut], centres[0]), nearest(v[:, cut:], centres[1])
            more = [pa.array(a) for a in (i.astype(np.int32), j.astype(np.int32), d1, d2)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "i", "j", "d1", "d2"])

    placed = save(vectors.mapInArrow(assign, f"{_VECTORS}, i int, j int, d1 double, d2 double"), "placed")
    radii = [np.zeros(len(c)) for c in centres]
    for r, (c, d) in zip(radii, (("i", "d1"), ("j", "d2"))):
        for at, far in placed.groupBy(c).agg(F.max(d)).collect():  # at most CENTRES rows
            r[at] = far
    cell = F.col("i") * F.lit(len(centres[1])) + F.col("j")
    rows = {r.cell: r.n for r in placed.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).collect()}  # at most CENTRES ** 2 rows
    index = MultiIndex(centres, radii, rows)
    zones = spark.createDataFrame([(c, *z) for c, z in index.zones.items()], "cell int, first int, parts int")
    zone = (F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))).cast("int")
    return placed.withColumn("cell", cell).join(F.broadcast(zones), "cell").select("row", "vec_id", "label", "v", "cell", zone.alias("zone")), index


def _asker(index: MultiIndex, reach: float):
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for row, q, lows, highs, kths, visited in zip(*(batch.column(n).to_pylist() for n in ("row", "v", "lows", "highs", "kths", "visited"))):
                needs = np.maximum(lows, kths)
                zones, visited, bound = index.ask(np.array(q), visited, reach, needs, np.array(highs))
                rows += [(row, z, cells, None, None) for z, cells in zones.items()] + [(row, None, None, visited, bound)]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 5, _ASKED)], schema=_ASKED)

    return ask


class Zone:
    """The rows of a zone, by cell."""

    def __init__(self, parts: list[pa.RecordBatch], width: int):
        cells = np.concatenate([p.column("cell").to_numpy() for p in parts])
        order = np.argsort(cells, kind="stable")
        get = lambda n: np.concatenate([p.column(n).to_numpy(zero_copy_only=False) for p in parts])[order]
        self.x = np.concatenate([_vectors(p.column("v"), width) for p in parts])[order]
        self.row, self.label = get("row"), get("label")
        self.no_id = np.concatenate([p.column("vec_id").is_null().to_numpy(zero_copy_only=False) for p in parts])[order]
        self.id = np.concatenate([p.column("vec_id").fill_null(0).to_numpy() for p in parts])[order]
        self.cells, self.start = np.unique(cells[order], return_index=True)
        self.start = np.r_[self.start, len(cells)]

    def best(self, row, label, q, cells, lows, highs, kths, k: int, same: bool) -> list[tuple]:
        """(row, window, candidate's row, vec_id, score): each window's k best rows of the cells that its kth score so far lets pass."""
        at = np.flatnonzero(np.isin(self.cells, cells))
        if len(at) == len(self.cells):
            take = np.arange(len(self.row))
        else:
            take = np.concatenate([np.arange(self.start[a], self.start[a + 1]) for a in at]) if len(at) else np.empty(0, int)
        take = take[(self.label[take] == label) == same]
        scores, out = self.x[take] @ q, []
        for w, (lo, hi, kth) in enumerate(zip(lows, highs, kths)):
            good = np.flatnonzero((scores >= max(lo, kth)) & (scores <= hi) & (self.row[take] != row))
            if len(good) > 4 * k:
                least = np.partition(scores[good], -k)[-k]
                good = good[scores[good] >= least]
            i = take[good]
            first = np.lexsort((self.row[i], self.id[i], self.no_id[i], -scores[good]))[:k]
            out += [(row, w, int(self.row[i[f]]), None if self.no_id[i[f]] else int(self.id[i[f]]), int(scores[good[f]])) for f in first]
        return out


def _searcher(width: int, k: int, same: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows arrive sorted by (zone, is_query): a zone's rows, then the queries that visit it."""
        number, parts, zone = None, [], None
        for batch in batches:
            zones, asks = batch.column("zone").to_numpy(), batch.column("is_query").to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(zones) != 0) | (np.diff(asks) != 0)) + 1).tolist(), len(zones)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if zones[lo] != number:
                    number, parts, zone = zones[lo], [], None
                part = batch.slice(lo, hi - lo)
                if not asks[lo]:
                    parts.append(part)
                    continue
                if parts:
                    zone, parts = Zone(parts, width), []
                if zone is None:
                    continue
                q, out = _vectors(part.column("v"), width), []
                for x, *of in zip(q, *(part.column(n).to_pylist() for n in ("row", "label", "cells", "lows", "highs", "kths"))):
                    row, label, cells, *windows = of
                    out += zone.best(row, label, x, np.array(cells), *windows, k, same)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*out)) or [[]] * 5, _FOUND)], schema=_FOUND)

    return search


def search(rows: DataFrame, index: MultiIndex, queries: DataFrame, k: int, same: bool) -> DataFrame:
    """row, window, rank, candidate, vec_id, score: for each query's windows the k best other rows, of its label (``same``) or of another.

    ``queries``: row, label, v, lows and highs (array<double>, a window each). Higher scores come first, ties by smaller vec_id,
    then rows without one; fewer than k rows give fewer."""
    queries = save(queries, "queries")
    if not (width := (queries.select(F.size("v")).first() or [0])[0]):
        return save(queries.sparkSession.createDataFrame([], "row long, window int, candidate long, vec_id long, score long, rank int"), "found")
    none = F.transform("lows", lambda _: F.lit(float("-inf")))
    state = queries.select("row", none.alias("kths"), F.lit(0).alias("visited"))
    order = Window.partitionBy("row", "window").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "candidate")
    found, reach = None, REACH
    dealt = rows.select("zone", F.lit(0).alias("is_query"), "cell", "row", "vec_id", "label", "v")
    while True:
        open_now = queries.join(state, "row")
        asked = save(open_now.select("row", "v", "lows", "highs", "kths", "visited").mapInArrow(_asker(index, reach), "row long, zone int, cells array<int>, visited int, bound double"), "asked")
        sent = asked.where(F.col("zone").isNotNull()).select("row", "zone", "cells").join(open_now.select("row", "label", "v", "lows", "highs", "kths"), "row")
        both = dealt.unionByName(sent.withColumn("is_query", F.lit(1)), allowMissingColumns=True)
        hits = both.repartition(max(1, min(index.zone_count, 100_000)), "zone").sortWithinPartitions("zone", "is_query").mapInArrow(
            _searcher(width, k, same), "row long, window int, candidate long, vec_id long, score long"
        )
        hits = hits if found is None else hits.unionByName(found.drop("rank"))
        found = save(hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), "found")
        full = found.groupBy("row", "window").agg(F.when(F.count("*") == k, F.min("score").cast("double")).alias("kth"))
        kths = full.where("kth IS NOT NULL").groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("window", "kth"))).alias("kth"))
        left = asked.where(F.col("zone").isNull() & (F.col("bound") > float("-inf"))).select("row", "visited", "bound")
        left = left.join(queries.select("row", "lows"), "row").join(kths, "row", "left")
        kth = F.transform("lows", lambda _, w: F.coalesce(F.try_element_at("kth", w), F.lit(float("-inf"))))
        needs = F.zip_with("lows", "kths", lambda a, b: F.greatest(a, b))
        state = left.withColumn("kths", kth).where(F.exists(needs, lambda x: x <= F.col("bound"))).select("row", "kths", "visited")
        state = save(state, "open_queries")
        if state.isEmpty():
            return found
        reach *= WIDER


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """Each anchor's first ``positives`` rows of its label, and for each of them the first ``negatives`` rows of other labels
    that score from ``least`` to ``most`` percent of the positive's score. Both frames as ``prepared`` gives them.

    A positive with a negative score has no such rows, one with 0 only those that score 0."""
    rows, index = build_index(vectors)
    any_score = anchors.select("row", "label", "v", F.array(F.lit(float("-inf"))).alias("lows"), F.array(F.lit(float("inf"))).alias("highs"))
    best = search(rows, index, any_score, positives, same=True).select("row", "rank", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high = F.lit(least) * F.col("positive_score"), F.lit(most) * F.col("positive_score")
    ends = [(low + F.pmod(-low, F.lit(100))) / 100, (high - F.pmod(high, F.lit(100))) / 100]  # whole numbers within
    window = F.struct("rank", ends[0].cast("double").alias("low"), ends[1].cast("double").alias("high"))
    windows = best.groupBy("row").agg(F.array_sort(F.collect_list(window)).alias("w"))
    asks = anchors.join(windows, "row").select("row", "label", "v", F.col("w.low").alias("lows"), F.col("w.high").alias("highs"))
    found = search(rows, index, asks, negatives, same=False).select("row", (F.col("window") + 1).alias("of"), F.col("rank"), F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = found.join(best.withColumnRenamed("rank", "of"), ["row", "of"]).join(anchors.select("row", F.col("vec_id").alias("anchor_id")), "row")
    return pairs.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_hard_negatives(spark, vectors: DataFrame) -> DataFrame:
    """Hard negatives of each row whose vec_id is divisible by 50; edge rows as ``prepared``, ``search`` and ``mine`` state. Rows that
    repeat an id are anchors and candidates each. Of further columns nothing is used; an empty table gives no rows."""
    own = prepared(vectors)
    return mine(own, own.where(F.col("vec_id") % 50 == 0))


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS MATERIALIZED (
  SELECT q.r, q.vec_id AS anchor_id, c.r AS other, c.vec_id, q.label = c.label AS same, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0),
p AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST, other) AS k FROM s WHERE same) t WHERE k <= 5),
n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.r, p.k ORDER BY s.score DESC, s.vec_id NULLS LAST, s.other) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

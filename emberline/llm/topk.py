"""Exact top-k search by inner product: ball trees, branch and bound.

Vectors are dealt into shards. Each shard builds a ball tree; a query visits nodes in the order of
the upper bound ``q.centre + |q| * radius`` and stops when the bound can't beat its current kth
score. That score is shared: shards are searched in rounds, few in the first, and every query takes the kth
score over all shards so far into the next. Queries stream past each shard's tree; neither they nor the
vectors pass through the driver.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .session import save

LEAF = 192
#: Vectors of a shard at most (about), and after which share of the shards each round ends.
SHARD_ROWS, ROUNDS = 65_536, (0.125, 0.5, 1.0)


class BallTree:
    """Nodes are ranges of rows; children split at the median along the line between two far points.

    ``ids`` may repeat; ``rows`` (default: ids) tell one vector from another."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, rows: np.ndarray | None = None):
        self.ids, self.vectors = ids.copy(), vectors.copy()
        self.rows = self.ids.copy() if rows is None else rows.copy()
        self.centre, self.radius, self.span, self.child = [], [], [], []
        if len(ids):
            self._build(0, len(ids))
            self.centre, self.radius = np.array(self.centre), np.array(self.radius)

    def _build(self, lo: int, hi: int) -> int:
        x = self.vectors[lo:hi]
        centre = x.mean(axis=0)
        away = ((x - centre) ** 2).sum(axis=1)
        node = len(self.span)
        # A little over, so that rounding never makes a bound too small.
        self.centre.append(centre), self.radius.append(math.sqrt(away.max()) * (1 + 1e-9) + 1e-6)
        self.span.append((lo, hi)), self.child.append(None)
        if hi - lo > LEAF and away.max() > 0:
            a = x[away.argmax()]
            b = x[((x - a) ** 2).sum(axis=1).argmax()]
            side = x @ (b - a)
            middle = (hi - lo) // 2
            split = np.argpartition(side, middle)
            self.ids[lo:hi], self.rows[lo:hi], self.vectors[lo:hi] = self.ids[lo:hi][split], self.rows[lo:hi][split], x[split]
            self.child[node] = (self._build(lo, lo + middle), self._build(lo + middle, hi))
        return node

    def search(self, own: int, q: np.ndarray, k: int, floor: float) -> list[tuple[int, int]]:
        """The k best (score, id) but for the row ``own`` that reach ``floor``; ties to the smaller id."""
        if not len(self.ids):
            return []
        norm = math.sqrt(float(q @ q)) * (1 + 1e-9)
        bounds = self.centre @ q + norm * self.radius + 1e-3
        best: list[tuple[int, int]] = []  # heap of (score, -id): its first is the worst kept
        todo = [(-bounds[0], 0)]
        while todo:
            bound, node = heapq.heappop(todo)
            if -bound < floor or (len(best) == k and -bound < best[0][0]):
                break
            if self.child[node]:
                for c in self.child[node]:
                    heapq.heappush(todo, (-bounds[c], c))
                continue
            lo, hi = self.span[node]
            scores = self.vectors[lo:hi] @ q
            least = max(floor, best[0][0]) if len(best) == k else floor
            good = np.flatnonzero(scores >= least)
            if len(good) > 4 * k:
                kth = np.partition(scores[good], -(k + 1))[-(k + 1)]
                good = good[scores[good] >= kth]
            for i in good:
                if self.rows[lo + i] == own:
                    continue
                found = (int(scores[i]), -int(self.ids[lo + i]))
                if len(best) < k:
                    heapq.heappush(best, found)
                elif found > best[0]:
                    heapq.heapreplace(best, found)
        return [(s, -i) for s, i in best]


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width))
    for i, v in enumerate(rows):
        out[i, : len(v)] = v
    return out


def quantised(vectors: DataFrame) -> DataFrame:
    """vec_id, integer components floor(256 * x) as ``v``, and ``row``, which tells rows of one id apart;
    vectors that are null or hold null, NaN or infinity go, and so do rows without an id. Written once, so that
    rows keep their numbers."""
    x = F.col("embedding")
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v.cast("double")) == float("inf")))
    good = vectors.where(x.isNotNull() & F.col("vec_id").isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda v: F.floor(F.lit(256.0) * v.cast("double")).cast("double")).alias("v"),
    )
    return save(good, "vectors")


def _searcher(width: int, k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows arrive sorted by (shard, is_query): a shard's vectors, which make its tree, then its queries in turn."""
        shard, parts, tree = None, [], None
        for batch in batches:
            for number, rows in batch.groupby("shard", sort=False):
                if number != shard:
                    shard, parts, tree = number, [], None
                own, queries = rows[rows.is_query == 0], rows[rows.is_query == 1]
                if len(own):
                    parts.append((own.vec_id.to_numpy(np.int64), _matrix(own.v, width), own.row.to_numpy(np.int64)))
                if len(queries) and parts:
                    tree, parts = BallTree(*(np.concatenate(c) for c in zip(*parts))), []
                if len(queries) and tree is not None:
                    q, out = _matrix(queries.v, width), []
                    for row, vec, x, floor in zip(queries.row.to_numpy(), queries.vec_id.to_numpy(), q, queries.floor.to_numpy()):
                        out += [(row, vec, i, s) for s, i in tree.search(row, x, k, floor)]
                    yield pd.DataFrame(out, columns=["row", "query_id", "vec_id", "score"])

    return search


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's k best candidate rows but itself, ties to the smaller id.

    Both sides: row and vec_id long, v array<double> of integers; a candidate with the query's ``row`` is the query
    itself. Missing trailing components count as 0. Fewer than k candidates give fewer rows; repeated ids are
    candidates and queries each; an empty side gives no rows.
    """
    spark = candidates.sparkSession
    n, width = candidates.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    shards = max(2 * spark.sparkContext.defaultParallelism, math.ceil(n / SHARD_ROWS))
    shard = F.pmod(F.xxhash64("row", "vec_id"), F.lit(shards)).cast("int")
    dealt = candidates.select(shard.alias("shard"), F.lit(0).alias("is_query"), "row", "vec_id", "v", F.lit(0.0).alias("floor"))
    best, first = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id"), 0
    found, floors = None, queries.select("row", F.lit(float("-inf")).alias("floor"))
    for share in ROUNDS:
        end = max(first + 1, round(shards * share))
        asked = queries.join(floors, "row").withColumn("shard", F.explode(F.sequence(F.lit(first), F.lit(end - 1))))
        both = dealt.where(F.col("shard").between(first, end - 1)).unionByName(asked.select("shard", F.lit(1).alias("is_query"), "row", "vec_id", "v", "floor"))
        hits = both.repartition(end - first, "shard").sortWithinPartitions("shard", "is_query").mapInPandas(
            _searcher(max(width, 1), k), "row long, query_id long, vec_id long, score long"
        )
        hits = hits if found is None else hits.unionByName(found)
        found = save(hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).drop("rank"), "best_so_far")
        kth = found.groupBy("row").agg(F.when(F.count("*") == k, F.min("score").cast("double")).alias("kth"))
        floors = queries.select("row").join(kth, "row", "left").select("row", F.coalesce("kth", F.lit(float("-inf"))).alias("floor"))
        first = end
    return found.withColumn("rank", F.row_number().over(best)).select("query_id", "rank", "vec_id", "score")


def op6_exact_topk(spark, vectors: DataFrame, k: int = 5) -> DataFrame:
    """The k best of each row whose vec_id is divisible by 50, against all other rows; edge rows as ``quantised`` and
    ``top_k`` state. Of further columns nothing is used."""
    all_vectors = quantised(vectors)
    return top_k(all_vectors, all_vectors.where(F.col("vec_id") % 50 == 0), k)


ORACLE = """
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 5
"""

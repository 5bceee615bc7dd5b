"""Site history on the grid: recurrence, robust baselines, neighbourhood activity.

Rows are reduced to distinct (cell, day) before any window, so a site with thousands of rows is one
row a day.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.scalars import cell_id, grid_key

MIN_PRIOR, Z = 5, 3.5


def with_grid(detections: DataFrame) -> DataFrame:
    return detections.withColumn("gi", grid_key(F.col("latitude"))).withColumn("gj", grid_key(F.col("longitude"))).withColumn("cell", cell_id())


def day_number(date: str = "acq_date") -> Column:
    return F.datediff(F.col(date).cast("date"), F.lit("2000-01-01").cast("date"))


def recurrence(rows: DataFrame) -> DataFrame:
    """Active days, first and last day of each cell (gi, gj)."""
    return rows.groupBy("gi", "gj").agg(
        F.countDistinct("acq_date").alias("recurrence_count"), F.min("acq_date").alias("first_seen"), F.max("acq_date").alias("last_seen")
    )


def with_recurrence(rows: DataFrame, history: DataFrame | None = None) -> DataFrame:
    return rows.join(recurrence(rows if history is None else history), ["gi", "gj"])


def distinct_cell_days(rows: DataFrame) -> DataFrame:
    return rows.select("gi", "gj", "acq_date").distinct()


def causal_recurrence(rows: DataFrame, lookback: int | None = 90) -> DataFrame:
    """(gi, gj, acq_date) with active days within the look-back up to and including that day, and their first."""
    start = Window.unboundedPreceding if lookback is None else -lookback
    w = Window.partitionBy("gi", "gj").orderBy("day").rangeBetween(start, 0)
    days = distinct_cell_days(rows).withColumn("day", day_number())
    return days.select(
        "gi", "gj", "acq_date", F.count("*").over(w).alias("recurrence_count"), F.min("acq_date").over(w).alias("first_seen"),
        F.col("acq_date").alias("last_seen"),
    )


def daily_max(rows: DataFrame) -> DataFrame:
    """Largest power of each site (cell by day or night) and day; null if all are."""
    return rows.where(F.col("daynight").isNotNull()).groupBy("gi", "gj", "daynight", "acq_date").agg(F.max("frp").alias("max_frp"))


class RunningMedian:
    """Median and median absolute deviation of the values added so far, of values that are known beforehand: counts of their ranks
    in a binary indexed tree, so that each step takes a logarithm's time."""

    def __init__(self, values: np.ndarray):
        self.sorted = np.sort(values)
        self.rank = np.argsort(np.argsort(values, kind="stable"), kind="stable").tolist()
        self.top = 1 << max(len(values).bit_length() - 1, 0)
        self.tree, self.added, self.value = [0] * (len(values) + 1), 0, self.sorted.tolist()

    def add(self, i: int) -> None:
        """The ith of the values."""
        at, tree = self.rank[i] + 1, self.tree
        while at < len(tree):
            tree[at] += 1
            at += at & -at
        self.added += 1

    def kth(self, k: int) -> float:
        """The kth smallest value added, from 1."""
        at, step, tree = 0, self.top, self.tree
        while step:
            if at + step < len(tree) and tree[at + step] < k:
                at += step
                k -= tree[at]
            step >>= 1
        return self.value[at]

    def _up_to(self, x: float) -> int:
        at, n = int(np.searchsorted(self.sorted, x, side="right")), 0
        while at:
            n += self.tree[at]
            at &= at - 1
        return n

    def median(self) -> float:
        n = self.added
        return (self.kth((n + 1) // 2) + self.kth(n // 2 + 1)) / 2

    def deviation(self, middle: float) -> float:
        """The median distance from ``middle``."""
        n, below = self.added, self._up_to(middle)
        return (self._nth_distance((n + 1) // 2, middle, below) + self._nth_distance(n // 2 + 1, middle, below)) / 2

    def _nth_distance(self, n: int, middle: float, below: int) -> float:
        """Distances rise to both sides of ``middle``: how many of the n smallest lie below is found by halving."""
        lo, hi = max(0, n - (self.added - below)), min(n, below)
        while lo < hi:
            half = (lo + hi) // 2
            if middle - self.kth(below - half) < self.kth(below + n - half) - middle:  # the next one below is nearer than the last above
                lo = half + 1
            else:
                hi = half
        left = middle - self.kth(below - lo + 1) if lo else float("-inf")
        right = self.kth(below + n - lo) - middle if n > lo else float("-inf")
        return max(left, right)


def prior_statistics(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Median and MAD of the values before each one; NaN with fewer than MIN_PRIOR of them, or if one is NaN."""
    med, mad = np.full(len(values), np.nan), np.full(len(values), np.nan)
    lost = np.flatnonzero(np.isnan(values))
    judged = int(lost[0]) + 1 if len(lost) else len(values)  # from the first missing one on nothing is told
    if judged <= MIN_PRIOR:
        return med, mad
    seen = RunningMedian(values[: judged - 1])
    for i in range(judged):
        if i >= MIN_PRIOR:
            med[i] = seen.median()
            mad[i] = seen.deviation(med[i])
        if i < judged - 1:
            seen.add(i)
    return med, mad


_BASELINES = "gi long, gj long, daynight string, acq_date string, prior_active_days long, med double, mad double"


def _site_baselines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows arrive by site and day; a site's days may go on in the next batch."""
    held: list[pa.RecordBatch] = []

    def judged(rows: pa.Table) -> pa.RecordBatch:
        new = np.ones(rows.num_rows, dtype=bool)
        keys = [rows.column(c).combine_chunks() for c in ("gi", "gj", "daynight")]
        new[1:] = ~np.logical_and.reduce([pc.equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False) for k in keys])
        starts = np.r_[np.flatnonzero(new), rows.num_rows]
        values = rows.column("max_frp").to_numpy()
        prior = np.arange(rows.num_rows) - np.repeat(starts[:-1], np.diff(starts))
        med, mad = np.full(rows.num_rows, np.nan), np.full(rows.num_rows, np.nan)
        for lo, hi in zip(starts, starts[1:]):
            if hi - lo > MIN_PRIOR:
                med[lo:hi], mad[lo:hi] = prior_statistics(values[lo:hi])
        columns = [rows.column(c).combine_chunks() for c in ("gi", "gj", "daynight", "acq_date")]
        columns += [pa.array(prior), pa.array(med, mask=np.isnan(med)), pa.array(mad, mask=np.isnan(mad))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _BASELINES.split(", ")])

    for batch in batches:
        if not batch.num_rows:
            continue
        last = [batch.column(c)[batch.num_rows - 1] for c in ("gi", "gj", "daynight")]
        same = np.logical_and.reduce([pc.equal(batch.column(c), v).to_numpy(zero_copy_only=False) for c, v in zip(("gi", "gj", "daynight"), last)])
        cut = int(np.flatnonzero(~same)[-1]) + 1 if not same.all() else 0  # the last site may go on
        if cut:
            yield judged(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        elif held and any(held[-1].column(c)[held[-1].num_rows - 1] != v for c, v in zip(("gi", "gj", "daynight"), last)):
            yield judged(pa.Table.from_batches(held))
            held = []
        held.append(batch.slice(cut))
    if held:
        yield judged(pa.Table.from_batches(held))


def baselines(rows: DataFrame) -> DataFrame:
    """(gi, gj, daynight, acq_date) with prior_active_days, med and mad of the daily maxima strictly before the day.

    Sites are sorted by day within their partition, and each is read once: its running median and MAD take a logarithm's time a day. A site has
    one row a day at most, so its days are few whatever its rows are."""
    site = ["gi", "gj", "daynight"]
    days = daily_max(rows).select(*[F.col(c).cast("long") for c in ("gi", "gj")], "daynight", F.col("acq_date").cast("string"), F.col("max_frp").cast("double"))
    return days.repartition(*site).sortWithinPartitions(*site, "acq_date").mapInArrow(_site_baselines, _BASELINES)


def with_anomaly(rows: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """``rows`` with is_anomalous, baseline_frp and prior_active_days; ``history`` (default: rows) gives the days."""
    base = baselines(rows if history is None else history)
    joined = rows.join(base, ["gi", "gj", "daynight", "acq_date"], "left")
    high = F.when(F.col("mad") == 0, F.col("frp") > 3 * F.col("med")).otherwise(0.6745 * (F.col("frp") - F.col("med")) / F.col("mad") > Z)
    return joined.withColumn("is_anomalous", F.coalesce(high, F.lit(False))).withColumn("baseline_frp", F.col("med")).withColumn(
        "prior_active_days", F.coalesce("prior_active_days", F.lit(0)).cast("long")
    ).drop("med", "mad")


def spread(cell_days: DataFrame, radius: int = 1) -> DataFrame:
    """Each active (cell, day) credited to every cell within the radius, once."""
    offsets = F.sequence(F.lit(-radius), F.lit(radius))
    moved = cell_days.withColumn("di", F.explode(offsets)).withColumn("dj", F.explode(offsets))
    return moved.select((F.col("gi") + F.col("di")).alias("gi"), (F.col("gj") + F.col("dj")).alias("gj"), "acq_date").distinct()


def neighbourhood_days(targets: DataFrame, history: DataFrame, first: int, last: int, radius: int = 1) -> DataFrame:
    """``targets`` (det_id, gi, gj, acq_date) with ``n``: distinct days from day + first to day + last on which a
    cell of the neighbourhood was active. Counted once for each (cell, day), by a frame over the cells' days."""
    wanted = targets.select("gi", "gj", "acq_date").distinct()
    cells = wanted.select("gi", "gj").distinct()
    active = spread(distinct_cell_days(history), radius).join(cells, ["gi", "gj"], "left_semi")
    marked = active.withColumn("hit", F.lit(1)).unionByName(wanted.withColumn("hit", F.lit(0)))
    w = Window.partitionBy("gi", "gj").orderBy("day").rangeBetween(first, last)
    counted = marked.withColumn("day", day_number()).withColumn("n", F.coalesce(F.sum("hit").over(w), F.lit(0)))
    return targets.join(counted.where(F.col("hit") == 0).select("gi", "gj", "acq_date", "n"), ["gi", "gj", "acq_date"])

"""Exact removal of repeated substrings with deep-shallow sorted suffixes.

Every string of LENGTH bytes holds an anchor: the least hash of its GRAM-byte
strings, chosen by the content alone, so equal strings have equal anchors. Suffixes are sorted around
anchors only, a twentieth of all. Spark deals anchors out by hash: those with equal surroundings need one
comparison of 64-bit hashes, the one place where bytes aren't compared; what repeats within a batch of documents is
told there, so that a passage which a third of the rows share isn't dealt to one task. Where the same anchor has different
surroundings, these are fetched and ordered by multikey quicksort to a shallow depth and by blind tries below it,
once to the right and once, reversed, to the left; common prefixes in both orders tell which strings
around the anchor recur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from .session import save
from .suffixes import deep_shallow_sort

LENGTH, GRAM = 100, 24
REACH = LENGTH - GRAM
#: Different surroundings of one anchor that one task sorts; the strings around an anchor that has more are compared by
#: Spark as keys, with the same result, so that no group is gathered whatever its size.
GROUP = 50_000

_rng = np.random.default_rng(977)
_VALUE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
#: What names a document, in their order: whether it has an id, the id (0 if none), and a hash of its text.
KEY = ["has_id", "doc_id", "digest"]
KEY_TYPES = "has_id boolean, doc_id long, digest long"


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX
    return h ^ (h >> np.uint64(29))


class Anchors:
    """Finds a text's anchors; the tables of powers grow with the longest text seen."""

    def __init__(self):
        self.power = self.inverse = np.ones(1, dtype=np.uint64)

    def __call__(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each anchor, hash of its surroundings, and place << 16 | bytes to the left << 8 | to the right."""
        n = len(raw)
        with np.errstate(over="ignore"):
            if len(self.power) <= n:
                grown = 1 << n.bit_length()
                self.power = np.cumprod(np.r_[np.uint64(1), np.full(grown, _BASE, dtype=np.uint64)])
                self.inverse = np.cumprod(np.r_[np.uint64(1), np.full(grown, _INVERSE, dtype=np.uint64)])
            sums = np.zeros(n + 1, dtype=np.uint64)
            np.cumsum(_VALUE[np.frombuffer(raw, dtype=np.uint8)] * self.power[:n], out=sums[1:])
            grams = _mix((sums[GRAM:] - sums[:-GRAM]) * self.inverse[: n - GRAM + 1])
            key = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            width, least = 1, key
            while 2 * width <= REACH + 1:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            rest = REACH + 1 - width
            if rest:
                least = np.minimum(least[:-rest], least[rest:])
            chosen = np.zeros(len(grams), dtype=bool)
            chosen[(least & np.uint64(0xFFFFFFFF)).astype(np.int64)] = True
            place = np.flatnonzero(chosen)
            left, right = np.minimum(place, REACH), np.minimum(n - GRAM - place, REACH)
            lo, hi = place - left, place + GRAM + right
            around = _mix((sums[hi] - sums[lo]) * self.inverse[lo] + (left * 256 + right).astype(np.uint64) * _MIX)
        return grams[place].view(np.int64), around.view(np.int64), (place << 16) | (left << 8) | right


def _raw(text) -> bytes:
    return text.encode("utf-8", "replace") if text else b""


def _keys(batch: pd.DataFrame):
    return zip(batch.has_id, batch.doc_id, batch.digest)


def _local_repeats(rows: pd.DataFrame) -> pd.DataFrame:
    """``rows`` with ``again``: whether an earlier row of these has the same anchor and surroundings. Copies of a row go."""
    with np.errstate(over="ignore"):
        both = rows.anchor.to_numpy().view(np.uint64) * _MIX ^ rows.around.to_numpy().view(np.uint64)
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    some = rows.iloc[np.sort(order[np.r_[same, False] | np.r_[False, same]])].sort_values(["anchor", "around", *KEY, "place"])
    copy = some.duplicated(["anchor", "around", *KEY, "place"])
    again = some[~copy].duplicated(["anchor", "around"])
    rows = rows.assign(again=False)
    rows.loc[again[again].index, "again"] = True
    return rows.drop(index=copy[copy].index)


def _anchor_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    anchors = Anchors()
    for batch in batches:
        found = [(key, anchors(raw)) for key, t in zip(_keys(batch), batch.text) if len(raw := _raw(t)) >= LENGTH]
        if found:
            times = [len(a) for _, (a, _, _) in found]
            of = {name: np.repeat(np.array([key[i] for key, _ in found]), times) for i, name in enumerate(KEY)}
            anchor, around, place = (np.concatenate([x[i] for _, x in found]) for i in range(3))
            yield _local_repeats(pd.DataFrame({"anchor": anchor, "around": around, **of, "place": place}))


def _fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for key, t, wanted in zip(_keys(batch), batch.text, batch.wanted):
            raw = _raw(t)
            for w in wanted:
                p, left, right = w["place"] >> 16, w["place"] >> 8 & 255, w["place"] & 255
                if p + GRAM + right <= len(raw):
                    rows.append((w["anchor"], w["group"], *key, p, raw[p - left : p], raw[p + GRAM : p + GRAM + right]))
        yield pd.DataFrame(rows, columns=["anchor", "group", *KEY, "place", "left", "right"])


def repeated_around(lefts: list[bytes], rights: list[bytes]) -> list[tuple[int, int] | None]:
    """Of occurrences of one anchor, first to last: how far repeated strings reach to the left and right
    of each, or None. A string counts if an earlier occurrence has the same LENGTH bytes around the anchor.

    In a sorted order, occurrences that share ``depth`` bytes stand together. For each depth at which the order
    to one side parts, those that also share the rest to the other side are looked up.
    """
    n = len(lefts)
    orders = [deep_shallow_sort([x[::-1] for x in lefts]), deep_shallow_sort(rights)]
    deepest = [max((lcp for _, lcp in order), default=-1) for order in orders]
    reach = [[-1] * n, [-1] * n]

    def classes(order: list[tuple[int, int]], depth: int) -> list[int]:
        out, number = [0] * n, 0
        for i, lcp in order:
            number += lcp < depth
            out[i] = number
        return out

    for side in (0, 1):
        own, other = orders[side], orders[1 - side]
        for depth in sorted({lcp for _, lcp in own if lcp >= max(0, REACH - deepest[1 - side])}):
            seen, here, there = set(), classes(own, depth), classes(other, REACH - depth)
            for i in range(n):
                key = (here[i], there[i])
                if key in seen:
                    reach[side][i] = depth
                seen.add(key)
    return [(l, r) if l >= 0 else None for l, r in zip(*reach)]


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows arrive sorted by (anchor, KEY, place); copies of a row stand side by side and count once."""
    rows = (r for batch in batches for r in batch[["anchor", *KEY, "place", "left", "right"]].itertuples(index=False))
    out = []
    for _, group in groupby(rows, key=lambda r: r.anchor):
        group = [next(copies) for _, copies in groupby(group, key=lambda r: (r.has_id, r.doc_id, r.digest, r.place))]
        if len(group) > 1:
            for r, reach in zip(group, repeated_around([r.left for r in group], [r.right for r in group])):
                if reach:
                    out.append((r.has_id, r.doc_id, r.digest, r.place - reach[0], r.place + GRAM + reach[1]))
        if len(out) >= 20_000:
            yield pd.DataFrame(out, columns=[*KEY, "start", "end"])
            out = []
    yield pd.DataFrame(out, columns=[*KEY, "start", "end"])


def _compare_large(contexts: DataFrame) -> DataFrame:
    """The same for groups of any size: each string around an anchor is a key, its first occurrence stays."""
    fits = F.sequence(F.lit(0), F.lit(REACH))
    rows = contexts.dropDuplicates(["anchor", *KEY, "place"]).withColumn("l", F.explode(F.filter(fits, lambda l: (l <= F.length("left")) & (F.lit(REACH) - l <= F.length("right")))))
    tail = F.expr(f"substring(left, length(left) - l + 1, l)")
    rows = rows.withColumn("string", F.md5(F.concat(tail, F.expr(f"substring(right, 1, {REACH} - l)"))))
    firsts = rows.groupBy("anchor", "l", "string").agg(F.min(F.struct(*KEY, "place")).alias("first"))
    again = rows.join(firsts, ["anchor", "l", "string"]).where(F.struct(*KEY, "place") > F.col("first"))
    start = F.col("place") - F.col("l")
    return again.select(*KEY, start.alias("start"), (start + LENGTH).alias("end"))


def removed_spans(docs: DataFrame) -> DataFrame:
    """(KEY, spans array<struct<start,end>>) of ``docs`` (as keyed() gives them): what earlier strings repeat.
    The spans neither overlap nor touch."""
    anchors = docs.mapInPandas(_anchor_rows, f"anchor long, around long, {KEY_TYPES}, place long, again boolean")
    # Rows whose repeat is known already need no neighbours: they are dealt out by themselves.
    dealt = anchors.withColumn("dealt", F.when(F.col("again"), F.xxhash64(*KEY, "place")).otherwise(F.col("anchor"))).repartition("dealt")
    same, group = Window.partitionBy("dealt", "anchor", "again", "around").orderBy(*KEY, "place"), Window.partitionBy("dealt", "anchor", "again")
    me = F.struct(*KEY, "place")
    judged = (
        dealt.withColumn("later", me > F.first(me).over(same))
        .withColumn("copy", me.eqNullSafe(F.lag(me).over(same)))
        .withColumn("nth", F.row_number().over(same))
        .withColumn("group", F.sum((F.col("nth") == 1).cast("int")).over(group))
    )
    judged = judged.withColumn("again", F.col("again") | F.col("later")).where("NOT copy AND (again OR (group > 1 AND nth = 1))")
    judged = save(judged.select("anchor", *KEY, "place", "again", "group"), "anchors")
    place, left, right = F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(255), F.col("place").bitwiseAND(255)
    whole = judged.where("again").select(*KEY, (place - left).alias("start"), (place + GRAM + right).alias("end"))
    wanted = judged.where("NOT again").groupBy(*KEY).agg(F.collect_list(F.struct("anchor", "place", "group")).alias("wanted"))
    wanted = save(wanted, "wanted")
    contexts = docs.join(wanted, KEY).mapInPandas(_fetch, f"anchor long, group long, {KEY_TYPES}, place long, left binary, right binary")
    spans = f"{KEY_TYPES}, start long, end long"
    if judged.where((F.col("group") > GROUP) & ~F.col("again")).limit(1).count():
        contexts = save(contexts, "contexts")
        whole = whole.unionByName(_compare_large(contexts.where(F.col("group") > GROUP)))
        contexts = contexts.where(F.col("group") <= GROUP)
    parted = contexts.drop("group").repartition("anchor").sortWithinPartitions("anchor", *KEY, "place").mapInPandas(_compare, spans)
    listed = whole.unionByName(parted).groupBy(*KEY).agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return listed.mapInPandas(_merge, f"{KEY_TYPES}, spans array<struct<start:long,end:long>>")


def merged(spans, n: int = 2**62) -> list[tuple[int, int]]:
    """Maximal runs within a text of n bytes."""
    out: list[list[int]] = []
    for a, b in sorted((s["start"], min(s["end"], n)) for s in (spans if spans is not None else [])):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        elif a < b:
            out.append([a, b])
    return [(a, b) for a, b in out]


def _merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        runs = [[{"start": a, "end": b} for a, b in merged(spans)] for spans in batch.spans]
        yield batch[KEY].assign(spans=runs)


def _cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for has_id, d, t, spans in zip(batch.has_id, batch.doc_id, batch.text, batch.spans):
            raw = _raw(t)
            runs = merged(spans, len(raw))
            keep = hashlib.sha256()
            at = 0
            for a, b in [*runs, (len(raw), len(raw))]:
                keep.update(raw[at:a])
                at = b
            rows.append((has_id, d, len(raw), sum(b - a for a, b in runs), len(runs), keep.hexdigest()))
        yield pd.DataFrame(rows, columns=["has_id", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def keyed(docs: DataFrame) -> DataFrame:
    """KEY and text of each row."""
    known = F.col("doc_id").isNotNull()
    return docs.select(known.alias("has_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.xxhash64("text").alias("digest"), "text")


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for each row of ``docs``.

    A null text is empty; texts under LENGTH bytes keep everything. Documents come in the order of their ids, those
    without one before all others; different texts under one id (or none) are documents of their own, in the order
    of their digests. Rows that share an id and a text count as one document that both show. Of further
    columns nothing is used; an empty table gives no rows.
    """
    plain = keyed(docs)
    spans = save(removed_spans(plain), "spans")
    out = plain.join(spans, KEY, "left").mapInPandas(_cut, "has_id boolean, doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_suffix_dedup(spark, docs: DataFrame) -> DataFrame:
    """What substring deduplication removes from each row; edge rows as ``dedup_substrings`` states."""
    return dedup_substrings(docs)

"""Benchmark decontamination by pigeonhole edit matching.

An item that may differ by up to k edits is split into k + 1 pieces; in any match one piece stands
unchanged. An Aho-Corasick automaton finds exact piece hits in each whole document, and Myers'
bit-parallel algorithm verifies the item's edit distance around each hit.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .words import words

#: Edits allowed, as a share of an item's normal characters; the shortest piece allowed.
ERROR_RATE, MIN_PIECE = 0.05, 12
#: Characters of the items that go to the executors at once; a larger benchmark takes more rounds.
BLOCK_CHARS = 4_000_000

SCHEMA = "doc_id long, item_id long, distance int, budget int, match_start long, match_end long"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()), ("match_start", pa.int64()), ("match_end", pa.int64())]
)


def normal(text: str | None) -> str:
    """Lower-case words, one space before, between and after."""
    return f" {b' '.join(words(text)).decode()} "


def budget(item: str) -> int:
    return max(0, min(math.floor(ERROR_RATE * len(item)), len(item) // MIN_PIECE - 1))


def split(item: str, k: int) -> list[tuple[int, str]]:
    """k + 1 pieces of near equal lengths with their offsets."""
    cuts = [len(item) * i // (k + 1) for i in range(k + 2)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:])]


def myers(item: str, text: str, k: int) -> tuple[int, int] | None:
    """The least edit distance of the item to any part of ``text`` and where that part ends (first such end);
    None if it's over k."""
    m, eq = len(item), defaultdict(int)
    for i, c in enumerate(item):
        eq[c] |= 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best = full, 0, m, None
    for j, c in enumerate(text):
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph, mh = mv | (full & ~(xh | pv)), pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv, mv = mh | (full & ~(xv | ph)), ph & xv
        if score <= k and (best is None or score < best[0]):
            best = (score, j + 1)
    return best


class Matcher:
    """Finds all items of a block in a text."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = [(i, x, budget(x)) for i, x in items]
        pieces = defaultdict(list)
        for n, (_, x, k) in enumerate(self.items):
            for offset, piece in split(x, k):
                pieces[piece].append((n, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, of in pieces.items():
            self.automaton.add_word(piece, (len(piece), of))
        if pieces:
            self.automaton.make_automaton()
        self.any = bool(pieces)

    def find(self, text: str | None) -> list[tuple[int, int, int, int, int]]:
        """(item_id, distance, budget, start, end) in the normal text, each item's nearest and first match."""
        if not text or not self.any:
            return []
        doc, starts = normal(text), defaultdict(set)
        for end, (length, of) in self.automaton.iter(doc):
            for n, offset in of:
                starts[n].add(end - length + 1 - offset)
        out = []
        for n, places in starts.items():
            item_id, item, k = self.items[n]
            exact = [s for s in places if s >= 0 and doc.startswith(item, s)]
            if exact:
                out.append((item_id, 0, k, min(exact), min(exact) + len(item)))
                continue
            if not k:
                continue
            best, spans = None, []
            for s in sorted(places):
                lo, hi = max(0, s - k), min(len(doc), s + len(item) + k)
                if spans and lo <= spans[-1][1]:
                    spans[-1][1] = hi
                else:
                    spans.append([lo, hi])
            for lo, hi in spans:
                got = myers(item, doc[lo:hi], k)
                if got and (best is None or got[0] < best[0]):
                    best = (got[0], lo + got[1])
            if best:
                out.append((item_id, best[0], k, max(0, best[1] - len(item)), best[1]))
        return out


def _blocks(benchmark: DataFrame):
    """Matchers of the benchmark's items, BLOCK_CHARS of text at a time, as broadcasts of (item_id, normal text)."""
    spark = benchmark.sparkSession
    items = benchmark.where(F.col("text").isNotNull()).select(F.col("item_id").cast("long"), "text")
    chars = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(chars / BLOCK_CHARS))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        yield spark.sparkContext.broadcast([(r.item_id, x) for r in part if (x := normal(r.text)).strip()])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """SCHEMA: each (document, item) whose distance is within the item's budget.

    Null or empty texts and items match nothing; repeated items and repeated documents are reported
    each; ids may be null; either table may be empty; of further columns nothing is used. Offsets count
    characters of the normal text, which is searched whole however long it is.
    """
    plain, found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), None
    for shipped in _blocks(benchmark):

        def search(batches: Iterator[pa.RecordBatch], shipped=shipped) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(shipped.value)
            for batch in batches:  # Arrow keeps an id beside a null one as it is
                rows = [(d, *hit) for d, t in zip(*(c.to_pylist() for c in batch.columns)) for hit in matcher.find(t)]
                columns = list(zip(*rows)) or [[]] * len(ARROW)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

        hits = plain.mapInArrow(search, SCHEMA)
        found = hits if found is None else found.unionByName(hits)
    return found


def op4_decontamination(spark, docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Each (document, benchmark item) match; edge rows as ``contaminated`` states."""
    return contaminated(docs, benchmark)


def _clean(shipped):
    @F.pandas_udf("boolean")
    def clean(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        matcher = Matcher(shipped.value)
        for batch in texts:
            yield pd.Series([not matcher.find(t) for t in batch], dtype=bool)

    return clean


def keep_uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pipeline stage: rows of ``docs`` whose text matches no benchmark item, with all their columns.

    Each row is judged by its own text, so null ids, ids that two texts share and repeated rows are kept or
    dropped like others. Null and empty texts stay; an empty table gives no rows, an empty benchmark drops none.
    """
    for shipped in _blocks(benchmark):
        docs = docs.where(_clean(shipped)("text"))
    return docs

"""Best-fit-decreasing packing of tokenised documents into sequences.

A piece fits into the open sequence whose remaining room is tightest, found in logarithmic time in
a segment tree over remaining capacities. Lengths are bounded by the sequence length, so the
decisions depend on the histogram of lengths alone: the driver reads at most ``capacity * BUCKETS`` counts
and one for each BUCKET_ROWS pieces, and hands out ranges (nth piece of a length -> sequence), at most one
for each length and each room that is open when its turn comes, ``capacity ** 2 / 2`` in all.
Executors place the pieces with these.
"""

from __future__ import annotations

import base64
import math
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .session import save

CAPACITY = 1024
END_ID = 2
#: Pieces of one length are numbered in so many buckets, more if a bucket would hold over BUCKET_ROWS of them, so a hot length
#: isn't one task.
BUCKETS, BUCKET_ROWS = 64, 1_000_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
ARROW = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])


class CapacityTree:
    """Which remaining capacities (0..n-1) have open sequences: add, remove, first at least x in O(log n)."""

    def __init__(self, n: int):
        self.size = 1 << (n - 1).bit_length() if n > 1 else 1
        self.count = [0] * (2 * self.size)

    def add(self, at: int, change: int) -> None:
        node = at + self.size
        while node:
            self.count[node] += change
            node //= 2

    def first_at_least(self, x: int) -> int | None:
        if x >= self.size:
            return None
        node = x + self.size
        if self.count[node]:
            return x
        while node > 1:  # up to the first right sibling that has any, then down its left side
            if node % 2 == 0 and self.count[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.count[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None


def best_fit_decreasing(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges (length, lo, hi, sequence, per_sequence, offset): the nth piece of the length, lo <= n < hi,
    goes to sequence + (n - lo) // per_sequence at offset + (n - lo) % per_sequence * length.

    The same as best fit decreasing piece by piece: the tightest sequence stays the tightest until the
    length no longer fits, so it takes as many of the length as it holds.
    """
    tree, open_at, ranges, made = CapacityTree(capacity + 1), defaultdict(list), [], 0

    def keep(room: int, base: int, count: int) -> None:
        if room and count:
            open_at[room].append((base, count))
            tree.add(room, count)

    for length in sorted(histogram, reverse=True):
        lo, left = 0, histogram[length]
        while left:
            room = tree.first_at_least(length)
            if room is None:
                room, base, count = capacity, made, -(-left // (capacity // length))
                made += count
            else:
                base, count = open_at[room].pop()
                tree.add(room, -count)
            holds = room // length
            full = min(count, left // holds)
            if full:
                ranges.append((length, lo, lo + full * holds, base, holds, capacity - room))
                keep(room - holds * length, base, full)
                lo, left = lo + full * holds, left - full * holds
            rest = count - full
            if rest and left:  # fewer are left than one more sequence holds
                ranges.append((length, lo, lo + left, base + full, left, capacity - room))
                keep(room - left * length, base + full, 1)
                full, rest, left = full + 1, rest - 1, 0
            keep(room, base + full, rest)
    return ranges


def encoder(tokenizer_path: str):
    """text -> numpy array of ids, as the tokenizer gives them. The ranks beside the tokenizer's file give the same ids
    several times faster; a text that holds one of its special tokens, or any text if there are no ranks, goes to
    the tokenizer itself."""
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer_path)
    slow = lambda text: np.array(own.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
    special = [t.content for t in own.get_added_tokens_decoder().values()]
    try:
        import public_tokenizers
        import tiktoken

        with open(tokenizer_path.removesuffix(".json") + ".tiktoken", "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    except (ImportError, OSError):
        return slow
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        if any(t in text for t in special):
            return slow(text)
        try:
            return fast.encode_to_numpy(text, disallowed_special=())
        except Exception:  # noqa: BLE001  a very long run may exceed the fast splitter's stack
            return slow(text)

    return encode


def pieces_of(ids: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int]]:
    """(piece, start, length, crc of little-endian ids): whole if it fits, else full pieces after a shorter first."""
    n = len(ids)
    first = n - (-(-n // capacity) - 1) * capacity
    cuts = [0, *range(first, n + 1, capacity)]
    return [(i, a, b - a, zlib.crc32(ids[a:b].astype("<u4").tobytes())) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]


def tokenise(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of each document: ids of the whole text, then END_ID. Null texts are empty: one id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(tokenizer_path), np.array([END_ID], dtype=np.uint32)
        for batch in batches:  # Arrow keeps an id beside a null one as it is
            rows = [
                (d, *piece)
                for d, t in zip(*(c.to_pylist() for c in batch.columns))
                for piece in pieces_of(np.concatenate([encode(t).astype(np.uint32), end]) if t else end, capacity)
            ]
            columns = list(zip(*rows)) or [[]] * len(ARROW)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, ARROW)], schema=ARROW)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, PIECE_SCHEMA)


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (PIECE_SCHEMA) with sequence_id and offset. They are written to the shared folder once, with a number
    that tells rows apart; ties and repeated rows are pieces of their own; an empty table gives no rows."""
    spark = pieces.sparkSession
    pieces = save(pieces.withColumn("number", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # `capacity` rows at most
    spread = spark.createDataFrame([(k, max(BUCKETS, math.ceil(n / BUCKET_ROWS))) for k, n in histogram.items()], "length long, buckets int")
    pieces = pieces.join(F.broadcast(spread), "length").withColumn("bucket", F.pmod(F.xxhash64("number"), F.col("buckets")).cast("int"))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    table = pd.DataFrame(counts.collect(), columns=["length", "bucket", "n"])
    table = table.astype("int64").sort_values(["length", "bucket"])
    table["before"] = table.groupby("length")["n"].cumsum() - table["n"]
    before = spark.createDataFrame([(int(a), int(b), int(c)) for a, b, c in zip(table.length, table.bucket, table.before)], "length long, bucket int, before long")
    ranges = spark.createDataFrame(
        [(n, lo, hi, s, per, at) for n, lo, hi, s, per, at in best_fit_decreasing(histogram, capacity)],
        "length long, lo long, hi long, sequence long, per long, at long",
    )
    order = Window.partitionBy("length", "bucket").orderBy("number")
    numbered = pieces.withColumn("row", F.row_number().over(order) - 1).join(F.broadcast(before), ["length", "bucket"])
    nth = F.col("before") + F.col("row")
    step = F.col("nth") - F.col("lo")
    return (
        numbered.withColumn("nth", nth)
        .join(F.broadcast(ranges.withColumnRenamed("length", "of")), (F.col("length") == F.col("of")) & (F.col("nth") >= F.col("lo")) & (F.col("nth") < F.col("hi")))
        .select(
            "doc_id", "piece", "start", "length", "ids_crc32",
            (F.col("sequence") + F.floor(step / F.col("per"))).cast("long").alias("sequence_id"),
            (F.col("at") + step % F.col("per") * F.col("length")).cast("long").alias("offset"),
        )
    )


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_packing(spark, docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Each document's pieces with sequence and offset. Tokens are written to the shared folder once; they are counted,
    then placed. A null or empty text is one piece of length 1; rows that repeat an id or a text are packed each;
    of further columns nothing is used; an empty table gives no rows."""
    return pack(tokenise(docs, tokenizer_path or default_tokenizer()))

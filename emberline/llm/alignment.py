"""Alignment of two tokenizers over exact-text duplicates.

Documents are shuffled by their full text; each distinct text is tokenised and aligned once. Texts are aligned in blocks:
a block lists its distinct linked id pairs with the number of documents that hold them (copies count by multiplicity), and
its texts refer to that list. Counts of pairs are summed over the blocks, each block gets the counts of its own
pairs back, and the measures of a text are joined to all documents that have it.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .session import save

#: A block ends when its texts reach so many bytes; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: A text with at least this share of all documents is hot: at most 1 / HOT_SHARE texts, whose documents are dealt to HOT_PARTS keys.
HOT_SHARE, HOT_PARTS = 0.001, 64

MEASURES = "text_key binary, copies long, block long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, at array<int>, times array<int>"
_PAIRS = "block long, pairs array<long>, documents array<long>"
_ARROW = pa.schema([
    ("text_key", pa.binary()), ("copies", pa.int64()), ("block", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("at", pa.list_(pa.int32())), ("times", pa.list_(pa.int32())),
    ("pairs", pa.list_(pa.int64())), ("documents", pa.list_(pa.int64())),
])


class ByteTokenizer:
    """Ids of space + text by the byte-level tokenizer, with special tokens' strings as plain text; ``bytes_of[id]``."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self._own = Tokenizer.from_file(path)
        self._own.encode_special_tokens = True
        # The usual byte-level alphabet: printable bytes stand for themselves, the others for the characters from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        vocab = self._own.get_vocab(with_added_tokens=True)
        self.bytes_of = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(byte_of[c] for c in token) if all(c in byte_of for c in token) else token.encode()
        self._fast = None
        try:
            import public_tokenizers
            import tiktoken

            with open(path.removesuffix(".json") + ".tiktoken", "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            self._fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        except (ImportError, OSError):
            pass  # no ranks beside the file: the tokenizer itself gives the same ids, slower

    def encode(self, text: str) -> np.ndarray:
        if self._fast:
            try:
                return np.array(self._fast.encode_ordinary(" " + text), dtype=np.int64)
            except BaseException as e:  # a run too long for the splitter's stack ends in a panic of the native library
                if type(e).__name__ not in ("PanicException", "ValueError"):
                    raise
        return np.array(self._own.encode(" " + text, add_special_tokens=False).ids, dtype=np.int64)


class PieceTokenizer:
    """Ids of text by the piece tokenizer, which adds the space itself; ``bytes_of[id]``."""

    def __init__(self, path: str):
        import sentencepiece

        self._own = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of = []
        for i in range(self._own.get_piece_size()):
            piece = self._own.id_to_piece(i)
            self.bytes_of.append(bytes([int(piece[3:5], 16)]) if self._own.is_byte(i) else piece.replace("▁", " ").encode())

    def encode(self, text: str) -> np.ndarray:
        return np.array(self._own.encode(text, num_threads=1), dtype=np.int64)


class Aligner:
    """Both tokenizers, and what a text's alignment needs of their vocabularies."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokenizer(byte_path), PieceTokenizer(piece_path)
        self.sizes = [np.array([len(x) for x in t.bytes_of], dtype=np.int64) for t in (self.a, self.b)]
        # An id as it stands within its side of a group, and at that side's end.
        texts = [[f"{i}{end}" for i in range(len(t.bytes_of)) for end in (",", last)] for t, last in ((self.a, "|"), (self.b, ";"))]
        self.texts = [np.array(x, dtype=object) for x in texts]

    def align(self, text: str | None):
        """(n_a, n_b, n_groups, links as (a << 32 | b), hash), or None where a text has no tokens."""
        if not text:
            return None
        whole = (" " + text).encode("utf-8", "surrogatepass")
        a, b = self.a.encode(text), self.b.encode(text)
        if any(b"".join(map(t.bytes_of.__getitem__, ids.tolist())) != whole for t, ids in ((self.a, a), (self.b, b))):
            return None
        ends_a, ends_b = np.cumsum(self.sizes[0][a]), np.cumsum(self.sizes[1][b])
        ends = np.union1d(ends_a, ends_b)  # each stretch between two of these lies in one token of either side: a link
        of_a, of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        last_a, last_b = np.isin(ends_a, ends_b, assume_unique=True), np.isin(ends_b, ends_a, assume_unique=True)
        groups = int(last_a.sum())
        # Where tokens stand when each group gives its A ids, then its B ids.
        till_a, till_b = np.r_[0, np.flatnonzero(last_a) + 1], np.r_[0, np.flatnonzero(last_b) + 1]
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        out = np.empty(len(a) + len(b), dtype=object)
        out[np.arange(len(a)) + till_b[group_a]] = self.texts[0][2 * a + last_a]
        out[np.arange(len(b)) + till_a[group_b + 1]] = self.texts[1][2 * b + last_b]
        digest = hashlib.sha256("".join(out.tolist())[:-1].encode()).hexdigest()
        return len(a), len(b), groups, (a[of_a] << 32) | b[of_b], digest


def _block_rows(block: int, texts: list[tuple]) -> pa.RecordBatch:
    """A block's texts, each with the places of its pairs in the block's list, and that list as one more row."""
    found = [x[2] for x in texts]
    each = [np.unique(x[3], return_counts=True) if x else (np.empty(0, np.int64), np.empty(0, np.int64)) for x in found]
    pairs, place = np.unique(np.concatenate([p for p, _ in each]), return_inverse=True)
    documents = np.zeros(len(pairs), dtype=np.int64)
    cuts = np.cumsum([0, *(len(p) for p, _ in each)])
    np.add.at(documents, place, np.repeat([x[1] for x in texts], np.diff(cuts)))
    rows = [
        (key, copies, block, *((x[0], x[1], x[2], len(x[3]), x[4]) if x else (0, 0, 0, 0, "")), place[lo:hi], times, None, None)
        for (key, copies, x), (_, times), lo, hi in zip(texts, each, cuts, cuts[1:])
    ]
    rows.append((None, None, block, None, None, None, None, None, None, None, pairs, documents))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


def _aligner(byte_path: str, piece_path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizers, block, held, size = None, TaskContext.get().partitionId() << 32, [], 0
        for batch in batches:
            for key, text, copies in zip(*(batch.column(n).to_pylist() for n in ("text_key", "text", "copies"))):
                tokenizers = tokenizers or Aligner(byte_path, piece_path)
                if held and size + len(text) > BLOCK_BYTES:
                    yield _block_rows(block, held)
                    block, held, size = block + 1, [], 0
                held.append((key, copies, tokenizers.align(text)))
                size += len(text)
        if held:
            yield _block_rows(block, held)

    return run


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n_best and count_sum of each text of a block, from the counts of the block's pairs."""
    flat = lambda c: (c.offsets.to_numpy(), c.values.to_numpy(zero_copy_only=False))
    for batch in batches:
        held = {n: batch.column(n) for n in batch.schema.names}
        (ca, counts), (ba, best) = flat(held["counts"]), flat(held["best"])
        rows = []
        for i, texts in enumerate(held["texts"]):
            if not texts.is_valid:
                continue
            v = texts.values
            here, top = counts[ca[i] : ca[i + 1]], best[ba[i] : ba[i + 1]]
            (pa_, at), (ta, times) = flat(v.field("at")), flat(v.field("times"))
            for key, copies, n_a, n_b, n_groups, n_links, digest, lo, hi, t in zip(
                *(v.field(n).to_pylist() for n in ("text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")), pa_, pa_[1:], ta
            ):
                own, n = at[lo:hi], times[t : t + hi - lo].astype(np.int64)
                rows.append((key, copies, n_a, n_b, n_groups, n_links, int(n[top[own]].sum()), int((n * here[own]).sum()), digest))
        names = ["text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
        types = [pa.binary(), *[pa.int64()] * 7, pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(names), types)], names=names)


def align_texts(texts: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """text_key, copies and the measures of each distinct text. ``texts``: text_key binary, text string (not null), copies long.

    A text's block keeps its number when read again, as the aligned rows are written to the shared folder first."""
    aligned = save(texts.mapInArrow(_aligner(byte_path, piece_path), f"{MEASURES}, pairs array<long>, documents array<long>"), "aligned")
    lists = aligned.where(F.col("pairs").isNotNull()).select("block", "pairs", "documents")
    listed = lists.select("block", F.posexplode(F.arrays_zip("pairs", "documents")).alias("at", "x")).select("block", "at", "x.pairs", "x.documents")
    counts = save(listed.groupBy("pairs").agg(F.sum("documents").alias("count")), "pair_counts")
    a = F.shiftright("pairs", 32)
    best = counts.groupBy(a.alias("a")).agg(F.max("count").alias("highest"))
    counts = counts.withColumn("a", a).join(best, "a").select("pairs", "count", (F.col("count") == F.col("highest")).alias("best"))
    asked = listed.select("block", "at", "pairs").join(counts, "pairs").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "count", "best"))).alias("x"))
    asked = asked.select("block", F.col("x.count").alias("counts"), F.col("x.best").alias("best"))
    own = aligned.where(F.col("pairs").isNull()).select("block", F.struct("text_key", "copies", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "at", "times").alias("text"))
    blocks = own.groupBy("block").agg(F.collect_list("text").alias("texts")).join(asked, "block", "left")
    none = lambda kind: F.array().cast(f"array<{kind}>")  # noqa: E731  a block whose texts have no tokens lists no pairs
    blocks = blocks.select("texts", F.coalesce("counts", none("long")).alias("counts"), F.coalesce("best", none("boolean")).alias("best"))
    return blocks.mapInArrow(_measure, "text_key binary, copies long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_documents(docs: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """doc_id and the measures of the document's text, a row for each row of ``docs``.

    A null or empty text has no tokens: zeros and ''; so has one whose pieces don't spell space + text. Rows that repeat an
    id or a text count as documents each. Of further columns nothing is used; an empty table gives no rows."""
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    key = F.unhex(F.sha2("text", 256)).alias("text_key")
    distinct = keyed.groupBy("text").agg(F.count("*").alias("copies")).select(key, "text", "copies")
    measures = save(align_texts(distinct, byte_path, piece_path), "measures")
    total = measures.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    # Hot texts, at most 1 / HOT_SHARE of them, are known to all: their documents take a part of the key each.
    hot = [bytes(r.text_key) for r in measures.where(F.col("copies") > F.lit(total * HOT_SHARE)).select("text_key").collect()]
    hot = F.broadcast(spark.createDataFrame([(k, HOT_PARTS) for k in hot], "text_key binary, parts int"))
    parts = F.coalesce("parts", F.lit(1))
    ids = keyed.select("doc_id", key).join(hot, "text_key", "left").select("doc_id", "text_key", F.floor(F.rand(7) * parts).cast("int").alias("part"))
    sides = measures.drop("copies").join(hot, "text_key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    return ids.join(sides, ["text_key", "part"]).select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_alignment(spark, docs: DataFrame, byte_path: str | None = None, piece_path: str | None = None) -> DataFrame:
    """Alignment measures of each document; edge rows as ``align_documents`` states."""
    import public_tokenizers

    return align_documents(docs, byte_path or public_tokenizers.path("byte_bpe_50k.json"), piece_path or public_tokenizers.path("piece_bpe_32k.model"))

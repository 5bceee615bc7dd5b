"""N-gram Jaccard self-join with Bayesian candidate pruning.

Texts are sets of five-word shingles. Equal texts are joined once, by digest. MinHash bands bring
together texts that may be similar. Within a band's bucket the MinHash values are compared a few at a
time, and a pair is dropped as soon as the posterior probability that its similarity reaches the
threshold falls below a tolerance. Only texts that such pairs connect are fetched; in blocks, pairs are
pruned again and the rest is verified on the whole shingle sets. Links are counted where they are found: no
pair of documents is ever a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from .components import connected_components
from .session import free_name, save
from .words import words

WORDS, THRESHOLD = 5, 0.8
#: A pair at the threshold shares no band with probability (1 - 0.8 ** 4) ** 32 = 5e-8, more similar ones far less.
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
#: MinHash values compared at once, and the posterior probability below which a pair is dropped.
STEP, TOLERANCE = 16, 1e-7
#: Texts of a group that one task compares with so many others at once.
BLOCK = 384

_rng = np.random.default_rng(20_240_601)
_MULTIPLY = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Distinct shingle hashes of a text; word hashes are kept, up to a bound, as words recur."""

    KEEP = 400_000

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        found, known = words(text), self.known
        if not found:
            return np.zeros(0, dtype=np.uint64)
        if len(known) > self.KEEP:
            known.clear()
        try:
            ids = [known[w] for w in found]
        except KeyError:
            for w in found:
                if w not in known:
                    known[w] = xxhash.xxh64_intdigest(w)
            ids = [known[w] for w in found]
        h = np.array(ids, dtype=np.uint64)
        n = min(WORDS, len(h))
        out = np.zeros(len(h) - n + 1, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for i in range(n):
                out = (out ^ h[i : len(h) - n + 1 + i]) * _MIX
                out ^= out >> np.uint64(29)
        return np.unique(out)


def minhash(shingles: np.ndarray) -> np.ndarray:
    """HASHES minima as 32-bit numbers."""
    best = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(shingles), 512):
            part = shingles[i : i + 512, None] * _MULTIPLY + _ADD
            np.minimum(best, part.min(axis=0), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def packed(signature: np.ndarray) -> bytes:
    """The upper half of each value: what bands and pruning compare. It may make values agree, never differ."""
    return (signature >> np.uint32(16)).astype("<u2").tobytes()


def band_keys() -> Column:
    """A key for each band of the column ``sig``."""
    width = 2 * ROWS
    return F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("sig", b * width + 1, F.lit(width))))


def least_matches(threshold: float, tolerance: float = TOLERANCE) -> list[int]:
    """After STEP, 2 STEP, ... values: the fewest matches at which a pair is kept.

    With a uniform prior the posterior P(similarity >= t | m of n agree) is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total = 0.0
        for m in range(n + 1):
            total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                out.append(m)
                break
    return out


def unpruned_pairs(a_sigs, a_sizes, b_sigs, b_sizes, same: bool, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that Bayesian pruning and the sets' sizes leave; ``same``: i < j only."""
    least = least_matches(threshold)
    count = np.zeros((len(a_sigs), len(b_sigs)), dtype=np.int16)
    for k in range(STEP):
        count += a_sigs[:, k, None] == b_sigs[None, :, k]
    fits = np.minimum(a_sizes[:, None], b_sizes) >= threshold * np.maximum(a_sizes[:, None], b_sizes) - 1e-9
    alive = (count >= least[0]) & fits
    if same:
        alive = np.triu(alive, 1)
    i, j = np.nonzero(alive)
    seen = count[i, j]
    for step in range(1, HASHES // STEP):
        if not len(i):
            break
        span = slice(step * STEP, (step + 1) * STEP)
        seen = seen + (a_sigs[i, span] == b_sigs[j, span]).sum(axis=1)
        keep = seen >= least[step]
        i, j, seen = i[keep], j[keep], seen[keep]
    return i, j


def similar_pairs(a_sigs, a_sets, b_sigs, b_sets, same: bool, threshold: float) -> list[tuple[int, int]]:
    """Index pairs whose sets' Jaccard similarity reaches the threshold; ``same``: i < j only."""
    sizes_a, sizes_b = np.array([len(s) for s in a_sets]), np.array([len(s) for s in b_sets])
    i, j = unpruned_pairs(a_sigs, sizes_a, b_sigs, sizes_b, same, threshold)
    out = []
    for x, y in zip(i.tolist(), j.tolist()):
        common = len(a_sets[x] & b_sets[y])
        if common >= threshold * (len(a_sets[x]) + len(b_sets[y]) - common) - 1e-9:
            out.append((x, y))
    return out


def digest():
    """A text's identity; null is the empty text."""
    return F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))


def id_key() -> Column:
    """The id as text that equals for null ids too."""
    return F.coalesce(F.col("doc_id").cast("string"), F.lit(""))


SIGNED = pa.schema([("doc_id", pa.int64()), ("digest", pa.binary()), ("n", pa.int64()), ("sig", pa.binary())])


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of shingles and signature of each text; no signature without a word."""
    shingle = Shingler()
    for batch in batches:  # Arrow keeps an id beside a null one as it is
        sets = [shingle(t) for t in batch.column(2).to_pylist()]
        sigs = [packed(minhash(s)) if len(s) else None for s in sets]
        columns = [batch.column(0), batch.column(1).cast(pa.binary()), pa.array([len(s) for s in sets], pa.int64()), pa.array(sigs, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, schema=SIGNED)


def _blocks(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, bool]:
    """Of one comparison's rows: places of the lower and of the higher block, and whether these are the same block."""
    lo, hi, block = rows.lo.iloc[0], rows.hi.iloc[0], rows.block.to_numpy()
    return np.flatnonzero(block == lo), np.flatnonzero(block == hi), lo == hi


def _runs(batches: Iterator[pd.DataFrame], of: list[str]) -> Iterator[pd.DataFrame]:
    """Rows that agree in ``of``, from sorted batches; at most two blocks of rows each."""
    kept = None
    for batch in batches:
        rows = batch if kept is None else pd.concat([kept, batch], ignore_index=True)
        ends = np.flatnonzero((rows[of] != rows[of].shift(-1)).any(axis=1).to_numpy()[:-1]) + 1 if len(rows) else []
        start = 0
        for end in ends:
            yield rows.iloc[start:end]
            start = end
        kept = rows.iloc[start:] if start < len(rows) else None
    if kept is not None:
        yield kept


def _pruner(threshold: float):
    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Of each bucket, or two blocks of it: members that unpruned pairs connect, with one of their group."""
        out = []
        for run in _runs(batches, ["key", "lo", "hi"]):
            sigs = np.frombuffer(b"".join(run.sig), dtype="<u2").reshape(len(run), HASHES)
            sizes, (left, right, same) = run.n.to_numpy(), _blocks(run)
            i, j = unpruned_pairs(sigs[left], sizes[left], sigs[right], sizes[right], same, threshold)
            i, j, top = left[i], right[j], np.arange(len(run))
            while True:
                before = top.copy()
                np.minimum.at(top, i, top[j])
                np.minimum.at(top, j, top[i])
                top = top[top]
                if (top == before).all():
                    break
            names = run.digest.to_numpy()
            out += [(names[x], names[t]) for x, t in enumerate(top.tolist()) if x != t]
            if len(out) > 20_000:
                yield pd.DataFrame(out, columns=["u", "v"])
                out = []
        yield pd.DataFrame(out, columns=["u", "v"])

    return prune


def _linker(threshold: float):
    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows arrive sorted by (root, lo, hi); each such run is one comparison of two blocks."""
        shingle = Shingler()
        for run in _runs(batches, ["root", "lo", "hi"]):
            left, right, same = _blocks(run)
            run = list(run.itertuples(index=False))
            hashes = [shingle(r.text) for r in run]
            sigs = np.stack([minhash(h) for h in hashes])
            sets = [frozenset(h.tolist()) for h in hashes]
            texts, documents, parent = [0] * len(run), [0] * len(run), list(range(len(run)))

            def top(x: int) -> int:
                while parent[x] != x:
                    parent[x] = parent[parent[x]]
                    x = parent[x]
                return x

            if len(left) and len(right):
                for i, j in similar_pairs(sigs[left], [sets[n] for n in left], sigs[right], [sets[n] for n in right], same, threshold):
                    a, b = left[i], right[j]
                    texts[a], texts[b] = texts[a] + 1, texts[b] + 1
                    documents[a], documents[b] = documents[a] + run[b].copies, documents[b] + run[a].copies
                    a, b = sorted((top(a), top(b)))
                    parent[b] = a
            linked = [n for n in range(len(run)) if texts[n]]
            yield pd.DataFrame(
                [(run[n].digest, run[top(n)].digest, texts[n], documents[n]) for n in linked],
                columns=["digest", "linked_to", "texts", "documents"],
            )

    return link


def _dealt(members: DataFrame, group: str) -> DataFrame:
    """``members`` (with the columns digest and ``size``, the size of the group) once for each pair of blocks of the group
    that a member takes part in, as lo, hi and block: however large a group is, a task compares two blocks of it."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("digest"), blocks).cast("int")
    dealt = members.select("*", block.alias("block"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    pairs = dealt.select("*", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi")).drop("size", "other")
    return pairs.repartition(group, "lo", "hi").sortWithinPartitions(group, "lo", "hi")


def _candidates(texts: DataFrame, threshold: float) -> DataFrame:
    """(node, root) of texts that unpruned pairs of the bands' buckets connect. Of buckets with the same members one is compared."""
    bands = texts.where(F.col("sig").isNotNull()).select("digest", F.explode(band_keys()).alias("key"))
    full = bands.groupBy("key").agg(F.min("digest").alias("first"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("digest")).alias("members")).where("size > 1")
    once = full.groupBy("first", "size", "members").agg(F.min("key").alias("key")).select("key", "size")
    members = bands.join(once, "key").join(texts.select("digest", "n", "sig"), "digest")
    edges = _dealt(members, "key").select("key", "lo", "hi", "block", "digest", "n", "sig").mapInPandas(_pruner(threshold), "u binary, v binary")
    return connected_components(save(edges, "unpruned"))


def _classes(docs: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Each row's doc_id and digest; and of each text: digest, first_id, copies, root, texts and documents linked."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("digest", digest())
    signed = save(plain.select("doc_id", "digest", "text").mapInArrow(_sign, "doc_id long, digest binary, n long, sig binary"), "signatures")
    one = F.first(F.struct("n", "sig")).alias("one")
    texts = signed.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("copies"), one)
    texts = save(texts.select("digest", "first_id", "copies", "one.*"), "texts")
    candidates = save(_candidates(texts, threshold), "candidates")
    members = candidates.join(candidates.groupBy("root").agg(F.count("*").alias("size")), "root").withColumnRenamed("node", "digest")
    members = members.join(texts.select("digest", F.col("first_id").alias("doc_id"), "copies"), "digest").withColumn("of_id", id_key()).drop("doc_id")
    # Of the copies of a text, the row with its first id is fetched; of rows that repeat that too, one.
    fetched = plain.withColumn("of_id", id_key()).join(members, ["digest", "of_id"]).dropDuplicates(["digest"])
    found = _dealt(fetched.select("root", "size", "digest", "copies", "text"), "root").mapInPandas(
        _linker(threshold), "digest binary, linked_to binary, texts long, documents long"
    )
    found = save(found, "links")
    # Within one comparison the classes are known; those of several blocks meet here.
    classes = connected_components(found.select(F.col("digest").alias("u"), F.col("linked_to").alias("v")))
    counted = found.groupBy("digest").agg(F.sum("texts").alias("texts"), F.sum("documents").alias("documents"))
    per_text = texts.select("digest", "first_id", "copies").join(classes.withColumnRenamed("node", "digest"), "digest", "left").join(counted, "digest", "left")
    return signed.select("doc_id", "digest"), per_text.withColumn("root", F.coalesce("root", "digest"))


def jaccard_join(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (least doc_id of its class), n_links (other documents whose
    similarity reaches the threshold, copies included) and n_text_links (different texts among them).

    Classes are the connected components of the links. Texts of fewer than five words are one shingle;
    equal texts are similar, also empty ones, and a null text is an empty one; texts without a word
    are similar to their copies only. Null ids are members like others, but name a class only if
    no other does. Of further columns nothing is used. An empty table gives no rows.
    """
    rows, per_text = _classes(docs, threshold)
    named = per_text.groupBy("root").agg(F.min("first_id").alias("class_id"))
    per_text = per_text.join(named, "root").select(
        "digest", "class_id",
        (F.coalesce("documents", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"),
        F.coalesce("texts", F.lit(0)).cast("long").alias("n_text_links"),
    )
    return rows.join(per_text, "digest").select("doc_id", "class_id", "n_links", "n_text_links")


def op7_ngram_jaccard(spark, docs: DataFrame) -> DataFrame:
    """Class and links of each document; edge rows as ``jaccard_join`` states."""
    return jaccard_join(docs)


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: of each class the row with the least id, with all its columns.

    A row stays by its id and text: of rows that repeat both, one. Rows with null ids go where any document with
    an id is like them; of a class of null ids only, one row stays. An empty table gives no rows.
    """
    _, per_text = _classes(docs, THRESHOLD)
    order = F.struct(F.col("first_id").isNull(), "first_id", "digest")
    text, of_id = free_name(docs, "digest_of_text"), free_name(docs, "text_of_id")
    first = per_text.groupBy("root").agg(F.min(order).alias("first")).select(F.col("first.digest").alias(text), F.col("first.first_id").alias("doc_id"))
    first = first.select(text, id_key().alias(of_id))
    nth = free_name(docs, "nth")
    once = F.row_number().over(Window.partitionBy(text, of_id).orderBy(text))
    kept = docs.withColumn(text, digest()).withColumn(of_id, id_key()).join(first, [text, of_id]).withColumn(nth, once)
    return kept.where(F.col(nth) == 1).select(*docs.columns)


#: Brute force over all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(lower(coalesce(text, '')), '[\x00-\x20!-/:-@\[-`{-\x7F]+'), lambda x: x <> '') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
p AS (
  SELECT a, b FROM (SELECT a.doc_id AS a, b.doc_id AS b, a.n + b.n AS n, count(*) AS c
    FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL) q WHERE 5 * c >= 4 * (n - c)
  UNION SELECT a.doc_id, b.doc_id FROM d a JOIN d b ON a.t = b.t AND a.doc_id <> b.doc_id),
r(id, root) AS (SELECT doc_id, doc_id FROM d UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.id),
l AS (SELECT p.a, count(*) AS n_links, count(DISTINCT db.t) FILTER (WHERE db.t <> da.t) AS n_text_links
      FROM p JOIN d da ON da.doc_id = p.a JOIN d db ON db.doc_id = p.b GROUP BY p.a)
SELECT d.doc_id, c.class_id, coalesce(n_links, 0) AS n_links, coalesce(n_text_links, 0) AS n_text_links
FROM d JOIN (SELECT id, min(root) AS class_id FROM r GROUP BY id) c ON c.id = d.doc_id LEFT JOIN l ON l.a = d.doc_id
"""

"""A hierarchical Pitman-Yor language model of two words, learned by Gibbs sampling, and scores of texts by it.

Every word is a restaurant: its customers are the tokens that follow it, a dish is the word served. All of these
restaurants share one parent, the restaurant of single words, whose customers are their tables; its own parent is uniform. A
customer sits at a table of its dish with weight (customers there - discount), or opens one with weight (strength +
discount * tables) * parent's probability, and a new table is a new customer of the parent. A step of the sampler draws the tables
of a section (the customers of one dish in one restaurant) at once, from their law given all other sections. Predictive
probabilities are averaged over samples of the seating.

Texts are read once into blocks: token sequences over a block's own words. Blocks, words and (context, word) pairs are spread
over tasks by block number and by hash; they exchange arrays packed into one value for each block and bucket:

* words: blocks ask for their words' ids and counts, buckets of words give them;
* pairs: blocks send their distinct pairs, buckets of pairs count them. A pair seen once has one customer at one table whatever
  the sampling; the others are seated;
* each step of the sampler sends tables per word to the buckets of words, where the parent is seated, and back what the
  restaurants need of it. Tables of other tasks' pairs are as of the step before;
* at the end both kinds of buckets answer the blocks, which score their documents.
"""

from __future__ import annotations

import math
import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .session import crc32_of_id, save

#: A block ends at so many bytes of text (a longer text is a block of its own), and texts are split into words so many at a time.
BLOCK_BYTES, PART_BYTES = 12 << 20, 1 << 20
#: Tokens for each bucket of words or pairs.
BUCKET_TOKENS = 4_000_000
#: Steps of the sampler in which parents and children exchange tables, of which the first BURN_IN give no sample. SWEEPS: of ``gibbs``,
#: moves of a random customer for each customer of a section.
STEPS, BURN_IN, SWEEPS = 3, 1, 2
#: Sections of more customers take the law of their tables from a series, where doubles hold it, instead of from those of fewer customers.
FAR = 1 << 14
#: What is left out of a law is less than about exp(-NEGLIGIBLE) of its largest weight.
NEGLIGIBLE = 45.0
STRENGTH = 1.0
END = 0  # the id of the end of a text, which is also the context of its first word

_ROW = "kind string, to long, sender long, payload binary"
_ROW_ARROW = pa.schema([("kind", pa.string()), ("to", pa.int64()), ("sender", pa.int64()), ("payload", pa.binary())])
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def pack(**arrays: np.ndarray) -> bytes:
    """Arrays as one value: integers in the least width that holds them, byte by byte of all their values, compressed."""
    out = {}
    for name, a in arrays.items():
        if a.dtype.kind in "iu":
            a = a.astype(np.promote_types(np.min_scalar_type(a.min()), np.min_scalar_type(a.max()))) if len(a) else a.astype(np.uint8)
        out[name] = (a.dtype.str, len(a), np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(out))


def unpack(value: bytes) -> dict[str, np.ndarray]:
    out = {}
    for name, (kind, n, data) in pickle.loads(zstandard.ZstdDecompressor().decompress(value)).items():
        a = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, n).T
        a = np.ascontiguousarray(a).view(kind).reshape(n)
        out[name] = a.astype(np.int64) if a.dtype.kind in "iu" else a
    return out


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(list(zip(*rows)) or [[]] * 4, _ROW_ARROW)], schema=_ROW_ARROW)


def _received(table: pa.Table) -> Iterator[tuple[str, int, bytes]]:
    """(kind, sender, payload) by kind and sender."""
    return iter(sorted(zip(*(table.column(n).to_pylist() for n in ("kind", "sender", "payload"))), key=lambda r: r[:2]))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    block = TaskContext.get().partitionId() << 32

    def cut():
        nonlocal parts, docs, words, size, block
        encoded = pa.chunked_array(parts, pa.dictionary(pa.int32(), pa.binary())).unify_dictionaries()
        ids = np.concatenate([c.indices.to_numpy() for c in encoded.chunks] or [np.empty(0, np.int32)]).astype(np.int64) + 1
        own = encoded.chunks[-1].dictionary.to_pylist() if encoded.num_chunks else []
        n = np.array([d[2] for d in docs])
        known = [0 if d[0] is None else d[0] for d in docs]
        packed = pack(doc_id=np.array(known, np.int64), missing=np.array([d[0] is None for d in docs]), held=np.array([d[1] for d in docs]), n=n,
                      tokens=np.insert(ids, np.cumsum(n), END))
        row = (block, int(n.sum() + len(n)), packed, zstandard.ZstdCompressor(level=3).compress(b" ".join(own)))
        parts, docs, words, size, block = [], [], [], 0, block + 1
        return pa.RecordBatch.from_arrays([pa.array([x]) for x in row], names=["block", "n_tokens", "docs", "words"])

    parts, docs, words, size, held_bytes = [], [], [], 0, 0
    for batch in batches:
        for doc_id, held, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "held", "text"))):
            if docs and size + len(text) > BLOCK_BYTES:
                parts.append(pa.array(words, pa.binary()).dictionary_encode())
                yield cut()
                held_bytes = 0
            own = text.lower().split()  # of bytes: A-Z, and the six ASCII white spaces
            words += own
            docs.append((doc_id, held, len(own)))
            size, held_bytes = size + len(text), held_bytes + len(text)
            if held_bytes > PART_BYTES:
                parts.append(pa.array(words, pa.binary()).dictionary_encode())
                words, held_bytes = [], 0
    if docs:
        parts.append(pa.array(words, pa.binary()).dictionary_encode())
        yield cut()


def _learned(held: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each token, whether its document is one to learn from."""
    return np.repeat(~held, n + 1)


def _ask_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, docs, packed in zip(*(batch.column(n).to_pylist() for n in ("block", "docs", "words"))):
                d, words = unpack(docs), zstandard.ZstdDecompressor().decompress(packed).split()
                learned = np.bincount(d["tokens"][_learned(d["held"], d["n"])], minlength=len(words) + 1)[1:]
                to = np.array([zlib.crc32(w) for w in words], dtype=np.int64) % buckets
                order, rows = np.argsort(to, kind="stable"), []
                for at in np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(words) else []:
                    text = np.frombuffer(b" ".join([words[i] for i in at.tolist()]), np.uint8)
                    rows.append(("ask", int(to[at[0]]), block, pack(place=at + 1, learned=learned[at], words=text)))
                yield from _rows(rows).to_batches()

    return run


def _number_words(buckets: int):
    def run(key, table):
        """Ids by falling count, 1 + rank * buckets + bucket, -1 for words that no training text has; the bucket's counts by rank."""
        bucket, asks = key[0].as_py(), [(s, unpack(p)) for _, s, p in _received(table)]
        words = pa.chunked_array([pa.array(a["words"].astype(np.uint8).tobytes().split(), pa.binary()) for _, a in asks]).combine_chunks().dictionary_encode()
        at, own = words.indices.to_numpy(), words.dictionary
        count = np.zeros(len(own), dtype=np.int64)
        np.add.at(count, at, np.concatenate([a["learned"] for _, a in asks]))
        order = np.argsort(-count, kind="stable")
        ids = np.empty(len(own), dtype=np.int64)
        ids[order] = 1 + np.arange(len(own)) * buckets + bucket
        ids[count == 0] = -1
        cuts = np.cumsum([0, *(len(a["place"]) for _, a in asks)])
        rows = [("ids", s, bucket, pack(place=a["place"], id=ids[at[lo:hi]], count=count[at[lo:hi]])) for (s, a), lo, hi in zip(asks, cuts, cuts[1:])]
        return _rows([*rows, ("counts", bucket, int((count > 0).sum()), pack(count=count[order][: (count > 0).sum()]))])

    return run


def _slot(ids: np.ndarray, buckets: int) -> np.ndarray:
    """The place of a word in its bucket's arrays: END at 0 of bucket 0, the others by rank from 1."""
    return np.where(ids == END, 0, (ids - 1) // buckets + 1)


def _bucket(ids: np.ndarray, buckets: int) -> np.ndarray:
    return np.where(ids == END, 0, (ids - 1) % buckets)


def _by_word(kind: str, sender: int, ids: np.ndarray, buckets: int, **values: np.ndarray) -> list[tuple]:
    """Messages to the buckets of words: places (ascending ids within a bucket) and values."""
    to = _bucket(ids, buckets)
    order = np.lexsort((ids, to))
    parts = np.split(order, np.flatnonzero(np.diff(to[order])) + 1) if len(ids) else []
    return [(kind, int(to[p[0]]), sender, pack(slot=np.diff(_slot(ids[p], buckets), prepend=0), **{k: v[p] for k, v in values.items()})) for p in parts]


def _block_ids(replies: list[dict], n: int, field: str, missing: int = 0) -> np.ndarray:
    """A value for each of a block's own words, from the buckets' replies."""
    out = np.full(n, missing, dtype=np.int64)
    for r in replies:
        if field in r:  # a bucket of words that were never learned has no tables
            out[r["place"]] = r[field]
    return out


def _pairs(tokens: np.ndarray, ids: np.ndarray, buckets: int):
    """Distinct (context, word) pairs of known words as context << 32 | word, dealt out by bucket: keys, order by bucket, cuts, and for each token its pair or -1."""
    now = ids[tokens]
    before = np.r_[END, now[:-1]]
    known = (now >= 0) & (before >= 0)
    keys, at = np.unique((before[known] << 32) | now[known], return_inverse=True)
    of_token = np.full(len(tokens), -1, dtype=np.int64)
    of_token[known] = at
    to = ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)).astype(np.int64) % buckets
    order = np.argsort(to, kind="stable")
    return keys, order, np.searchsorted(to[order], np.arange(buckets + 1)), of_token


def _ask_pairs(buckets: int):
    def run(key, blocks, replies):
        block, d = key[0].as_py(), unpack(blocks.column("docs")[0].as_py())
        ids = _block_ids([unpack(p) for *_, p in _received(replies)], int(d["tokens"].max(initial=0)) + 1, "id")
        keys, order, cuts, of_token = _pairs(d["tokens"], ids, buckets)
        count = np.bincount(of_token[_learned(d["held"], d["n"]) & (of_token >= 0)], minlength=len(keys))
        rows = []
        for b in range(buckets):
            own = order[cuts[b] : cuts[b + 1]]
            if len(own):
                rows.append(("ask", b, block, pack(context=np.diff(keys[own] >> 32, prepend=0), word=keys[own] & 0xFFFFFFFF, count=count[own])))
        return _rows(rows)

    return run


def _count_pairs(buckets: int):
    def run(key, table):
        """For each block what its pairs are (0: not learned, 1: once, 2 + n: the nth section); the sections; tables per word, of pairs seen
        once for good and one of each section for the start; how many pairs were seen once and twice."""
        bucket, asks = key[0].as_py(), [(s, unpack(p)) for _, s, p in _received(table)]
        asked = [(np.cumsum(a["context"]) << 32) | a["word"] for _, a in asks]
        keys, at = np.unique(np.concatenate(asked), return_inverse=True)
        count = np.zeros(len(keys), dtype=np.int64)
        np.add.at(count, at, np.concatenate([a["count"] for _, a in asks]))
        code = np.minimum(count, 1)
        code[count >= 2] = 2 + np.arange((count >= 2).sum())
        cuts = np.cumsum([0, *map(len, asked)])
        rows = [("codes", bucket, s, pack(code=code[at[lo:hi]])) for (s, _), lo, hi in zip(asks, cuts, cuts[1:])]
        once, more = keys[count == 1], keys[count >= 2]
        rows.append(("state", bucket, 0, pack(keys=np.diff(more, prepend=0), count=count[count >= 2], sum=np.zeros(len(more), dtype=np.int64))))
        rows += _tables(bucket, once, np.ones(len(once), np.int64), buckets, "once") + _tables(bucket, more, np.ones(len(more), np.int64), buckets, "tables")
        return _rows([*rows, ("seen", int((count == 1).sum()), int((count == 2).sum()), None)])

    return run


def _tables(bucket: int, keys: np.ndarray, tables: np.ndarray, buckets: int, kind: str) -> list[tuple]:
    """Messages of how many tables each word has as a context, and serves as a dish."""
    words, at = np.unique(np.concatenate([keys >> 32, keys & 0xFFFFFFFF]), return_inverse=True)
    as_context, as_dish = (np.bincount(a, weights=tables, minlength=len(words)).astype(np.int64) for a in np.split(at, 2))
    return _by_word(kind, bucket, words, buckets, context=as_context, dish=as_dish)


def start_tables(count: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """About the expected number of tables of so many customers of one dish, for a start."""
    t, n = np.ones(len(count)), np.ones(len(count))
    while len(n) and (n < count).any():
        step = np.minimum(count, np.maximum(n + 1, np.floor(1.5 * n)))
        t, n = t + (step - n) * weight / (np.maximum((n + step) / 2 - discount * t, 1 - discount) + weight), step
    return np.clip(np.rint(t), 1, count).astype(np.int64)


def start_sizes(count: np.ndarray, tables: np.ndarray, discount: float = 0.5) -> np.ndarray:
    """Customers of each table, section after section: falling by the power that the discount gives, up to half of what is more than one each;
    the first table has the rest."""
    first = np.cumsum(tables) - tables
    nth = np.arange(tables.sum()) - np.repeat(first, tables)
    if not len(first):
        return nth
    usual = (np.repeat(tables, tables) / (np.maximum(nth, 1) * math.gamma(1 - discount))) ** (1 / discount)
    more = np.where(nth > 0, np.maximum(usual - 1, 0), 0)
    share = (count - tables) / 2 / np.maximum(np.add.reduceat(more, first), 1e-9)
    more = np.floor(more * np.repeat(np.minimum(share, 1), tables)).astype(np.int64)
    more[first] += count - tables - np.add.reduceat(more, first)
    return 1 + more


def _moves(x: np.ndarray, count: np.ndarray, weight: np.ndarray, discount: float, left: np.ndarray, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their tables) of ``x`` (a section a row, customers of its tables, 0: none) after ``left`` moves of each.

    Most moves seat a customer where it sat. How many of these come before one that changes something is drawn at once, and the
    change among the changes, so that the moves are all made and only the changes cost a step."""
    rows, c, w = np.arange(len(x)), count.astype(float), weight
    while len(rows):
        t = (x > 0).sum(axis=1)
        if (t == x.shape[1]).any():
            x = np.pad(x, ((0, 0), (0, max(2, x.shape[1] // 2))))
        alone = x == 1
        # What draws a customer elsewhere, of all that draws it: one that sat alone leaves no table, and a new one is where it sat.
        others = c - discount * (t - 1)
        from_alone = (others - 1) / (others - 1 + w)
        whole = np.maximum(others - 1 - discount + w, 1e-12)
        cum = np.where(alone, from_alone[:, None], x * ((others + w)[:, None] - x) / whole[:, None]).cumsum(axis=1)
        q = np.clip(cum[:, -1] / c, 1e-300, 1.0)
        with np.errstate(divide="ignore"):
            left = left - 1 - np.floor(np.log(1 - rng.random(len(x))) / np.log1p(-q))
        i = np.flatnonzero(left >= 0)
        if len(i):
            y, sums = x[i], cum[i]
            k, last = np.arange(len(i)), y.shape[1] - 1
            out = np.minimum((sums <= (rng.random(len(i)) * sums[:, -1])[:, None]).sum(axis=1), last)
            single = y[k, out] == 1
            pull = np.where(y > 0, y - discount, 0.0)
            pull[k, out] = 0.0
            sums = pull.cumsum(axis=1)
            new = np.where(single, 0.0, w[i])
            v = rng.random(len(i)) * (sums[:, -1] + new)
            opened = ~single & (v >= sums[:, -1])
            to = np.where(opened, (y == 0).argmax(axis=1), np.minimum((sums <= v[:, None]).sum(axis=1), last))
            x[i, out] -= 1
            x[i, to] += 1
        done = left < 0
        if done.all() or done.sum() * 8 >= len(x):
            yield rows[done], x[done]
            rows, x, c, w, left = (a[~done] for a in (rows, x, c, w, left))


def gibbs(count: np.ndarray, weight: np.ndarray, discount: float, tables: np.ndarray, sizes: np.ndarray, rng: np.random.Generator, sweeps: int | None = None):
    """(tables, sizes) after the moves of one step. ``weight``: of a new table, for each section; ``sizes``: customers of each table.

    A move takes a random customer of the section away and seats it again; a sweep has as many as the section has customers. Sections of like
    width are moved together. The plain way, which a step's ``draw_tables`` is compared with."""
    sweeps = SWEEPS if sweeps is None else sweeps
    first, out_tables = np.cumsum(tables) - tables, tables.copy()
    widths = np.ceil(np.log2(tables + 2)).astype(np.int64)
    by_width = np.lexsort((-count, widths))
    kept, lo, widths = [], 0, widths[by_width]
    while lo < len(by_width):
        hi = min(int(np.searchsorted(widths, widths[lo], "right")), lo + max(1, (1 << 19) >> int(widths[lo])))
        own, lo = by_width[lo:hi], hi
        x = np.zeros((len(own), int(tables[own].max()) + 2), dtype=np.int64)
        nth = np.arange(tables[own].sum()) - np.repeat(np.cumsum(tables[own]) - tables[own], tables[own])
        x[np.repeat(np.arange(len(own)), tables[own]), nth] = sizes[np.repeat(first[own], tables[own]) + nth]
        for rows, y in _moves(x, count[own], weight[own], discount, count[own] * float(sweeps), rng):
            taken = y > 0
            out_tables[own[rows]] = taken.sum(axis=1)
            kept.append((own[rows], y[taken]))
    start, out = np.cumsum(out_tables) - out_tables, np.empty(int(out_tables.sum()), dtype=np.int64)
    for own, flat in kept:
        t = out_tables[own]
        out[np.repeat(start[own], t) + np.arange(len(flat)) - np.repeat(np.cumsum(t) - t, t)] = flat
    return out_tables, out


def draw_tables(count: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each section, drawn from their law given the weight of a new table: what moves of single customers (``gibbs``) tend to.

    With S(c, t) the ways to seat c customers at t tables, each of its product of (customers before - discount), the law is S(c, t) *
    weight**t, which is rate**t / t! * b(t, c) for rate = weight / discount, and b(t, c) the probability that t independent tables have c
    customers together. A law falls ever faster beyond its peak, so it is cut where its weight is negligible; sections that aren't
    settled so are drawn again from a longer one in logarithms."""
    out, rate, log = np.ones(len(count), dtype=np.int64), weight / discount, False
    longest = np.minimum(count, np.ceil(rate + 12 * np.sqrt(rate) + 60)).astype(np.int64)
    left = np.flatnonzero(count > 1)
    while len(left):
        left, again = left[np.argsort(count[left], kind="stable")], []
        values, lo = np.unique(count[left], return_index=True)
        widths = np.maximum.accumulate(np.maximum.reduceat(longest[left], lo)[::-1])[::-1]  # a law serves sections of more customers too
        for c, own, law in zip(values.tolist(), np.split(left, lo[1:]), _laws(values.tolist(), widths.tolist(), discount, log)):
            t = np.arange(1, len(law) + 1)
            ways = law - np.log(t).cumsum()
            for part in np.array_split(own, -(-len(own) * len(law) // (1 << 19))):
                p = np.log(rate[part])[:, None] * t + ways
                p -= p.max(axis=1)[:, None]
                settled = (len(law) == c) | (p[:, -1] < -NEGLIGIBLE)
                cum = np.exp(p).cumsum(axis=1)
                out[part] = 1 + np.minimum((cum <= (rng.random(len(part)) * cum[:, -1])[:, None]).sum(axis=1), len(law) - 1)
                again.append(part[~settled])
        left, longest, log = np.concatenate(again), np.minimum(count, 4 * longest), True
    return out


def _laws(counts: list[int], widths: list[int], discount: float, log: bool) -> Iterator[np.ndarray]:
    """log b(t, c) for t from 1 to a width at most, or to where it leaves the range of doubles, for rising ``counts`` c and falling widths.
    With ``log`` the sums are of logarithms: slower, without that bound."""
    dt = discount * np.arange(1, widths[0] + 1)
    b, c = np.full(widths[0], -np.inf if log else 0.0), 1
    b[0] = math.log(discount) if log else discount
    for count, width in zip(counts, widths):
        if count > FAR and not log:
            yield _far(count, width, discount)
            continue
        b, dt = b[:width], dt[:width]
        while c < count:  # the next customer sits alone at a new table, or at one of those there are
            n = min(c + 1, width)
            if log:
                b[1:n] = np.logaddexp(b[: n - 1] + np.log(dt[1:n]), b[1:n] + np.log(np.maximum(c - dt[1:n], 1e-300)))
                b[0] += math.log(c - discount)
                b[:n] -= math.log(c + 1)
            else:
                alone = b[: n - 1] * dt[1:n]
                b[:n] *= c - dt[:n]
                b[1:n] += alone
                b[:n] /= c + 1
            c += 1
        known = b[: min(count, width)]
        if not log:
            lost = np.flatnonzero(known < 1e-290)
            known = np.log(known[: lost[0]] if len(lost) else known)
        yield known


def _far(count: int, width: int, discount: float) -> np.ndarray:
    """log b(t, count) for t from 1 as long as doubles hold it. The sum of t tables has the generating function (1 - (1-x)**discount)**t: expanded,
    the jth term has the coefficient of x**count in (1-x)**a, a = discount * j, which is gamma(count-a) / gamma(-a) / count!."""
    j = np.arange(1, min(width, 200) + 1)
    a, factorial = discount * j, np.r_[0.0, np.log(np.arange(1, width + 1)).cumsum()]
    fall = (count - a - 0.5) * np.log1p(-(a + 1) / (count + 1)) - (a + 1) * math.log(count + 1) + a + 1 + (1 / (count - a) - 1 / (count + 1)) / 12
    size = fall + np.array([math.lgamma(x + 1) for x in a]) - factorial[j] - math.log(math.pi)
    sign = np.where(j % 2 == 1, 1.0, -1.0) * np.sin(math.pi * a)
    b, good = np.empty(width), np.empty(width, dtype=bool)
    for lo in range(0, width, 2_000):
        t = np.arange(lo + 1, min(lo + 2_000, width) + 1)
        rest = t[:, None] - j
        with np.errstate(over="ignore", invalid="ignore"):
            terms = np.exp(np.where(rest >= 0, size + factorial[t][:, None] - factorial[np.maximum(rest, 0)], -np.inf))
            value = (terms * sign).sum(axis=1)
        b[t - 1], good[t - 1] = value, (value > 1e-6 * terms.max(axis=1)) & (terms[:, -1] * (rest[:, -1] > 0) < 1e-9 * value)
    return np.log(b[: width if good.all() else int(np.argmin(good))])


@dataclass(frozen=True)
class Root:
    """The parent restaurant as a whole: known words, customers, tables, discount."""

    words: int
    customers: int
    tables: int
    discount: float
    strength: float = STRENGTH

    def probability(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        rest = (self.strength + self.discount * self.tables) / (self.words + 1)
        return (customers - self.discount * tables + rest) / (self.strength + self.customers)


def _seat_words(buckets: int, sizes: dict[int, int], new_table: float, discount: float, seed: int):
    def run(key, table):
        """Sums of the tables of all buckets of pairs, the seating of the parent's customers, and answers to those that sent."""
        bucket = key[0].as_py()
        n = sizes.get(bucket, 0) + 1
        context, dish, asks = np.zeros(n, np.int64), np.zeros(n, np.int64), []
        for kind, sender, payload in _received(table):
            m = unpack(payload)
            at = np.cumsum(m["slot"])
            np.add.at(context, at, m["context"]), np.add.at(dish, at, m["dish"])
            if kind == "tables":
                asks.append((sender, at))
        served = np.flatnonzero(dish)
        tables = np.zeros(n, np.int64)
        tables[served] = draw_tables(dish[served], np.full(len(served), new_table), discount, np.random.default_rng([seed, bucket]))
        rows = [("parent", s, bucket, pack(slot=np.diff(at, prepend=0), context=context[at], dish=dish[at], tables=tables[at])) for s, at in asks]
        own = pack(context=context, dish=dish, tables=tables)
        seen = pack(sums=np.array([dish.sum(), tables.sum(), (dish == 1).sum(), (dish == 2).sum()]))
        return _rows([*rows, ("own", bucket, seed, own), ("sums", bucket, seed, seen)])

    return run


def _seat_pairs(buckets: int, root: Root, discount: float, seed: int, sample: bool):
    def run(key, table):
        """The sections' seating, given the parent's probabilities and the restaurants' tables of the step before."""
        bucket, state, ids, held = key[0].as_py(), None, [], []
        for kind, sender, payload in _received(table):
            m = unpack(payload)
            if kind == "state":
                state = m
            else:
                slot = np.cumsum(m["slot"])
                ids.append(np.where((sender == 0) & (slot == 0), END, (slot - 1) * buckets + sender + 1))
                held.append(m)
        keys, c = np.cumsum(state["keys"]), state["count"]
        if not len(keys):
            return _rows([("state", bucket, 0, pack(**state))])
        ids = np.concatenate(ids)
        order = np.argsort(ids)
        context, dish, tables = (np.concatenate([m[f] for m in held])[order] for f in ("context", "dish", "tables"))
        find = lambda words: np.searchsorted(ids[order], words)
        w = find(keys & 0xFFFFFFFF)
        weight = (STRENGTH + discount * context[find(keys >> 32)]) * root.probability(dish[w], tables[w])
        t = draw_tables(c, weight, discount, np.random.default_rng([seed, bucket]))
        total = state["sum"] + t if sample else state["sum"]
        rows = _tables(bucket, keys, t, buckets, "tables")
        return _rows([*rows, ("state", bucket, 0, pack(keys=state["keys"], count=c, sum=total))])

    return run


def _answer_pairs(key, table):
    """To each block, of its pairs in this bucket: how often learned, and tables summed over the samples (of pairs seen once: 0)."""
    bucket, got = key[0].as_py(), list(_received(table))
    state = next(unpack(p) for k, _, p in got if k == "state")
    count, tables = np.r_[0, 1, state["count"]], np.r_[0, 0, state["sum"]]
    return _rows([("pairs", s, bucket, pack(count=count[c], tables=tables[c])) for k, s, p in got if k == "codes" for c in [unpack(p)["code"]]])


def _answer_words(buckets: int):
    def run(key, table):
        """To each block, of its words in this bucket: id, count, and context tables, customers and tables as a dish in every sample."""
        bucket, got = key[0].as_py(), list(_received(table))
        own = [unpack(p) for k, _, p in got if k == "own"]
        rows = [("end", -1, bucket, pack(**{f"{f}{i}": o[f][:1] for i, o in enumerate(own) for f in o}))] if bucket == 0 else []
        for k, block, p in got:
            if k == "ids":
                m = unpack(p)
                at = np.where(m["id"] > 0, _slot(m["id"], buckets), 0)
                values = {f"{f}{i}": np.where(m["id"] > 0, o[f][at], 0) for i, o in enumerate(own) for f in o}
                rows.append(("words", block, bucket, pack(**m, **values)))
        return _rows(rows)

    return run


def _score(buckets: int, roots: list[Root], end: dict[str, int], discount: float, total: int, train_docs: int):
    base_of = lambda c: np.log10((c + 0.1) / (total + 0.1 * (roots[0].words + 1)))

    def run(key, blocks, replies):
        d, got = unpack(blocks.column("docs")[0].as_py()), [(k, s, unpack(p)) for k, s, p in _received(replies)]
        tokens, words = d["tokens"], [m for k, _, m in got if k == "words"]
        n = int(tokens.max(initial=0)) + 1
        ids, count = _block_ids(words, n, "id"), _block_ids(words, n, "count")
        count[END] = train_docs
        before = np.r_[END, tokens[:-1]]
        keys, order, cuts, of_token = _pairs(tokens, ids, buckets)
        pair_count, pair_tables = np.zeros(len(keys) + 1), np.zeros(len(keys) + 1)  # the last: no pair
        for k, s, m in got:
            if k == "pairs":
                own = order[cuts[s] : cuts[s + 1]]
                pair_count[own] = m["count"]
                pair_tables[own] = np.where(m["count"] == 1, 1.0, m["tables"] / len(roots))
        here = np.where(of_token >= 0, of_token, len(keys))
        p = pair_count[here] - discount * pair_tables[here]
        for i, root in enumerate(roots):
            context, dish, tables = (_block_ids(words, n, f"{f}{i}") for f in ("context", "dish", "tables"))
            context[END], dish[END], tables[END] = (end[f"{f}{i}"] for f in ("context", "dish", "tables"))
            p += (STRENGTH + discount * context[before]) * root.probability(dish, tables)[tokens] / len(roots)
        logs = np.log10(p / (STRENGTH + count[before]))
        first = np.cumsum(d["n"] + 1) - d["n"] - 1
        sums = [np.add.reduceat(x[tokens], first) for x in ((count > 0).astype(np.int64), base_of(count))]
        columns = [
            pa.array(d["doc_id"], mask=d["missing"]), pa.array(d["held"]), pa.array(d["n"] + 1), pa.array(sums[0]),
            pa.array(np.full(len(first), total)), pa.array(sums[1]), pa.array(np.add.reduceat(logs, first)),
        ]
        return pa.Table.from_arrays(columns, names=[f.split()[0] for f in SCORES.split(", ")])

    return run


def held_out():
    """Documents that are only scored. A row without an id is learned from."""
    return F.coalesce(F.pmod(crc32_of_id(), F.lit(10)) == 0, F.lit(False))


def score_documents(docs: DataFrame, steps: int = STEPS, burn_in: int = BURN_IN) -> DataFrame:
    """SCORES: a row for each document of ``docs``. A null text is empty: its end alone. Rows that repeat an id or a text are documents
    each; without a text to learn from every token has probability 1; an empty table gives no rows. Of further columns nothing is used."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"))
    blocks = save(own.mapInArrow(_blocks, "block long, n_tokens long, docs binary, words binary"), "lm_blocks")
    tokens, n_blocks = blocks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    if not tokens:
        return save(spark.createDataFrame([], SCORES), "lm_scores")
    buckets = max(spark.sparkContext.defaultParallelism, math.ceil(tokens / BUCKET_TOKENS))

    def by(frame: DataFrame, key: str = "to", parts: int = buckets):
        return frame.repartition(min(parts, 100_000), key).groupBy(key)

    def kind(frame: DataFrame, *names: str) -> DataFrame:
        return frame.where(F.col("kind").isin(*names))

    numbered = save(by(blocks.mapInArrow(_ask_words(buckets), _ROW)).applyInArrow(_number_words(buckets), _ROW), "lm_words")
    counted = {r.to: r for r in kind(numbered, "counts").select("to", "sender").collect()}  # a row for each bucket
    sizes = {b: r.sender for b, r in counted.items()}
    keyed = blocks.select("block", "docs")
    to_blocks = lambda frame: frame.select(F.col("to").alias("block"), "kind", "sender", "payload")
    at_blocks = lambda frame: keyed.groupBy("block").cogroup(to_blocks(frame).groupBy("block"))
    pairs = save(by(at_blocks(kind(numbered, "ids")).applyInArrow(_ask_pairs(buckets), _ROW)).applyInArrow(_count_pairs(buckets), _ROW), "lm_pairs")
    train_docs, total = _training_counts(own, kind(numbered, "counts"))
    words = sum(sizes.values()) + bool(train_docs)
    once, twice = kind(pairs, "seen").agg(F.coalesce(F.sum("to"), F.lit(0)), F.coalesce(F.sum("sender"), F.lit(0))).first()
    discount = _discount(once, twice)

    def seat_words(tables: DataFrame, step: int, root: Root) -> tuple[DataFrame, Root]:
        new_table = (root.strength + root.discount * root.tables) / (root.words + 1)
        parents = save(by(kind(pairs, "once").unionByName(tables)).applyInArrow(_seat_words(buckets, sizes, new_table, root.discount, step), _ROW), "lm_parents")
        sums = np.sum([unpack(bytes(r.payload))["sums"] for r in kind(parents, "sums").select("payload").collect()] or [[0] * 4], axis=0)  # a row for each bucket
        return parents, Root(words, int(sums[0]), int(sums[1]), root.discount if step else _discount(int(sums[2]), int(sums[3])))

    state, tables = kind(pairs, "state"), kind(pairs, "tables")
    parents, root = seat_words(tables, 0, Root(words, 0, words, 0.5))
    samples, roots = [], []
    for step in range(1, steps + 1):
        sample = step > burn_in
        seated = save(by(state.unionByName(kind(parents, "parent"))).applyInArrow(_seat_pairs(buckets, root, discount, step, sample), _ROW), "lm_state")
        state, tables = kind(seated, "state"), kind(seated, "tables")
        parents, root = seat_words(tables, step, root)
        if sample:
            samples.append(kind(parents, "own"))
            roots.append(root)
    asked = kind(numbered, "ids").select("kind", F.col("sender").alias("to"), F.col("to").alias("sender"), "payload")
    for own_rows in samples:
        asked = asked.unionByName(own_rows)
    answers = save(by(asked).applyInArrow(_answer_words(buckets), _ROW), "lm_answers")
    end = next((unpack(bytes(r.payload)) for r in kind(answers, "end").select("payload").collect()), None)  # one row
    end = {k: int(v[0]) for k, v in end.items()} if end else {f"{f}{i}": 0 for i in range(len(roots)) for f in ("context", "dish", "tables")}
    found = by(kind(pairs, "codes").unionByName(state)).applyInArrow(_answer_pairs, _ROW)
    return at_blocks(kind(answers, "words").unionByName(found)).applyInArrow(_score(buckets, roots, end, discount, total, train_docs), SCORES)


def _training_counts(docs: DataFrame, counts: DataFrame) -> tuple[int, int]:
    """Documents to learn from, and their tokens with the ends."""
    learned = docs.where(~F.col("held")).count()
    sums = counts.select("payload").mapInArrow(_count_sums, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return learned, learned + sums


def _count_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([int(unpack(p)["count"].sum()) for p in batch.column("payload").to_pylist()], pa.int64())], names=["n"])


def _discount(once: int, twice: int) -> float:
    """From how many were seen once and twice."""
    return min(max(once / (once + 2 * twice), 0.05), 0.95) if once and twice else 0.5


def perplexity(scores: DataFrame) -> DataFrame:
    """Perplexity of the model and of single words, for held-out and other documents."""
    per = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scores.groupBy("held_out").agg(F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), per("score").alias("perplexity"), per("base_score").alias("base_perplexity"))


def op11_lm_scoring(spark, docs: DataFrame) -> DataFrame:
    """The model's log10 probability of each document; edge rows as ``score_documents`` states."""
    return score_documents(docs)

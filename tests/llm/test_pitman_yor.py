"""The language model: counts by brute force, the sampler against exact enumeration, scores against a plain sequential sampler."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from emberline.llm import pitman_yor as lm
from emberline.llm.session import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def tokens(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) + [None]


def is_held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 10 == 0


def base(rows):
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score."""
    count = Counter(w for d, t in rows if not is_held(d) for w in tokens(t))
    n, v = sum(count.values()), len(count)
    out = []
    for d, t in rows:
        own = tokens(t)
        out.append((d, is_held(d), len(own), sum(count[w] > 0 for w in own), n, sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own)))
    return out


def result(spark, rows, schema="doc_id long, text string"):
    return list(map(tuple, lm.op11_lm_scoring(spark, spark.createDataFrame(rows, schema)).collect()))


def same(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=1e-12, abs=1e-9)


def plain(rows, sweeps=6, seed=1):
    """Scores by a sampler that seats one customer after the other, on the same two levels."""
    rng, seats = random.Random(seed), [defaultdict(list), defaultdict(list)]  # (context, word) -> customers of each table
    n, t = [Counter(), Counter()], [Counter(), Counter()]
    train = [(a, b) for d, x in rows if not is_held(d) for a, b in zip([None, *tokens(x)], tokens(x))]
    words = len({b for _, b in train})
    seen = [Counter(Counter(b for _, b in set(train)).values()), Counter(Counter(train).values())]
    d = [min(max(s[1] / (s[1] + 2 * s[2]), 0.05), 0.95) for s in seen]

    def p(level, u, w):
        if level < 0:
            return 1 / (words + 1)
        k, u = seats[level].get((u, w), []), u
        return (sum(k) - d[level] * len(k) + (1 + d[level] * t[level][u]) * p(level - 1, 0, w)) / (1 + n[level][u])

    def sit(level, u, w):
        k = seats[level][u, w]
        new = (1 + d[level] * t[level][u]) * p(level - 1, 0, w)
        v = rng.random() * (sum(k) - d[level] * len(k) + new)
        n[level][u] += 1
        for i, c in enumerate(k):
            v -= c - d[level]
            if v < 0:
                k[i] += 1
                return
        k.append(1)
        t[level][u] += 1
        if level:
            sit(0, 0, w)

    def leave(level, u, w):
        k = seats[level][u, w]
        i = rng.choices(range(len(k)), k)[0]
        k[i] -= 1
        n[level][u] -= 1
        if not k[i]:
            del k[i]
            t[level][u] -= 1
            if level:
                leave(0, 0, w)

    held = [(d_, list(zip([None, *tokens(x)], tokens(x)))) for d_, x in rows if is_held(d_)]
    total, samples = [np.zeros(len(x)) for _, x in held], 0
    for sweep in range(sweeps):
        for u, w in train:
            if sweep:
                leave(1, u, w)
            sit(1, u, w)
        if sweep >= 3:
            samples += 1
            for sums, (_, x) in zip(total, held):
                sums += [p(1, u, w) for u, w in x]
    return sum(np.log10(s / samples).sum() for s in total)


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()]
    got = result(spark, rows)
    same(got, base(rows))
    held = [r for r in got if r[1]]
    score, of_words = sum(r[6] for r in held), sum(r[5] for r in held)
    assert score > 0.9 * of_words  # probabilities of a much smaller perplexity
    assert score == pytest.approx(plain(rows), rel=0.01)


def test_many_blocks_and_buckets_give_the_same_counts(spark, monkeypatch):
    rng = random.Random(2)
    vocabulary = ["a", "A", "the", "Übung", "übung", "x y", "z ", "\u0000", "12", "é"] + [f"w{i}" for i in range(60)]
    rows = [(i, " \t\n\r\x0b\x0c"[i % 6].join(rng.choices(vocabulary, k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(None, "the null id"), (None, None), (7, None), (10, ""), (11, "  "), (9, "new words " * 9_000)] + [(3, "hot text of all")] * 300
    one = result(spark, rows)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    monkeypatch.setattr(lm, "PART_BYTES", 100)
    monkeypatch.setattr(lm, "BUCKET_TOKENS", 900)
    many = result(spark, [(*r, "x", True, b"1") for r in rows], "doc_id long, text string, block string, held boolean, words binary")
    same(one, base(rows))
    same(many, base(rows))
    assert sum(r[6] for r in many) == pytest.approx(sum(r[6] for r in one), rel=0.01)


def test_edge_tables(spark):
    assert result(spark, []) == []
    held = next(i for i in range(99) if is_held(i))
    assert result(spark, [(held, "only held out"), (held, None)]) == [(held, True, 4, 0, 0, 0.0, 0.0), (held, True, 1, 0, 0, 0.0, 0.0)]
    (one,) = result(spark, [(None, None)])
    assert one[:5] == (None, False, 1, 1, 1) and -1 < one[6] < 0


@pytest.mark.parametrize("count, weight, discount", [(2, 0.3, 0.5), (3, 1.2, 0.8), (5, 0.05, 0.2), (6, 4.0, 0.9)])
def test_sampler_reaches_the_exact_distribution(count, weight, discount):
    def partitions(items):
        if not items:
            yield []
            return
        for rest in partitions(items[1:]):
            yield [1, *rest]
            for i in range(len(rest)):
                yield [*rest[:i], rest[i] + 1, *rest[i + 1 :]]

    exact = Counter()
    for sizes in partitions(list(range(count))):
        exact[len(sizes)] += weight ** len(sizes) * math.prod(i - discount for k in sizes for i in range(1, k))
    n = 20_000
    c, w = np.full(n, count), np.full(n, weight)
    t = lm.start_tables(c, w, discount)
    t, sizes = lm.gibbs(c, w, discount, t, lm.start_sizes(c, t), np.random.default_rng(1), sweeps=20)
    assert sizes.sum() == n * count and (sizes > 0).all() and len(sizes) == t.sum()
    for k, p in exact.items():
        p /= sum(exact.values())
        assert abs((t == k).mean() - p) < 4 * math.sqrt(p * (1 - p) / n) + 0.005


def test_sampler_over_sections_of_all_widths():
    rng = np.random.default_rng(4)
    c = np.r_[np.full(500, 2), rng.integers(2, 40, 300), rng.integers(40, 5_000, 20), 1_000_000]
    w = rng.uniform(0.001, 3, len(c))
    t = lm.start_tables(c, w, 0.6)
    before = lm.start_sizes(c, t)
    after, sizes = lm.gibbs(c, w, 0.6, t, before, rng)
    for tables, flat in ((t, before), (after, sizes)):
        assert (np.add.reduceat(flat, np.cumsum(tables) - tables) == c).all() and (flat > 0).all()
    empty = np.empty(0, dtype=np.int64)
    assert [len(x) for x in lm.gibbs(empty, empty.astype(float), 0.6, empty, empty, rng)] == [0, 0]


def test_wide_sections_make_all_their_moves():
    """Tables after whole sweeps, as with one plain move after the other, from a start far off."""
    n, count, weight, discount, sweeps = 400, 60, 1.5, 0.6, 3
    rng, plain = random.Random(1), []
    start = lm.start_sizes(np.array([count]), np.array([30]))
    for _ in range(n):
        x = [int(s) for s in start]
        for _ in range(count * sweeps):
            x[rng.choices(range(len(x)), x)[0]] -= 1
            x = [s for s in x if s] + [0]
            x[rng.choices(range(len(x)), [s - discount for s in x[:-1]] + [weight])[0]] += 1
            x = [s for s in x if s]
        plain.append((len(x), max(x)))
    c, t = np.full(n, count), np.full(n, 30)
    t, sizes = lm.gibbs(c, np.full(n, weight), discount, t, np.tile(start, n), np.random.default_rng(2), sweeps=sweeps)
    largest = np.maximum.reduceat(sizes, np.cumsum(t) - t)
    for got, want in zip((t, largest), np.array(plain).T):
        assert abs(got.mean() - want.mean()) < 4 * math.sqrt((got.var() + want.var()) / n)


@pytest.mark.parametrize("count, weight, discount", [(2, 0.3, 0.5), (3, 1.2, 0.8), (6, 4.0, 0.9), (60, 1.5, 0.6), (400, 30.0, 0.7)])
def test_drawn_tables_are_those_of_the_exact_law(count, weight, discount):
    ways = [0.0, 1.0]  # of n customers at t tables, over their sum
    for n in range(1, count):
        ways = [(ways[t] * (n - discount * t) if t <= n else 0.0) + (ways[t - 1] * weight if t else 0.0) for t in range(n + 2)]
        total = sum(ways)
        ways = [x / total for x in ways]
    law, n = np.array(ways) / sum(ways), 20_000
    t = lm.draw_tables(np.full(n, count), np.full(n, weight), discount, np.random.default_rng(3))
    got = np.bincount(t, minlength=count + 1) / n
    assert (abs(got.cumsum() - law.cumsum()) < 4 * np.sqrt(0.25 / n)).all()
    assert (got[law < 1e-12] == 0).all()


def test_wide_sections_are_drawn_in_few_steps(monkeypatch):
    """Sections of a million customers: their law comes from the series, the same as from all smaller ones, and no move is made."""
    for discount in (0.3, 0.73, 0.9):
        monkeypatch.setattr(lm, "FAR", 1 << 40)
        rows = next(lm._laws([20_000], [200], discount, False))
        logs = next(lm._laws([20_000], [200], discount, True))
        far = lm._far(20_000, 200, discount)
        assert len(logs) == len(rows) == 200 and len(far) > 40
        assert logs == pytest.approx(rows, abs=1e-9) and far == pytest.approx(rows[: len(far)], abs=1e-6)
    monkeypatch.undo()
    monkeypatch.setattr(lm, "_moves", None)
    c, w = np.r_[np.full(300, 1_000_000), np.arange(1, 50), 15_000, 40_000], np.r_[np.full(300, 100.0), np.full(49, 0.01), 90.0, 0.001]
    t = lm.draw_tables(c, w, 0.73, np.random.default_rng(5))
    assert (1 <= t).all() and (t <= c).all() and t[300] == 1
    # b(t, c) is near t * c**(-1-d) there, so t - 1 is near a Poisson number of mean w / d
    assert abs(t[:300].mean() - 1 - 100 / 0.73) < 5
    assert len(lm.draw_tables(c[:0], w[:0], 0.73, np.random.default_rng(5))) == 0


def test_laws_beyond_doubles_are_drawn_from_logarithms():
    """As many tables as a law in doubles doesn't reach: all customers but a few sit alone."""
    t = lm.draw_tables(np.full(50, 3_000), np.full(50, 1e7), 0.2, np.random.default_rng(6))
    assert (t > 2_990).all() and (t <= 3_000).all()


def test_packing():
    arrays = {"a": np.array([-1, 300]), "b": np.empty(0, np.int64), "c": np.array([1.5, -2.0]), "d": np.array([True, False]), "e": np.array([2**40, 0])}
    got = lm.unpack(lm.pack(**arrays))
    assert all((got[k] == v).all() and len(got[k]) == len(v) for k, v in arrays.items())

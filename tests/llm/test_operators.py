"""Brute force, round trips and edge rows for the training-data operators."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emberline.llm import decontaminate, langid, licenses, ngram_join, packing, pii, quality, sharding, substring_dedup, suffixes, topk
from emberline.llm.session import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long"
ODD = [
    (1, None, None, None, None, 0), (2, "", "en", "s", 0, 0), (3, "a", "en", "s", 1, 0), (4, "...!!! 123", None, "s", 9, 0),
    (5, "the same words over and over again " * 400, "en", "s", 9, 1), (6, "the same words over and over again " * 400, "en", "s", 9, 1),
    (6, "the same words over and over again " * 400, "en", "s", 9, 1), (None, "no id here at all, none", "en", None, 3, 2),
    (7, "x" * 30_000, "xx", "s", 3, 2), (8, "mail me@x.yz or +1 555 555 5555 at 1.2.3.4.5 and 4111 1111 1111 1111", "en", "s", 3, 2),
    (9, "Released under the MIT License. GNU General Public License, cc by", "en", "s", 3, 2),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_sharding(spark, odd, none):
    out = sharding.op1_sharding(spark, table(spark, SF, "documents")).toPandas()
    for _, g in out.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    m = sharding.first_map(40)
    grown = sharding.rebalance(m, {s: 1 for s in range(sharding.SLOTS)}, 41)
    moved = [s for s in range(sharding.SLOTS) if m.shard_of[s] != grown.shard_of[s]]
    load = np.bincount(grown.shard_of, minlength=41)
    assert grown.version == 2 and load.max() - load.min() <= 1 and len(moved) <= sharding.SLOTS // 41 + 41
    assert sharding.op1_sharding(spark, odd).count() == len(ODD)
    assert sharding.op1_sharding(spark, none).count() == 0


def test_language(spark, odd, none):
    docs = table(spark, SF, "documents")
    out = langid.op2_language_id(spark, docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    test = out[out.held_out]
    assert (test.lang == test.lang_pred).mean() > 0.9
    got = {r.doc_id: r.lang_pred for r in langid.op2_language_id(spark, odd).collect()}
    assert got[1] == got[2] == got[4] == "und" and got[3] != "und"
    assert langid.op2_language_id(spark, none).count() == 0


def test_every_language_is_learned_from_different_texts(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    words = {f"l{i:03}": [word() for _ in range(12)] for i in range(130)}
    rows = [(lang, " ".join(rng.sample(w, 12))) for lang, w in words.items() for _ in range(2 if lang < "l125" else 1)]
    copied = [word() for _ in range(30)]
    rows += [("copies", copied[0])] * 3000 + [("copies", w) for w in copied] + [("long", "abc " * 6000 + "lastword")]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    assert set(model.content) == {*words, "copies", "long"}
    assert [x[0] for x in model.classify([" ".join(w[::-1]) for w in words.values()])] == list(words)
    assert all(w.encode() in model.content["copies"] for w in copied) and b"lastword" in model.content["long"]


def test_quality(spark, odd, none):
    labels = table(spark, SF, "labels")
    out = quality.op3_quality(spark, table(spark, SF, "documents"), labels).join(labels, "doc_id").toPandas()
    test = out[out.held_out]
    assert (test.predicted == test.quality).mean() > 0.8
    assert quality.op3_quality(spark, odd, labels.limit(0)).count() == len(ODD)
    assert quality.op3_quality(spark, none, labels).count() == 0


def test_myers_and_matches(spark, odd, none):
    rng = random.Random(3)
    for _ in range(200):
        p, t = ("".join(rng.choice("abc") for _ in range(rng.randint(1, n))) for n in (18, 40))
        row = [0] * (len(t) + 1)
        for i, a in enumerate(p, 1):
            new = [i]
            for j, b in enumerate(t, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
            row = new
        got = decontaminate.myers(p, t, 99)
        assert got[0] == min(row[1:])
    item = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    near = item.replace("seven", "sevem")
    docs = spark.createDataFrame([(1, "x y " + item.upper() + "!"), (2, "zz " + near + " qq"), (3, "one two three"), (4, None)], "doc_id long, text string")
    assert {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(docs, bench).collect()} == {(1, 1, 0), (2, 1, 1)}
    assert decontaminate.contaminated(none, bench).count() == 0 and decontaminate.contaminated(odd, bench.limit(0)).count() == 0


def test_licenses(spark, odd, none):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for docs in (odd, table(spark, SF, "documents").select("doc_id", "text")):
        got = {(r.n_words, r.n_base, r.base_labels, r.first_word) for r in licenses.op5_license_scan(spark, docs).collect()}
        want = set()
        for r in docs.collect():
            w, places, names = re.findall(licenses.WORD, (r.text or "").translate(low)), [], set()
            for phrase, label in licenses.PHRASES:
                at = [i for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
                places += at
                names |= {label} if at else set()
            want.add((len(w), len(places), ",".join(sorted(names)), min(places, default=None)))
        assert got == want
    assert licenses.op5_license_scan(spark, none).count() == 0


def test_ball_tree():
    rng = np.random.default_rng(1)
    x = rng.integers(-50, 50, (3000, 16)).astype(float)
    ids = np.arange(3000)
    tree = topk.BallTree(ids, x)
    for q in range(0, 3000, 500):
        s = x @ x[q]
        want = sorted(((int(-s[i]), int(i)) for i in ids if i != q))[:5]
        assert sorted((-a, b) for a, b in tree.search(q, x[q], 5, -np.inf)) == want


def test_jaccard(spark, odd, none):
    base = [f"w{i}" for i in range(100)]
    near, far = list(base), list(base)
    near[50] = "changed"
    far[10] = far[40] = far[70] = far[90] = "other"
    docs = spark.createDataFrame(
        [(1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (4, " ".join(far)), (5, None), (6, ""), (7, "just this")], "doc_id long, text string"
    )
    got = {r.doc_id: (r.class_id, r.n_links, r.n_text_links) for r in ngram_join.jaccard_join(docs).collect()}
    assert got == {1: (1, 2, 1), 2: (1, 2, 1), 3: (1, 2, 1), 4: (4, 0, 0), 5: (5, 1, 0), 6: (5, 1, 0), 7: (7, 0, 0)}
    assert ngram_join.jaccard_join(odd).count() == len(ODD) and ngram_join.jaccard_join(none).count() == 0


def test_deep_shallow_sort():
    rng = random.Random(5)
    for _ in range(500):
        s = [bytes(rng.choice(b"ab") for _ in range(rng.randint(0, 12))) for _ in range(rng.randint(1, 30))]
        order = suffixes.deep_shallow_sort(s, rng.choice([0, 1, 4]))
        assert [s[i] for i, _ in order] == sorted(s)
        assert all(n == suffixes.common_prefix(s[a], s[b]) for (a, _), (b, n) in zip(order, order[1:]))


def brute_removed(rows):
    seen, out = set(), {}
    for d, t in sorted(rows):
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - 99):
            if raw[i : i + 100] in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(raw[i : i + 100])
        out[d] = (sum(gone), hashlib.sha256(bytes(c for c, g in zip(raw, gone) if not g)).hexdigest())
    return out


def test_substrings(spark, odd, none):
    rng = random.Random(7)
    words = [f"{rng.randint(0, 10**6):x}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(30) for _ in range(4)]
    rows = [(i, text(rng.randint(0, 30)) + rng.choice(shared)[rng.randint(0, 60) :] + text(rng.randint(0, 30))) for i in range(120)]
    rows += [(200, "ab" * 300), (201, "é" * 200), (202, None), (203, rows[3][1])]
    got = {r.doc_id: (r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_removed(rows)
    assert substring_dedup.dedup_substrings(odd).count() == len(ODD) and substring_dedup.dedup_substrings(none).count() == 0


def test_substrings_of_repeated_rows_and_ids(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"{rng.randint(0, 10**6):x}" for _ in range(400)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = text(40)
    inside = lambda: text(20) + passage + text(20)
    rows = [(1, inside())] * 3 + [(2, inside()), (2, inside()), (3, inside()), (3, text(40))]
    rows += [(None, inside()), (None, text(50)), (None, text(20) + rows[0][1][:300])] + [(None, inside())] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    order = sorted({((r.has_id, r.doc_id, r.digest), r.text) for r in substring_dedup.keyed(docs).collect()})
    of_text = {t: key for key, t in order}
    want = brute_removed(order)
    want = sorted((d if d is not None else -1, *want[of_text[t]]) for d, t in rows)
    for group in (substring_dedup.GROUP, 1):
        monkeypatch.setattr(substring_dedup, "GROUP", group)
        got = [(-1 if r.doc_id is None else r.doc_id, r.n_removed, r.kept_sha256) for r in substring_dedup.dedup_substrings(docs).collect()]
        assert sorted(got) == want


def test_packing(spark, odd, none):
    from tokenizers import Tokenizer

    docs = table(spark, SF, "documents")
    out = packing.op9_packing(spark, docs).toPandas()
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert list(g.offset) == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= packing.CAPACITY
    own = Tokenizer.from_file(packing.default_tokenizer())
    for r in docs.limit(40).collect():
        ids = np.array([*own.encode(r.text, add_special_tokens=False).ids, packing.END_ID], dtype="<u4")
        for p in out[out.doc_id == r.doc_id].itertuples():
            assert zlib.crc32(ids[p.start : p.start + p.length].tobytes()) == p.ids_crc32
    assert packing.op9_packing(spark, none).count() == 0 and packing.op9_packing(spark, odd).count() >= len(ODD)


def test_best_fit_equals_piece_by_piece():
    rng = random.Random(2)
    for _ in range(60):
        histogram = {rng.randint(1, 50): rng.randint(1, 9) for _ in range(8)}
        room = []
        for n in sorted((n for n, k in histogram.items() for _ in range(k)), reverse=True):
            fits = [r for r in room if r >= n]
            if fits:
                room[room.index(min(fits))] -= n
            else:
                room.append(50 - n)
        ranges = packing.best_fit_decreasing(histogram, 50)
        assert len({s + (i // per) for _, lo, hi, s, per, _ in ranges for i in range(hi - lo)}) == len(room)
        assert sum(hi - lo for _, lo, hi, *_ in ranges) == sum(histogram.values())


def test_pii(spark, odd, none):
    got = {r.doc_id: r for r in pii.op10_pii(spark, odd).collect()}
    assert got[8].spans == "email:5:12,phone:16:31,ip:35:42,card:49:68"
    assert got[8].base_sha256 == hashlib.sha256(got[8].spans.encode()).hexdigest() and got[1].spans == ""
    masked = {r.doc_id: r.text for r in pii.mask(odd).collect()}
    assert masked[8] == "mail [EMAIL] or [PHONE] at [IP].5 and [CARD]" and masked[1] is None
    assert pii.op10_pii(spark, none).count() == 0


def test_the_stored_map_is_edited(spark, tmp_path):
    path = f"file://{tmp_path}/slot_map"
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    first, maps = sharding.shard_documents(docs, 4, 256, path)
    assert [m.version for m in maps] == [1, 2] and sharding.stored_map(spark, path) == maps[-1]
    before = {r.doc_id: r.shard for r in first.collect()}
    again, edits = sharding.shard_documents(docs, 4, 64, path)  # the stored number of slots holds
    assert edits[0] == maps[-1] and sum(r.shard != before[r.doc_id] for r in again.collect()) <= 0.03 * 4000
    before = {r.doc_id: r.shard for r in again.collect()}
    grown, maps = sharding.shard_documents(docs, 5, 256, path)
    assert [m.version for m in maps] == [edits[-1].version, edits[-1].version + 1] and sharding.stored_map(spark, path) == maps[-1]
    bytes_of, moved = [0] * 5, 0
    for r in grown.collect():
        bytes_of[r.shard] += r.size
        moved += r.shard != before[r.doc_id]
    assert max(bytes_of) <= 1.02 * min(bytes_of) and moved <= 0.3 * 4000


def test_copies_without_an_id_are_packed_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "BUCKETS", 2), monkeypatch.setattr(packing, "BUCKET_ROWS", 50)
    docs = spark.range(700).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 7 > 0, "a few words of it").alias("text"))
    sequences = {}
    for r in packing.op9_packing(spark, docs).collect():
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(map(len, sequences.values())) == 700
    used = []
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        used.append(end)
    assert max(used) <= 1024 and len(used) == -(-sum(used) // 1024)

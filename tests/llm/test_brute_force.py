"""Operators that SQL cannot express, against plain brute force over whole tables."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest

from emberline.llm import decontaminate, langid, licenses, packing, pii, sharding
from emberline.llm.session import table

SF = "/root/testdata/sf0.001"

# The contract's patterns, as Python writes them.
BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(digits[::-1])) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    return sorted((m.start(), n, m.end(), k) for n, (k, p) in enumerate(BASE.items()) for m in re.finditer(p, text) if passes(k, m.group()))


def listed(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)


def test_base_spans(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    rng = random.Random(5)
    rows += [(10_000 + i, "".join(rng.choice("1234567890.+-@ ()a\u00e9\n") for _ in range(rng.randint(0, 90)))) for i in range(2000)]
    rows += [(20_000, None), (20_000, "1.2.3.4"), (None, "4111 1111 1111 1111"), (20_001, "4111111111111111" * 3), (20_002, "a@b.c@d.e f@g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.op10_pii(spark, docs).collect())
    want = []
    for d, text in rows:
        spans = base_spans(text or "")
        n = Counter(k for *_, k in spans)
        want.append((str(d), n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(listed(spans).encode()).hexdigest()))
    assert got == sorted(want)


def found(spark, rows):
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    return {r.doc_id: r.spans for r in pii.op10_pii(spark, docs).collect()}


def test_contexts_reveal_unseen_identifiers(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 7)))
    prose = lambda n: " ".join(rng.choice(["the", "of", "and", word()]) for _ in range(n))
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    letters = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    known = {
        "phone": ("reach us at ", lambda: f"+1 (555) 01{digits(1)} {digits(4)}", lambda: "555 " + digits(3) + " " + digits(4)),
        "email": ("Contact: ", lambda: f"{letters(6)}@mail.com", lambda: letters(4) + digits(4) + ".x"),
        "ip": ("logged in from ", lambda: f"10.{rng.randint(0, 255)}.3.{rng.randint(0, 255)}", lambda: digits(12)),
        "secret": ('api_key = "', lambda: hashlib.md5(digits(9).encode()).hexdigest(), lambda: "Zk" + digits(9)),
    }
    rows, planted = [], {}
    for kind, (lead, seed, unseen) in known.items():
        for _ in range(40):
            rows.append(f"{prose(20)} {lead}{seed()} {prose(20)}")
        for _ in range(25):
            value, before = unseen(), prose(20)
            planted[len(rows)] = f"{kind}:{len(before) + 1 + len(lead)}:{len(before) + 1 + len(lead) + len(value)}"
            rows.append(f"{before} {lead}{value} {prose(20)}")
    # Numbers after ordinary words, also right after the same words as many seeds, are nothing.
    clean = range(len(rows), len(rows) + 200)
    rows += [f"{prose(10)} the {digits(9)} {prose(10)} of the {letters(3)}{digits(6)} {prose(5)}" for _ in clean]
    rows += [f"{prose(10)} of the {seed()} {prose(10)}" for _, seed, _ in known.values() for _ in range(15)]
    got = found(spark, rows)
    caught = sum(span in got[i].split(",") for i, span in planted.items())
    assert caught >= 0.9 * len(planted)
    assert all(got[i] == "" for i in clean)


def test_a_value_keeps_its_whole_length_and_base_spans_stay(spark):
    name = lambda i: "".join("abcdefghij"[int(c)] for c in str(100 + i))
    rows = [f"contact {name(i)}@mail.com" for i in range(20)]
    got = found(spark, [*rows, "contact " + "k1" * 50, "contact " + "k" * 60 + "1", "contact " + "k" * 99, "contact me@x.org1 or 12345678"])
    assert [got[i] for i in range(20, 24)] == ["email:8:108", "email:8:69", "", "email:8:17"]


def test_no_pattern_of_ordinary_words(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "text")
    patterns = pii.learn(pii.mark(docs, ["doc_id"]), docs).collect()
    assert patterns and all(r.kind == pii.SECRET and "token" in r.pattern for r in patterns if not r.pattern.startswith("= "))


def nearest(item: str, text: str) -> int:
    """Least edit distance of the item to any part of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_decontamination(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 6)))
    words = lambda n: " ".join(word() for _ in range(n))
    items = [(i, words(rng.choice([3, 12, 20]))) for i in range(8)]

    def noisy(text: str, edits: int) -> str:
        out = list(text)
        for _ in range(edits):
            at = rng.randrange(len(out))
            out[at : at + 1] = rng.choice([[], [rng.choice("abcde")], [out[at], "z"]])
        return "".join(out)

    docs = [(i, f"{words(8)} {noisy(rng.choice(items)[1], rng.randint(0, 6))} {words(8)}") for i in range(60)] + [(90, ""), (91, None), (92, words(30))]
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.op4_decontamination(spark, spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    want = set()
    for d, text in docs:
        for i, item in items:
            x = decontaminate.normal(item)
            k = nearest(x, decontaminate.normal(text)) if text else 99
            if k <= decontaminate.budget(x):
                want.add((d, i, k))
    assert got == want and len({d for _, _, d in got}) > 1


def test_bytes_law(spark):
    rows = sharding.op1_sharding(spark, table(spark, "/root/testdata/sf0.01", "documents")).collect()
    load = Counter()
    for r in rows:
        load[r.shard] += r.size
    mean = sum(load.values()) / 40
    assert set(load) == set(range(40)) and max(abs(v - mean) for v in load.values()) <= 0.02 * mean
    texts = {r.doc_id: (r.text or "").encode() for r in table(spark, "/root/testdata/sf0.01", "documents").collect()}
    assert all((r.size, r.text_crc32) == (len(texts[r.doc_id]) + 16, zlib.crc32(texts[r.doc_id])) for r in rows)


def test_language_is_the_smallest_encoding(spark):
    import zstandard

    docs = table(spark, SF, "documents")
    model = langid.learn(docs)
    got = {r.doc_id: r.lang_pred for r in langid.op2_language_id(spark, docs).collect()}
    encode = {}
    for lang, content in model.content.items():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        encode[lang] = lambda piece, d=d: len(zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_dict_id=False).compress(piece))
    for r in docs.collect():
        x = langid.letters(r.text)
        sizes = {lang: sum(f(x[i : i + langid.PIECE]) for i in range(0, len(x), langid.PIECE)) for lang, f in encode.items()}
        assert sizes[got[r.doc_id]] == min(sizes.values()) if x else got[r.doc_id] == "und"


@pytest.mark.parametrize("label, text", [(label, text) for label, _, text in licenses.TEMPLATES])
def test_templates_are_vocabulary(label, text):
    known = set(licenses.vocabulary())
    assert all(w in known or w in licenses.COMMON for w in text.split())


def test_every_template_is_found_and_near_misses_are_not(spark):
    rows = [(n, f"x y z {text} and more") for n, (_, _, text) in enumerate(licenses.TEMPLATES)]
    rows += [(100 + n, " ".join(reversed(text.split()))) for n, (_, _, text) in enumerate(licenses.TEMPLATES)]
    got = {r.doc_id: r.labels for r in licenses.op5_license_scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(label in got[n].split(",") for n, (label, _, _) in enumerate(licenses.TEMPLATES))
    assert all(got[100 + n] == "" for n in range(len(licenses.TEMPLATES)))


def test_pieces_are_cut_gapless(spark):
    rows = packing.op9_packing(spark, table(spark, SF, "documents")).collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length))
    for pieces in by_doc.values():
        pieces.sort()
        assert [p for p, _, _ in pieces] == list(range(len(pieces)))
        assert [s for _, s, _ in pieces] == [sum(n for _, _, n in pieces[:i]) for i in range(len(pieces))]
        assert all(n == packing.CAPACITY for _, _, n in pieces[1:])
    total = sum(r.length for r in rows)
    assert len({r.sequence_id for r in rows}) <= 1.02 * total / packing.CAPACITY + 1


def test_shards_stay_near_equal_with_a_third_of_the_rows_copies_without_an_id(spark):
    rows = [(i, f"text number {i} " + "x" * (i % 17)) for i in range(6000)] + [(None, "one text of many copies")] * 3000 + [(7, "another")] * 500
    out = sharding.op1_sharding(spark, spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, number int, copy_key int")).collect()
    assert len(out) == len(rows) and all(sorted(r.slot for r in out if r.shard == s) == list(range(sum(r.shard == s for r in out))) for s in range(40))
    sizes = Counter()
    for r in out:
        sizes[r.shard] += r.size
    mean = sum(sizes.values()) / 40
    assert len(sizes) == 40 and max(abs(v - mean) for v in sizes.values()) < 0.05 * mean


def test_ordinary_words_count_wherever_they_stand(spark):
    seeds = [f"then met zeta node 10.0.{i}.7 today" for i in range(12)]
    asked, ordinary = ["so met zeta node 77123456 here"], ["so met zeta node garden here"] * 400
    revealed = found(spark, seeds + asked)[12]
    assert revealed != ""
    assert found(spark, seeds + asked + ordinary)[12] == found(spark, seeds + asked + [t + " and a@b.cd" for t in ordinary])[12] == ""

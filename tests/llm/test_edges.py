"""Rows that once gave wrong answers: ids beside nulls, repeated ids, names that clash, texts without letters, long texts."""

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from emberline.llm import decontaminate, langid, licenses, ngram_join, packing, pii, session, substring_dedup, topk

BIG = 2**53 + 1
ITEM = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"


@pytest.fixture(scope="module")
def large_ids(spark):
    rows = [(None, "none " + ITEM), (BIG, ITEM), (BIG + 2, ITEM + " more"), (None, None), (-(2**63), "x"), (2**63 - 1, ITEM)]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)


def test_ids_beside_nulls(spark, large_ids):
    bench = spark.createDataFrame([(BIG, ITEM), (None, ITEM)], "item_id long, text string")
    hits = {(r.doc_id, r.item_id) for r in decontaminate.op4_decontamination(spark, large_ids, bench).collect()}
    assert hits == {(d, i) for d in (None, BIG, BIG + 2, 2**63 - 1) for i in (BIG, None)}
    want = sorted([None, None, BIG, BIG + 2, -(2**63), 2**63 - 1], key=str)
    for op in (ngram_join.op7_ngram_jaccard, packing.op9_packing, substring_dedup.op8_suffix_dedup, langid.op2_language_id):
        got = op(spark, large_ids.withColumn("lang", session.F.lit("en")))
        assert sorted((r.doc_id for r in got.collect()), key=str) == want


def test_special_tokens_are_as_the_tokenizer_gives_them(spark):
    text = "a <|endoftext|> b"
    ids = [*Tokenizer.from_file(packing.default_tokenizer()).encode(text, add_special_tokens=False).ids, packing.END_ID]
    row = packing.op9_packing(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.length == len(ids) and row.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes())


def test_texts_without_a_letter(spark):
    rows = [(i, t, "en") for i, t in enumerate(["\u00bd\u00b2 \u2167 3", "12 ...", "\u0301\u0301", "some words that are english", "\u00e9"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, langid.fit(docs)).select("doc_id", "language.*").collect()}
    assert got == {0: "und", 1: "und", 2: "und", 3: "en", 4: "en"}


def test_language_margin_rejects_ties_only(spark):
    model = langid.Dictionaries({"aa": b" lorem ipsum dolor sit amet ", "bb": b" lorem ipsum dolor sit amet "}, {"aa": 1, "bb": 2})
    assert [(lang, rejected) for lang, _, rejected in model.classify(["lorem ipsum", "?", None])] == [("bb", True), ("und", True), ("und", True)]


def test_names_that_clash(spark):
    extra = "language string, Email string, clean int, spans string, row int, doc string, digest_of_text string, nth int, n int, sig int"
    docs = spark.createDataFrame([(1, ITEM, "en", "l", "e", 1, "s", 2, "d", "t", 3, 4, 5), (2, "write me@x.org now", "en", "l", "e", 1, "s", 2, "d", "t", 3, 4, 5)], "doc_id long, text string, lang string, " + extra)
    bench = spark.createDataFrame([(1, "nothing like it at all")], "item_id long, text string")
    for stage in (langid.keep_identified, ngram_join.keep_one_of_each, lambda d: decontaminate.keep_uncontaminated(d, bench), pii.mask):
        out = stage(docs)
        assert out.columns == docs.columns
        for r in out.collect():
            assert tuple(r)[2:] == ("en", "l", "e", 1, "s", 2, "d", "t", 3, 4, 5)


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [2.0, 0.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (None, [1.0, 1.0]), (BIG, [1.0]), (6, [None, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.op6_exact_topk(spark, vectors).collect())
    one = [(1, 1, 131072), (2, 0, 65536), (3, BIG, 65536), (4, 50, 32768)]
    assert got == sorted([(0, *x) for x in one] * 2 + [(50, 1, 1, 65536), (50, 2, 0, 32768), (50, 3, 0, 32768), (50, 4, BIG, 32768)])
    assert topk.op6_exact_topk(spark, vectors.limit(0)).count() == 0 and topk.op6_exact_topk(spark, vectors.where("vec_id = 1")).count() == 0


def test_top_k_over_rounds_equals_brute_force(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-9, 9, (700, 6))
    vectors = spark.createDataFrame([(i % 500, [v / 256 for v in map(float, r)]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in topk.op6_exact_topk(spark, vectors).collect())
    want = []
    for q in range(700):
        if (q % 500) % 50 == 0:
            best = sorted((-int(x[q] @ x[i]), i % 500) for i in range(700) if i != q)[:5]
            want += [(q % 500, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert got == sorted(want)


def test_long_licence_text(spark):
    text = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software. Released under the MIT License. " * 1000
    row = licenses.op5_license_scan(spark, spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.n_base, row.labels, row.first_word, row.last_word, row.score) == (1000, "mit", 19, 21 * 1000 - 2, 1.0)


def test_long_texts(spark):
    text = ("mail a1@b.co then 12345678 and " * 3000) + ITEM
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert pii.op10_pii(spark, docs).first().n_email == 3000
    assert pii.mask(docs).first().text == text.replace("a1@b.co", "[EMAIL]")
    bench = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    assert [r.distance for r in decontaminate.op4_decontamination(spark, docs, bench).collect()] == [0]
    assert substring_dedup.op8_suffix_dedup(spark, docs).first().n_bytes == len(text)


def test_masking_keeps_control_characters(spark):
    docs = spark.createDataFrame([(1, "\u0001a\u0002 me@x.org \u0001"), (2, "\u0001")], "doc_id long, text string")
    assert {r.doc_id: r.text for r in pii.mask(docs).collect()} == {1: "\u0001a\u0002 [EMAIL] \u0001", 2: "\u0001"}
    spans = pii.op10_pii(spark, docs).where("doc_id = 1").first()
    assert spans.spans == "email:4:12" and spans.base_sha256 == hashlib.sha256(b"email:4:12").hexdigest()

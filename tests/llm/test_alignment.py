"""Alignment of two tokenizers against a plain comparison of every token pair's byte ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import sentencepiece
from tokenizers import Tokenizer, decoders

from emberline.llm import alignment
from emberline.llm.session import table

BYTE, PIECE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def aligned(text, byte, piece):
    """(A ids, B ids, groups, links) by walking both token lists; None where a text has no tokens."""
    if not text:
        return None
    a, b = byte.encode(" " + text, add_special_tokens=False), piece.encode(text, out_type=str)
    b_ids = piece.encode(text)
    a_bytes = [bytes(alphabet[c] for c in t) for t in a.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if piece.is_byte(i) else p.replace("▁", " ").encode() for p, i in zip(b, b_ids)]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return None
    spans = []
    for parts in (a_bytes, b_bytes):
        at = [0]
        for p in parts:
            at.append(at[-1] + len(p))
        spans.append(list(zip(at, at[1:])))
    links = [(x, y) for x, (lo, hi) in zip(a.ids, spans[0]) for y, (start, end) in zip(b_ids, spans[1]) if lo < end and start < hi]
    cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
    groups = [tuple(tuple(i for i, (_, e) in zip(ids, s) if lo < e <= hi) for ids, s in ((a.ids, spans[0]), (b_ids, spans[1]))) for lo, hi in zip([0, *cuts], cuts)]
    return len(a.ids), len(b_ids), groups, links


# What each character of a byte-level token stands for, as the library's own decoder has it.
_plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
alphabet = {chr(b): b for b in _plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _plain)}


def expected(rows):
    byte, piece = Tokenizer.from_file(BYTE), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    byte.encode_special_tokens = True
    known = {t: aligned(t, byte, piece) for t in {t for _, t in rows}}
    count, highest = Counter(), defaultdict(int)
    for _, t in rows:
        count.update(set(known[t][3]) if known[t] else ())
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for d, t in rows:
        if not (x := known[t]):
            out.append((d, 0, 0, 0, 0, 0, 0, ""))
            continue
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in x[2])
        best = sum(count[link] == highest[link[0]] for link in x[3])
        out.append((d, x[0], x[1], len(x[2]), len(x[3]), best, sum(count[link] for link in x[3]), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


def result(spark, rows, schema="doc_id long, text string"):
    return sorted(map(tuple, alignment.op13_alignment(spark, spark.createDataFrame(rows, schema)).collect()), key=str)


def test_whole_table(spark):
    rows = sorted(((r.doc_id, r.text) for r in table(spark, "/root/testdata/sf0.001", "documents").collect()), key=lambda r: len(r[1]))[:150]
    assert result(spark, rows) == expected(rows)


def test_odd_texts_copies_and_missing_ids(spark):
    rng = random.Random(3)
    parts = ["<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "  ", "\t", "\n\n", "é", "é", "\U0001f600", "ﬁ", "word", "12", "　", "'s", ".", "\u0000", " "]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(400)]
    rows += [(1, "one copied text")] * 7 + [(None, "one copied text")] * 200 + [(None, None), (5, ""), (5, " "), (6, "a" * 30_000), (7, "word " * 8_000)]
    byte = alignment.ByteTokenizer(BYTE)
    rest = decoders.ByteLevel()
    assert all(rest.decode([t]).encode() == byte.bytes_of[i] for t, i in [("Ġthe", byte._own.token_to_id("Ġthe")), ("Ċ", byte._own.token_to_id("Ċ"))])
    big = [r for r in rows if len(r[1] or "") < 9_000]
    assert result(spark, big) == expected(big)
    assert [len([r for r in result(spark, rows) if r[0] == i]) for i in (6, 7)] == [2, 2]


def test_blocks_hot_texts_and_extra_columns(spark, monkeypatch):
    rows = [(i, f"text {i % 40} of {i % 3}") for i in range(300)] + [(1000 + i, "hot") for i in range(150)]
    want = expected(rows)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 60)
    docs = spark.createDataFrame([(*r, "x", 1, b"k") for r in rows], "doc_id long, text string, block string, copies int, text_key binary")
    assert sorted(map(tuple, alignment.op13_alignment(spark, docs).collect()), key=str) == want


def test_empty_table(spark):
    assert result(spark, []) == []

"""Language identification by compression.

Each language has a raw-content zstandard dictionary cut from text known to be of it. A text is
encoded with every language's dictionary; the language that needs fewest bytes wins, and a text
on which the best two are too close is rejected. One rule holds for texts of every length.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from .session import crc32_of_id, free_name, save

UNKNOWN = "und"
#: Bytes of a language's dictionary: so many of each language are sent to the executors.
DICT_BYTES = 196_608
#: The bounded sample of labelled rows: so many different texts of each language, so many characters of each,
#: of a longer text from so many places.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_PLACES = 240, 4096, 4
#: So many languages are learned, and compared with a batch of texts, at a time; and so many sizes are held at once.
BLOCK, SIZES = 120, 10_000_000
LEVEL = 7
#: Texts are encoded piece by piece, so that a long text is compared with the dictionary and not with itself.
PIECE = 1024
#: Reject texts whose best two languages differ by less than this share of the second's bytes: ties, of short texts.
MARGIN = 0.001

_NOT_LETTERS = re.compile(r"[\W\d_]+")


def letters(text: str | None) -> bytes:
    """Lower-case words with one space around each: symbols, digits and case tell no language here. Empty without
    a letter; other numerals than digits are no letters, but stay in words."""
    if not text or not any(map(str.isalpha, text)):
        return b""
    return f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} ".encode("utf-8", "replace")


@dataclass
class Dictionaries:
    """Per language, its dictionary's content and its share of the sampled corpus' rows."""

    content: dict[str, bytes]
    rows: dict[str, int]
    _made: dict = field(default_factory=dict)

    def __getstate__(self):
        return {"content": self.content, "rows": self.rows, "_made": {}}

    def compressors(self, langs: list[str]) -> list[zstandard.ZstdCompressor]:
        """Those of ``langs``, at most BLOCK; they stay for the next call if there are no more languages."""
        if self._made:
            return [self._made[lang] for lang in langs]
        made = {}
        for lang in langs:
            d = zstandard.ZstdCompressionDict(self.content[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made[lang] = zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)
        if len(self.content) <= BLOCK:
            self._made = made
        return list(made.values())

    def classify(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        """Of each text: language, score from 0 to 1, whether it's rejected."""
        step = max(1, SIZES // max(1, len(self.content)))
        return [x for i in range(0, len(texts), step) for x in self._classify(texts[i : i + step])]

    def _classify(self, texts: list[str | None]) -> list[tuple[str, float, bool]]:
        words = [letters(t) for t in texts]
        told = [i for i, x in enumerate(words) if x and self.content]
        langs = sorted(self.content, key=lambda lang: (-self.rows[lang], lang))
        sizes = np.empty((len(told), len(langs)))
        for b in range(0, len(langs) if told else 0, BLOCK):
            made = self.compressors(langs[b : b + BLOCK])
            for row, i in zip(sizes, told):
                pieces = [words[i][k : k + PIECE] for k in range(0, len(words[i]), PIECE)]
                row[b : b + BLOCK] = [sum(len(c.compress(p)) for p in pieces) for c in made]
        out = [(UNKNOWN, 0.0, True)] * len(texts)
        for row, i in zip(sizes, told):
            if len(langs) == 1:
                out[i] = langs[0], 1.0, False
                continue
            first = int(row.argmin())  # the commonest of those with the least size
            best, second = float(row[first]), float(np.delete(row, first).min())
            score = 1 / float(np.exp(np.maximum(-700.0, best - row)).sum())
            out[i] = langs[first], score, (second - best) / second < MARGIN
        return out


def _places(text: Column) -> Column:
    """SAMPLE_CHARS characters of ``text``, spread over the whole of it."""
    n, piece = F.char_length(text), SAMPLE_CHARS // SAMPLE_PLACES
    start = lambda i: (F.floor((n - piece) * i / (SAMPLE_PLACES - 1)) + 1).cast("int")
    spread = F.concat_ws(" ", *[F.substring(text, start(i), F.lit(piece)) for i in range(SAMPLE_PLACES)])
    return F.when(n <= SAMPLE_CHARS, text).otherwise(spread)


def fit(labelled: DataFrame) -> Dictionaries:
    """Dictionaries of every language from a bounded sample of different (text, lang); rows with null text or lang teach nothing."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text", F.xxhash64("text").alias("key"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    first = Window.partitionBy("lang").orderBy("key")
    chosen = known.select("lang", "key").distinct().withColumn("n", F.row_number().over(first)).where(F.col("n") <= SAMPLE_ROWS)
    chosen = save(chosen, "language_sample")
    content, langs = {}, sorted(counts)
    for b in range(0, len(langs), BLOCK):
        block = F.col("lang").isin(langs[b : b + BLOCK])
        sample = (
            known.where(block)
            .join(F.broadcast(chosen.where(block)), ["lang", "key"])
            .select("lang", "n", _places(F.col("text")).alias("text"))
            .dropDuplicates(["lang", "n"])
            .collect()
        )
        texts: dict[str, list[bytes]] = {}
        for r in sorted(sample, key=lambda r: r["n"]):
            texts.setdefault(r["lang"], []).append(letters(r["text"]))
        for lang, found in texts.items():
            content[lang] = b"".join(found)[:DICT_BYTES] or b" "
    return Dictionaries(content, counts)


def predict(docs: DataFrame, model: Dictionaries, name: str = "language") -> DataFrame:
    """``docs`` with a struct ``name`` (lang_pred, score, rejected) from each whole text.

    Null texts and texts without a letter are ``und`` with score 0 and rejected; so is every text
    if nothing was learned. Repeated rows get the same answer each; other columns stay as they are.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def language(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            yield pd.DataFrame(shipped.value.classify(list(batch)), columns=["lang_pred", "score", "rejected"])

    return docs.withColumn(name, language("text"))


def held_out():
    return F.coalesce(F.pmod(crc32_of_id(), F.lit(4)) == 2, F.lit(False))


def learn(docs: DataFrame) -> Dictionaries:
    """From rows that aren't held out only."""
    return fit(docs.where(~held_out()).select("text", "lang"))


def op2_language_id(spark, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of each row; null ids are never held out, other edge rows are
    as ``predict`` states. An empty table gives no rows."""
    plain = docs.select("doc_id", "text", held_out().alias("held_out"))
    return predict(plain, learn(docs)).select("doc_id", "held_out", "language.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline stage: rows of ``docs`` that aren't rejected, with all their columns, whatever these are called.
    Null texts and texts without a letter go; repeated rows stay or go together; an empty table gives no rows."""
    name = free_name(docs, "language")
    return predict(docs, learn(docs), name).where(~F.col(name)["rejected"]).drop(name)

"""License scan with a positional index of rare words. DataFrame functions only.

The index holds the positions of each licence template's words, those of highest inverse document
frequency first. Of the words that a file shares with a template, the rarest are looked up; each of their
occurrences votes for the place where the template would begin. Where enough votes meet at one place,
the template's mandatory key phrase must stand at its own relative position. A file is read once, and the
work on it grows with its licence words (and their sorting), however many licences it repeats.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .columns import let
from .session import save

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Phrases whose every place counts, with their labels.
PHRASES = [
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
]

# Label, key phrase, template (short forms of a notice, then longer ones). The key phrase stands once in
# the template.
TEMPLATES = [
    ("agpl", "gnu affero general public license", "licensed under the gnu affero general public license version 3"),
    ("agpl", "gnu affero general public license", "it under the terms of the gnu affero general public license as published by the free software foundation either version 3"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("apache", "governing permissions", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("boost", "boost software license", "distributed under the boost software license version 1 0"),
    ("bsd", "binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "binary form", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("cc-by", "cc by", "licensed under cc by 4 0"),
    ("cc-by", "commons attribution", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc 4 0"),
    ("cc-by-nd", "cc by nd", "licensed under cc by nd 4 0"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa 4 0"),
    ("gpl", "gnu general public license", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "gnu general public license", "it under the terms of the gnu general public license as published by the free software foundation either version 3"),
    ("isc", "without fee", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license", "licensed under the gnu lesser general public license version 3"),
    ("lgpl", "gnu lesser general public license", "it under the terms of the gnu lesser general public license as published by the free software foundation either version 3"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license version 2 0"),
    ("unlicense", "unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("zlib", "as is without any express or implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
]
# Words too common to be looked up; key phrases may hold them.
COMMON = ["a", "an", "and", "any", "are", "as", "at", "be", "by", "for", "from", "in", "into", "is", "it", "must", "no", "not", "of", "on", "or", "the", "this", "to", "will", "with"]

#: Words of a file that are looked up for each template, the fewest, and the share of them that must vote for one place.
RARE_WORDS, FEWEST, SHARE = 4, 3, 0.75


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


@dataclass
class Template:
    """Label, key phrase with its offset, and (word, position) of each word that stands once, rarest first."""

    label: str
    key: list[str]
    offset: int
    postings: list[tuple[str, int]]


def vocabulary() -> list[str]:
    """Words of key phrases, base phrases and templates but for the common ones."""
    keys = {w for _, key, _ in TEMPLATES for w in key.split()} | {w for p, _ in PHRASES for w in p.split()}
    return sorted(keys | {w for _, _, t in TEMPLATES for w in t.split()} - set(COMMON))


def build_index(narrow: DataFrame) -> list[Template]:
    """The templates with their words in the order of inverse document frequency over all of ``narrow`` (ties: by position)."""
    found = narrow.select(F.explode(F.array_distinct(F.transform("hits", lambda h: h["word"]))).alias("word")).groupBy("word").count().collect()
    counts = {r["word"]: r["count"] for r in found}  # as many rows as the vocabulary at most
    out = []
    for label, key, text in TEMPLATES:
        t, k = text.split(), key.split()
        offset = next(i for i in range(len(t)) if t[i : i + len(k)] == k)
        once = [(w, i) for i, w in enumerate(t) if t.count(w) == 1 and w not in COMMON]
        out.append(Template(label, k, offset, sorted(once, key=lambda x: (counts.get(x[0], 0), x[1]))))
    return out


def _places(hits: Column, phrase: list[str]) -> Column:
    """Starts at which the words stand consecutively: neighbours among the hits, as these hold every word of the phrase."""

    def of_hits(all_hits: Column) -> Column:
        def stands(h: Column, j: Column) -> Column:
            out = h["word"] == phrase[0]
            for i, w in enumerate(phrase[1:], 1):
                later = F.get(all_hits, j + i)
                out = out & F.coalesce((later["word"] == w) & (later["place"] == h["place"] + i), F.lit(False))
            return out

        return F.transform(F.filter(all_hits, stands), lambda h: h["place"])

    return let(hits, of_hits)


def _template_share(hits: Column, words: Column, t: Template) -> Column:
    """The largest share of the looked-up words that meet at one verified place; null if none reaches SHARE.

    ``words``: the file's distinct licence words."""
    position = F.create_map(*[F.lit(x) for posting in t.postings for x in posting])
    rarest = F.slice(F.array_intersect(F.array(*[F.lit(w) for w, _ in t.postings]), words), 1, RARE_WORDS)

    def meet(votes: Column, n: Column, keyed: Column) -> Column:
        # A word stands once in the template, so each of its occurrences votes once for a start: as votes are sorted,
        # m words meet at a start where the vote m - 1 places on is the same.
        with_key = lambda m: F.size(F.array_intersect(F.filter(votes, lambda v, j: F.coalesce(F.get(votes, j + (m - 1)) == v, F.lit(False))), keyed)) > 0
        share = F.lit(None).cast("double")
        for m in range(1, RARE_WORDS + 1):
            share = F.when((n >= m) & (m >= n * SHARE) & with_key(m), m / n.cast("double")).otherwise(share)
        return share

    def of_words(chosen: Column) -> Column:
        votes = F.transform(F.filter(hits, lambda h: F.array_contains(chosen, h["word"])), lambda h: h["place"] - F.element_at(position, h["word"]))
        keyed = F.transform(_places(hits, t.key), lambda p: p - t.offset)
        looked = let(keyed, lambda k: F.when(F.size(k) > 0, let(F.array_sort(votes), lambda v: meet(v, F.size(chosen), k))))
        return F.when(F.size(chosen) >= min(FEWEST, len(t.postings)), looked)

    return let(rarest, of_words)


def licence_words(docs: DataFrame) -> DataFrame:
    """doc_id, n_words and ``hits`` (place, word: where words of the vocabulary stand), written once."""
    known = vocabulary()
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    hit = lambda w, i: F.when(w.isin(known), F.struct(i.alias("place"), w.alias("word")))
    return save(
        words.select("doc_id", F.size("words").cast("long").alias("n_words"), F.array_compact(F.transform("words", hit)).alias("hits")), "licence_words"
    )


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score for each row.

    A null text is empty. Labels of a text without any are the empty string. The score is the largest
    share of a template's looked-up words that meet at a verified place, at least 0.5 where a base phrase
    stands, else 0. Repeated rows are scanned each; of further columns nothing is used; an empty table gives no rows.
    """
    narrow = licence_words(docs)
    index = build_index(narrow)
    hits = F.col("hits")
    words = narrow.withColumn("words", F.array_distinct(F.transform("hits", lambda h: h["word"])))
    out = words.select(
        "doc_id", "n_words", *[_places(hits, p.split()).alias(f"p{n}") for n, (p, _) in enumerate(PHRASES)],
        *[_template_share(hits, F.col("words"), t).alias(f"t{n}") for n, t in enumerate(index)],
    )
    places = F.concat(*[F.col(f"p{n}") for n in range(len(PHRASES))])
    base = F.array_compact(F.array(*[F.when(F.size(f"p{n}") > 0, F.lit(label)) for n, (_, label) in enumerate(PHRASES)]))
    own = F.array_compact(F.array(*[F.when(F.col(f"t{n}").isNotNull(), F.lit(t.label)) for n, t in enumerate(index)]))
    listed = lambda a: F.concat_ws(",", F.array_sort(F.array_distinct(a)))
    shares = F.greatest(*[F.coalesce(f"t{n}", F.lit(0.0)) for n in range(len(index))])
    return (
        out.withColumn("places", places)
        .withColumn("base", base)
        .select(
            "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
            F.array_min("places").cast("long").alias("first_word"), F.array_max("places").cast("long").alias("last_word"),
            listed(F.col("base")).alias("base_labels"), listed(F.array_union("base", own)).alias("labels"),
            F.greatest(shares, F.when(F.size("base") > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"),
        )
    )


def op5_license_scan(spark, docs: DataFrame) -> DataFrame:
    """Licences of each row; edge rows as ``scan`` states."""
    return scan(docs)

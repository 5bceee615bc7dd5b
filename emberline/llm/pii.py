"""Personal data: fixed patterns, and bootstrapped contextual extraction. DataFrame functions only.

What the fixed patterns find are seed entities of their kinds; long random strings are seeds of the kind
``secret``. The words around a seed are lexical patterns: the two words before it, a label before it, or
the words on both sides. Patterns and the values that they select form a graph, on which Spark scores each
pattern by its values and each value by its patterns, in turn. What is no identifier of the pattern's kind counts
against it: values of another kind, values that stand elsewhere too, and ordinary words after the same words.
Patterns of high confidence then mark values that no fixed pattern knows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .columns import let
from .session import save

MARK = "\u0001"

# Kinds in their order, with the pattern of each. A run of characters that may begin a match is
# entered at its start or where the last match ended only: the same leftmost matches, in linear time.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for the pattern to have an acceptable match at all.
NEEDED = {
    "email": r"@[A-Za-z0-9-]+\.",
    "ip": r"[0-9]\.[0-9]+\.[0-9]+\.[0-9]",
    "card": r"[0-9](?:[\x20-]?[0-9]){13}",
    "phone": r"\+[0-9]",
}

#: The kind that only contexts find, and what its seeds look like.
SECRET = "secret"
SECRET_SEED = r"^(?=.*[0-9])(?=.*[A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,}|(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]{40,})$"
#: A value that may be an identifier: figures with what parts them, then a whole run of identifier characters.
VALUE = r"(?<![A-Za-z0-9+/_.@%-])(?=[A-Za-z+/_.@%(-]*+[0-9])(?:[+(]{0,2}[0-9](?:[\x20().-]{0,2}+[0-9])*+)?+[A-Za-z0-9+/_.@%-]*+"
LEAST_LENGTH = 6
#: What a value of each kind may look like where a context reveals it.
FIGURES = r"^[+(]{0,2}[0-9][0-9().\x20-]*$"
SHAPES = {"email": r"[A-Za-z]", "ip": FIGURES, "card": FIGURES, "phone": FIGURES, SECRET: r"[A-Za-z]"}
#: Characters of the surroundings in which the words around a value are sought.
BEFORE, AFTER = 60, 40
ROUNDS, CONFIDENCE, SUPPORT, DOUBT = 3, 0.8, 5, 2


def _starts(lengths: Column) -> Column:
    """Where each of consecutive pieces of these lengths starts. Sums of whole blocks keep it near linear."""
    block = 256
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + x)
    of_block = lambda a, b: F.slice(a, b * block + 1, F.lit(block))

    def with_blocks(sizes: Column) -> Column:
        sums = F.transform(F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / block).cast("int")), lambda b: total(of_block(sizes, b)))
        before = lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b)))
        here = lambda i: F.floor(i / block).cast("int")
        return let(
            let(sums, before),
            lambda done: F.transform(sizes, lambda _, i: F.get(done, here(i)) + total(F.slice(of_block(sizes, here(i)), F.lit(1), i % block))),
        )

    return let(lengths, with_blocks)


FOUND = "array<struct<start:int,end:int,value:string,left:string,right:string>>"


def _spans(text: Column, pattern: str, needed: str, check) -> Column:
    """FOUND: the pattern's matches in ``text`` (without MARK) that pass ``check``, with what stands around them
    up to the next match on either side."""

    def of_parts(parts: Column) -> Column:
        def of_starts(starts: Column) -> Column:
            def span(i: Column) -> Column:
                value = F.get(parts, i)
                return F.struct(
                    F.get(starts, i).alias("start"), (F.get(starts, i) + F.char_length(value)).alias("end"), value.alias("value"),
                    F.right(F.get(parts, i - 1), F.lit(BEFORE)).alias("left"), F.left(F.get(parts, i + 1), F.lit(AFTER)).alias("right"),
                )

            good = F.filter(F.sequence(F.lit(1), F.size(parts) - 1, F.lit(2)), lambda i: check(F.get(parts, i)))
            return F.transform(good, span)

        found = let(_starts(F.transform(parts, lambda p: F.char_length(p))), of_starts)
        return F.when(F.size(parts) > 2, found).otherwise(F.array().cast(FOUND))

    marked = F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)
    return F.when(text.rlike(needed), let(marked, of_parts)).otherwise(F.array().cast(FOUND))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    def checked(figures: Column) -> Column:
        def worth(c: Column, i: Column) -> Column:
            n = c.cast("int") * (F.lit(1) + i % 2)
            return F.when(n > 9, n - 9).otherwise(n)

        return F.aggregate(F.transform(figures, worth), F.lit(0), lambda a, x: a + x) % 10 == 0

    return let(F.filter(F.split(F.reverse(_digits(value)), ""), lambda c: c != ""), checked)


CHECKS = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: p.rlike("^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])$")),
    "card": lambda v: F.length(_digits(v)).between(14, 19) & _luhn(v),
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}


def _plain(text: Column) -> Column:
    """What contexts are compared by: lower case, any number as 0."""
    return F.regexp_replace(F.lower(text), "[0-9]+", "0")


def _patterns(second: Column, first: Column, prefix: Column, suffix: Column, after: Column) -> Column:
    """The patterns of a place: the two words before it, the words on both sides, and a label before it."""
    label = F.concat_ws(" ", first, prefix)
    is_label = label.rlike(r"\p{L}") & label.rlike(r"[:=#]")
    return F.array_compact(
        F.array(
            F.concat_ws(" ", second, first, F.concat(prefix, F.lit("_"))),
            F.concat_ws(" ", first, F.concat(prefix, F.lit("_"), suffix), after),
            F.when(is_label, F.concat(F.lit("# "), label, F.lit("_"))),
        )
    )


def _around(span: Column) -> Column:
    """The patterns of a span that has ``left`` and ``right``."""
    before, behind = F.concat(F.lit("^ ^ "), _plain(span["left"])), F.concat(_plain(span["right"]), F.lit(" $ $"))
    lead = lambda i: F.regexp_extract(before, r"(\S+)\s+(\S+)\s+(\S*)$", i)
    tail = lambda i: F.regexp_extract(behind, r"^(\S*)\s+(\S+)", i)
    return _patterns(lead(1), lead(2), lead(3), tail(1), tail(2))


def _word_patterns(clean: Column) -> Column:
    """Hashes of the patterns of each ordinary word of a text: words without a figure or @."""

    def of_words(words: Column) -> Column:
        at = lambda i, none: F.coalesce(F.get(words, i), F.lit(none))

        def of_word(word: Column, i: Column) -> Column:
            prefix, suffix = F.regexp_extract(word, "^.*[=:(\"'<\\[{#]", 0), F.regexp_extract(word, "[^\\p{L}\\p{N}]*$", 0)
            keys = F.transform(_patterns(at(i - 2, "^"), at(i - 1, "^"), prefix, suffix, at(i + 1, "$")), lambda p: F.xxhash64(p))
            return F.when(~word.rlike("[0-9@]"), keys).otherwise(F.array().cast("array<long>"))

        return F.flatten(F.transform(words, of_word))

    return let(F.split(_plain(F.trim(clean)), r"\s+"), of_words)


def _clean() -> Column:
    """The text that is searched: null is empty, and MARK keeps its place as another control character."""
    return F.translate(F.coalesce("text", F.lit("")), MARK, "\u0002")


def mark(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Written once: ``row``, ``doc`` (a struct of the columns ``keep``), base spans of each kind, ``values`` (start, end,
    value, patterns: what may be an identifier).

    A null text is empty. Positions are code points, ends exclusive.
    """
    out = docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*keep).alias("doc"), _clean().alias("clean"))
    for kind in KINDS:
        out = out.withColumn(kind, _spans(F.col("clean"), PATTERNS[kind], NEEDED[kind], CHECKS[kind]))
    long_enough = lambda v: F.char_length(v) >= LEAST_LENGTH
    out = out.withColumn("values", _spans(F.col("clean"), VALUE, "[0-9]", long_enough))

    def trimmed(v: Column) -> Column:
        value = F.regexp_replace(v["value"], r"(?<![.\-])[.\-]++$", "")
        return F.struct(v["start"].alias("start"), (v["start"] + F.char_length(value)).alias("end"), value.alias("value"), _around(v).alias("patterns"))

    with_patterns = lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["value"].alias("value"), _around(s).alias("patterns"))
    return save(
        out.select(
            "row", "doc", *[F.transform(kind, with_patterns).alias(kind) for kind in KINDS],
            F.transform("values", trimmed).alias("values"),
        ),
        "pii_marked",
    )


def graph_edges(marked: DataFrame) -> DataFrame:
    """Distinct (pattern, value, kind): what stands in which pattern; kind is null where no seed's form tells it.
    A value that starts where a base span does is that span's."""

    def edges(spans: Column, kind) -> Column:
        one = lambda s: F.transform(s["patterns"], lambda p: F.struct(p.alias("pattern"), F.md5(F.lower(s["value"]).cast("binary")).alias("value"), kind(s).alias("kind")))
        return F.flatten(F.transform(spans, one))

    base = F.concat(*[edges(F.col(kind), lambda _, kind=kind: F.lit(kind)) for kind in KINDS])
    taken = F.array_distinct(F.flatten(F.array(*[F.transform(kind, lambda s: s["start"]) for kind in KINDS])))
    free = let(taken, lambda starts: F.filter("values", lambda v: ~F.array_contains(starts, v["start"])))
    secret = lambda s: F.when(s["value"].rlike(SECRET_SEED), SECRET)
    return marked.select(F.explode(F.concat(base, edges(free, secret))).alias("e")).select("e.*").distinct()


def confident_patterns(edges: DataFrame, ordinary: DataFrame | None = None) -> DataFrame:
    """(pattern, kind, confidence) of patterns that select at least SUPPORT seeds of a kind, with confidence CONFIDENCE or more.

    A pattern's kind is that of most of its seeds. Its confidence is the sum of its values' scores over their
    number, to which DOUBT and the ordinary words in its place (``ordinary``: key, words) are added. A seed of the kind has
    score 1, one of another kind 0, and any other value the mean confidence of the patterns of the kind over all
    patterns that it stands in. Ties between kinds go to the first by name; no edges give no patterns.
    """
    seeds = edges.where("kind IS NOT NULL").groupBy("pattern", "kind").agg(F.count("*").alias("seeds"))
    best = seeds.groupBy("pattern").agg(F.max_by("kind", F.struct("seeds", "kind")).alias("of_kind"), F.max("seeds").alias("seeds"))
    supported = save(best.where(F.col("seeds") >= SUPPORT), "pii_supported")
    others = F.lit(0)
    if ordinary is not None:
        supported = supported.join(ordinary.withColumnRenamed("words", "ordinary"), F.xxhash64("pattern") == F.col("key"), "left").drop("key")
        others = F.coalesce(F.max("ordinary"), F.lit(0))
    graph = save(edges.join(supported, "pattern"), "pii_graph")
    width = graph.where("kind IS NULL").groupBy("value").agg(F.count("*").alias("patterns"))
    scores = graph.where("kind IS NULL").select("value", "of_kind", F.lit(0.0).alias("score")).distinct()
    for _ in range(ROUNDS):
        score = F.when(F.col("kind").isNull(), F.coalesce("score", F.lit(0.0))).otherwise((F.col("kind") == F.col("of_kind")).cast("double"))
        rated = graph.join(scores, ["value", "of_kind"], "left").groupBy("pattern", "of_kind").agg((F.sum(score) / (F.count("*") + others + DOUBT)).alias("confidence"), F.max("seeds").alias("seeds"))
        rated = save(rated, "pii_patterns")
        lent = graph.where("kind IS NULL").select("pattern", "value", "of_kind").join(rated.select("pattern", "confidence"), "pattern")
        scores = lent.groupBy("value", "of_kind").agg(F.sum("confidence").alias("sum")).join(width, "value").select("value", "of_kind", (F.col("sum") / F.col("patterns")).alias("score"))
    return rated.where(F.col("confidence") >= CONFIDENCE).select("pattern", F.col("of_kind").alias("kind"), "confidence")


def learn(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """The corpus' confident patterns.

    Ordinary words in a pattern's place only lower confidences. So patterns are rated without them first; for those that are confident then, the words are
    counted in every text, which is read for it where it is, and all are rated again. The others can't become confident, and lend their values what they lent before."""
    edges = save(graph_edges(marked), "pii_edges")
    able = save(confident_patterns(edges).select("pattern"), "pii_able")
    keys = save(able.select(F.xxhash64("pattern").alias("key")).distinct(), "pii_keys")
    words = docs.select(F.explode(_word_patterns(_clean())).alias("key"))
    return confident_patterns(edges, words.join(keys, "key").groupBy("key").agg(F.count("*").alias("words")))


def find(marked: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc``, ``n_<kind>``, ``base`` and ``spans``: all spans, sorted (start, rank, end, kind).

    Spans of different base kinds may overlap; a value that contexts reveal overlaps none of them and has the kind
    of the most confident of its patterns. Repeated rows get the same spans each; an empty table gives no rows.
    """
    every = [*KINDS, SECRET]
    one = lambda rank, kind: lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"))
    base = F.concat(*[F.transform(kind, one(rank, kind)) for rank, kind in enumerate(KINDS)])
    patterns = learn(marked, docs)
    asked = marked.select("row", F.explode("values").alias("v")).select("row", "v.start", "v.end", "v.value", F.explode("v.patterns").alias("pattern"))
    told = asked.join(patterns, "pattern").groupBy("row", "start", "end", "value").agg(F.max_by("kind", F.struct("confidence", "kind")).alias("kind"))
    shaped = reduce(lambda a, b: a | b, [(F.col("kind") == kind) & F.col("value").rlike(shape) for kind, shape in SHAPES.items()])
    told = save(told.where(shaped).select("row", "start", "end", "kind", F.lit(True).alias("new")), "pii_found")
    # Base spans of the same rows, to leave out what overlaps them: all before a value end before it, the next starts behind it.
    known = marked.join(told.select("row").distinct(), "row", "left_semi").select("row", F.explode(base).alias("s")).select("row", "s.start", "s.end", "s.kind", F.lit(False).alias("new"))
    place = Window.partitionBy("row").orderBy("start", "new", "end")
    reached = F.max(F.when(~F.col("new"), F.col("end"))).over(place.rowsBetween(Window.unboundedPreceding, -1))
    following = F.min(F.when(~F.col("new"), F.col("start"))).over(place.rowsBetween(1, Window.unboundedFollowing))
    both = told.unionByName(known).withColumn("clear", F.coalesce(reached <= F.col("start"), F.lit(True)) & F.coalesce(following >= F.col("end"), F.lit(True)))
    rank = F.coalesce(*[F.when(F.col("kind") == kind, n) for n, kind in enumerate(every)])
    added = both.where("new AND clear").groupBy("row").agg(F.collect_list(F.struct("start", rank.alias("rank"), "end", "kind")).alias("added"))
    narrow = marked.select("row", "doc", *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in KINDS], F.array_sort(base).alias("base"))
    out = narrow.join(save(added, "pii_added"), "row", "left")
    spans = F.when(F.col("added").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return out.withColumn("spans", spans).drop("row", "added")


def _listed(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))


def op10_pii(spark, docs: DataFrame) -> DataFrame:
    """Counts of base spans, the digest of these, and all spans of each row; edge rows as ``mark`` and ``find`` state. Of further
    columns nothing is used."""
    found = find(mark(docs, ["doc_id"]), docs)
    return found.select(
        "doc.doc_id", *[f"n_{kind}" for kind in KINDS],
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )


def mask(docs: DataFrame) -> DataFrame:
    """Pipeline stage: each span of ``text`` becomes its kind in brackets; of spans that overlap, the first and what goes on
    beyond it. Texts without a span, and nulls, stay as they are, and so do all other columns, whatever these are called."""
    found, text = find(mark(docs, docs.columns), docs), F.col("doc.text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        new = F.struct(F.concat(done["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"), s["end"].alias("at"))
        return F.when(s["end"] > done["at"], new).otherwise(done)

    masked = F.aggregate("spans", start, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.lit(2**31 - 1))))
    new_text = F.when(F.size("spans") > 0, masked).otherwise(text).alias("text")
    return found.select(*[new_text if c == "text" else F.col("doc")[c].alias(c) for c in docs.columns])

"""Each stage of the pipeline against brute force, and the pipeline as a whole."""

import corpus_pipeline
from emberline.llm import decontaminate, ngram_join
from emberline.llm.session import table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def shingles(text):
    w = [x.decode() for x in ngram_join.words(text)]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(a, b):
    x, y = shingles(a), shingles(b)
    return (a or "") == (b or "") or (bool(x and y) and 5 * len(x & y) >= 4 * len(x | y))


def test_one_of_each_class_stays(spark):
    docs = table(spark, SF, "documents").collect()
    rows = [tuple(r) for r in docs]
    rows += [(None, rows[3][1], "en", "s", 1), (None, rows[3][1], "en", "t", 1), (None, "no one else says these five words here", "en", "s", 1)]
    rows += [(None, "no one else says these five words here", "en", "s", 1), (rows[5][0], rows[5][1], "en", "s", 1), (rows[5][0], "one id but another text of its own", "en", "s", 1)]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if similar(rows[i][1], rows[j][1]):
                parent[top(i)] = top(j)
    want = {}
    for i, r in enumerate(rows):
        order = (r[0] is None, r[0] or 0)
        want[top(i)] = min(want.get(top(i), order), order)
    kept = corpus_pipeline.join_near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), SF).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept) == sorted(want.values())
    assert {tuple(r) for r in kept} <= set(rows)


def test_leaks_go_row_by_row(spark):
    bench = table(spark, SF, "benchmark")
    item = next(r.text for r in bench.collect() if r.text and len(r.text) > 60)
    rows = [(1, f"a b {item} c", "en", "s", 1), (1, "the same id, but clean", "en", "s", 1), (None, item, "en", "s", 1), (None, "clean", "en", "s", 1), (2, None, "en", "s", 1), (3, "", "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, SF).collect()
    assert {tuple(r) for r in kept} == {rows[1], rows[3], rows[4], rows[5]}
    matcher = decontaminate.Matcher([(r.item_id, decontaminate.normal(r.text)) for r in bench.collect()])
    all_docs = table(spark, SF, "documents")
    want = {r.doc_id for r in all_docs.collect() if not matcher.find(r.text)}
    assert {r.doc_id for r in corpus_pipeline.drop_benchmark_leaks(spark, all_docs, SF).collect()} == want


def test_identified_documents_stay(spark):
    docs = table(spark, SF, "documents")
    odd = spark.createDataFrame([(None, None, None, None, None), (9, "123 ...", "en", "s", 1)], SCHEMA)
    kept = corpus_pipeline.identify_language(spark, docs.select("doc_id", "text", "lang", "source", "n_chars").unionByName(odd), SF).collect()
    assert {r.doc_id for r in kept} <= {r.doc_id for r in docs.collect()} and len(kept) >= 0.97 * docs.count()


def test_the_whole(spark):
    docs = table(spark, SF, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == table(spark, SF, "documents").columns
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0

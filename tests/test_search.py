"""Searches on the mini corpus; the expected numbers follow from the formulas by hand."""

import math
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from mini import MINI_STOP
from termloom import (
    search,
    search_anchor,
    search_body,
    search_body_cosine,
    search_title,
)
from termloom.functions.text import BUILD_PATTERN
from termloom.plans.search import body_scores, candidates, cosine_scores, pair_weights, query_terms

OPTIONS = dict(pattern=BUILD_PATTERN, stopwords=MINI_STOP)


def by_query(df, *columns):
    result = {}
    for row in df.collect():
        result.setdefault(row.query_id, []).append(tuple(row[c] for c in columns))
    return result


@pytest.fixture(scope="module")
def terms(body, queries):
    return query_terms(body, queries, **OPTIONS)


def test_query_vector(terms):
    ordered = terms.table.orderBy("query_id", "ord")
    vectors = by_query(ordered, "term", "weight")
    rounded = {q: [(t, round(w, 6)) for t, w in v] for q, v in vectors.items()}
    assert rounded == {
        1: [("duck", 0.110924), ("rubber", 0.198970)],
        2: [("boat", 0.132647), ("duck", 0.073950)],
        3: [("duck", 0.221849)],
    }


def test_positional_scores(body, terms):
    scores = by_query(body_scores(body, terms), "doc_id", "score")
    assert {q: dict(v) for q, v in scores.items()} == {
        1: {1: 0.26485, 3: 0.13242, 2: 0.04922, 5: 0.02461},
        2: {1: 0.13838, 2: 0.05885, 3: 0.05279, 5: 0.02943},
        3: {2: 0.09843, 1: 0.04922, 5: 0.04922},
    }


def test_aligned_scores(body, terms):
    scores = by_query(body_scores(body, terms, scoring="aligned"), "doc_id", "score")
    assert {q: dict(v) for q, v in scores.items()} == {
        1: {1: 0.36593, 3: 0.23753, 2: 0.04922, 5: 0.02461},
        2: {1: 0.13838, 3: 0.05279, 2: 0.03281, 5: 0.01641},
        3: {2: 0.09843, 1: 0.04922, 5: 0.04922},
    }


def test_cosine_scores(body, terms):
    scores = by_query(cosine_scores(body, terms), "doc_id", "score")
    assert {q: dict(v) for q, v in scores.items()} == {
        1: {1: 0.97211, 3: 0.87344, 2: 0.48694, 5: 0.48694},
        2: {1: 1.0, 3: 0.87344, 2: 0.48694, 5: 0.48694},
        3: {1: 1.0, 2: 1.0, 5: 1.0},
    }


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5, 6])
def test_candidate_cut_is_exact(body, queries, k):
    """The pruned, two-step cut keeps just what a full sort would keep."""
    postings = {(r.term, r.doc_id): r.tf for r in body.postings().collect()}
    df = {}
    for term, _ in postings:
        df[term] = df.get(term, 0) + 1
    words = {1: ["duck", "rubber"], 2: ["boat", "duck"], 3: ["duck"]}
    expected = {}
    for query, used in words.items():
        pairs = [
            (-tf * math.log10(5 / df[t]), t, d)
            for (t, d), tf in postings.items()
            if t in used
        ]
        expected[query] = [(t, d) for _, t, d in sorted(pairs)[:k]]
    cut = query_terms(body, queries, max_pairs=k, **OPTIONS)
    for reach in (cut.reach, 10**9):
        sized = replace(cut, reach=reach)
        got = candidates(body, sized, max_pairs=k).orderBy("query_id", "ck")
        assert by_query(got, "term", "doc_id") == expected


def test_given_corpus_size(body, queries):
    """With N below a term's document frequency its weights are negative, not lost."""
    cut = query_terms(body, queries, n_docs=2, **OPTIONS)
    pairs = candidates(body, cut, n_docs=2).filter("query_id = 3").orderBy("ck").collect()
    expected = [(d, tf * math.log10(2 / 3)) for d, tf in [(1, 1), (5, 1), (2, 2)]]
    assert [r.doc_id for r in pairs] == [d for d, _ in expected]
    assert [r.w for r in pairs] == pytest.approx([w for _, w in expected])


@pytest.mark.parametrize("call", [search, search_body])
def test_search(body, titles, queries, call):
    results = call(body, titles, queries, **OPTIONS).orderBy("query_id", "rank")
    assert by_query(results, "doc_id", "hits") == {
        1: [(1, 2), (3, 1), (2, 1), (5, 1)],
        2: [(1, 1), (2, 1), (3, 1), (5, 1)],
        3: [(2, 2), (1, 2), (5, 1)],
    }
    titled = by_query(results, "doc_id", "title")[3]
    assert titled == [(2, "Duck"), (1, "Rubber duck"), (5, None)]


def test_search_keeps_n(body, titles, queries):
    results = search(body, titles, queries, n=2, **OPTIONS).orderBy("query_id", "rank")
    assert by_query(results, "rank", "doc_id") == {
        1: [(1, 1), (2, 3)],
        2: [(1, 1), (2, 2)],
        3: [(1, 2), (2, 1)],
    }


def test_search_body_cosine(body, titles, queries):
    results = search_body_cosine(body, titles, queries, n=3, **OPTIONS)
    assert by_query(results.orderBy("query_id", "rank"), "doc_id", "score") == {
        1: [(1, 0.97211), (3, 0.87344), (2, 0.48694)],
        2: [(1, 1.0), (3, 0.87344), (2, 0.48694)],
        3: [(1, 1.0), (2, 1.0), (5, 1.0)],
    }


def test_search_title(titles, queries):
    assert by_query(search_title(titles, queries, **OPTIONS), "doc_id", "hits") == {
        1: [(1, 2), (2, 1)],
        2: [(1, 1), (2, 1)],
        3: [(1, 2), (2, 2)],
    }


def test_search_anchor(anchors, mini, queries):
    results = search_anchor(anchors, mini.select("doc_id", "title"), queries, **OPTIONS)
    assert by_query(results, "doc_id", "hits") == {
        1: [(1, 2), (2, 1)],
        2: [(1, 1), (2, 1), (3, 1)],
        3: [(1, 2), (2, 2)],
    }


def test_title_word_outside_the_body_counts_only_in_title_search(spark, build):
    docs = spark.createDataFrame(
        [(1, "alpha beta", "gamma"), (2, "beta", "delta"), (3, "omega", "beta")],
        "doc_id bigint, text string, title string",
    )
    body = build(docs)
    titles = build(docs.select("doc_id", F.col("title").alias("text"), "title"))
    asked = spark.createDataFrame([(1, "gamma beta gamma")], "query_id int, query_text string")
    found = search(body, titles, asked, **OPTIONS)
    assert {(r.doc_id, r.hits) for r in found.collect()} == {(1, 1), (2, 1)}
    found = search_title(titles, asked, **OPTIONS)
    assert {(r.doc_id, r.hits) for r in found.collect()} == {(1, 2), (3, 1)}


def test_many_queries_take_the_shuffled_path(body, titles, queries, monkeypatch):
    """With nothing broadcast, and postings copied for groups of queries."""
    from termloom.operators import matching
    from termloom.sources import shared

    expected = search(body, titles, queries, **OPTIONS).collect()
    monkeypatch.setattr(shared.broadcast_within, "__defaults__", (0,))
    monkeypatch.setattr(matching, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(matching, "QUERIES_PER_COPY", 1)
    got = search(body, titles, queries, **OPTIONS)
    assert sorted(got.collect()) == sorted(expected)


def test_large_candidate_sets_against_brute_force(spark, build, monkeypatch):
    """Scores over a cut that bites, on documents whose weights differ and tie."""
    docs = spark.range(300).selectExpr(
        "id AS doc_id",
        "concat(repeat('alpha ', 1 + id % 7), repeat('beta ', id % 5), 'gamma') AS text",
        "'t' AS title",
    )
    index = build(docs)
    asked = spark.createDataFrame([(1, "gamma beta alpha")], "query_id int, query_text string")
    tf = {
        (t, d): n
        for d in range(300)
        for t, n in (("alpha", 1 + d % 7), ("beta", d % 5), ("gamma", 1))
        if n
    }
    df = {t: sum(1 for key in tf if key[0] == t) for t in ("alpha", "beta", "gamma")}
    pairs = sorted((-n * math.log10(400 / df[t]), t, d) for (t, d), n in tf.items())
    for k in (1, 37, 100, 500):
        cut = query_terms(index, asked, n_docs=400, max_pairs=k, **OPTIONS)
        assert cut.reach >= min(k, len(pairs))
        got = candidates(index, cut, n_docs=400, max_pairs=k).orderBy("ck").collect()
        assert [(r.term, r.doc_id) for r in got] == [(t, d) for _, t, d in pairs[:k]]


def test_hot_terms_in_parts(build, mini, body, titles, queries):
    cut_body = build(mini, part_rows=1)
    assert cut_body.posting_table().filter("part > 0").count() > 0
    cut_titles = build(
        mini.select("doc_id", F.col("title").alias("text"), "title"), part_rows=1
    )
    expected = search(body, titles, queries, **OPTIONS).collect()
    assert sorted(search(cut_body, cut_titles, queries, **OPTIONS).collect()) == sorted(
        expected
    )


@pytest.mark.parametrize("texts", [[], ["zebra quagga the"]])
def test_queries_that_find_nothing(spark, body, titles, anchors, mini, texts):
    asked = spark.range(len(texts)).select(
        F.col("id").alias("query_id"),
        F.get(F.array(*map(F.lit, texts)).cast("array<string>"), F.lit(0)).alias("query_text"),
    )
    names = mini.select("doc_id", "title")
    assert search(body, titles, asked, **OPTIONS).collect() == []
    assert search_body_cosine(body, titles, asked, **OPTIONS).collect() == []
    assert search_title(titles, asked, **OPTIONS).collect() == []
    assert search_anchor(anchors, names, asked, **OPTIONS).collect() == []
    empty = asked.filter("false")
    assert search(body, titles, empty, **OPTIONS).collect() == []


def test_blocks_below_the_floor_are_not_opened(build, spark):
    """A term's entries lie by falling ``tf``; a small cut opens the first pages only."""
    rows = spark.range(70_000).selectExpr(
        "id AS doc_id", "repeat('duck ', IF(id % 100 = 7, 5, IF(id % 3 = 0, 2, 1))) || IF(id % 2 = 0, 'pond', '') AS text"
    )
    index = build(rows, buckets=1)
    asked = spark.createDataFrame([(1, "duck")], "query_id bigint, query_text string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        read = {}
        for cut in (100, 5_000, 60_000, None):
            terms = query_terms(index, asked, stopwords=MINI_STOP, n_docs=1_000_000, max_pairs=cut)
            pairs = pair_weights(index, terms)
            found = pairs.collect()
            leaves = pairs._jdf.queryExecution().executedPlan().collectLeaves()
            scans = [leaves.apply(i) for i in range(leaves.size())]
            sizes = [s.metrics().apply("numOutputRows").value() for s in scans if "postings" in s.toString()]
            read[cut] = sum(sizes)
            every = pair_weights(
                index, query_terms(index, asked, stopwords=MINI_STOP, n_docs=1_000_000, max_pairs=None)
            ).collect()
            best = sorted((-r.w, r.doc_id) for r in every)[: cut or len(every)]
            assert sorted((-r.w, r.doc_id) for r in found)[: len(best)] == best
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert read[100] <= read[5_000] < read[60_000] <= read[None]
    assert read[100] <= 25_000

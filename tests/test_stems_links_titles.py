"""Stemmed indexes, titles without a scan, postings without a look at the terms, links, ordered lists."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mini import MINI_DOCS, MINI_STOP
from porter import stem
from termloom import add_documents, add_stems, read_index, search, search_stemmed, search_title
from termloom.functions.text import BUILD_PATTERN
from termloom.operators import postings as ops
from termloom.plans import build as plans
from termloom.sources.links import href_of, link_source, page_address, resolved
from termloom.sources.tables import scan_qrels, write_qrels

TEXTS = [
    (1, "Connecting connections connect ponies", "Connected pony"),
    (2, "The connected pony and the connection", "Ponies"),
    (3, "Relational relations relate; a pony relates", None),
    (4, "rating rational rations", "Rating"),
    (5, "connects connects connects", "Connections of ponies"),
]
OPTIONS = dict(pattern=BUILD_PATTERN, stopwords=MINI_STOP)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shape(text):
    """An adaptive plan without the numbers of its nodes."""
    return re.sub(r"#\d+L?", "", text)


def counted(rows, of=lambda word: word):
    out = Counter()
    for i, text, _ in rows:
        words = [w for w in re.findall(r"\w{3,}", text.lower()) if w not in MINI_STOP]
        out.update((of(w), i) for w in words)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id bigint, text string, title string")


@pytest.fixture(scope="module")
def stems(build, docs):
    titles = docs.select("doc_id", F.col("title").alias("text"), "title")
    return build(docs, stem=True), build(titles, stem=True)


def stem_rows(index):
    return {(r.term, r.doc_id): r.tf for r in index.stemmed().postings().collect()}


def check_statistics(index, rows):
    wanted = counted(rows, stem)
    assert stem_rows(index) == wanted
    found = {r.term: (r.df, r.term_total) for r in index.stemmed().terms().collect()}
    assert found == {
        s: (sum(t == s for t, _ in wanted), sum(n for (t, _), n in wanted.items() if t == s)) for s, _ in wanted
    }


def test_statistics_by_stem(stems):
    index, _ = stems
    check_statistics(index, TEXTS)
    words = {r.term: {v.term: v.df for v in r.variants} for r in index.stemmed().term_table().collect()}
    assert words["connect"] == {"connect": 1, "connected": 1, "connecting": 1, "connection": 1, "connections": 1, "connects": 1}
    # The postings are those of the words, and plain searches read them as before.
    assert {(r.term, r.doc_id): r.tf for r in index.postings().collect()} == counted(TEXTS)


@pytest.mark.parametrize("part_rows", [1, None])
def test_stems_survive_appends_parts_and_reopening(spark, build, docs, part_rows):
    first = build(docs.filter("doc_id < 3"), stem=True, part_rows=part_rows)
    second = add_documents(first, docs.filter("doc_id >= 3"))
    check_statistics(second, TEXTS)
    check_statistics(read_index(spark, second.path), TEXTS)
    check_statistics(plans.compact(second), TEXTS)


def test_stems_added_later_and_missing(build, docs):
    index = build(docs)
    with pytest.raises(ValueError):
        index.stemmed()
    check_statistics(add_stems(index), TEXTS)


def test_least_frequency_counts_documents_of_a_stem(build, docs):
    index = build(docs, stem=True, min_df=2)
    assert not index.terms().collect()
    assert {r.term for r in index.stemmed().terms().collect()} == {"connect", "poni"}


def test_stemmed_search_finds_all_words_of_a_stem(spark, stems):
    body, titles = stems
    queries = spark.createDataFrame([(1, "connecting pony"), (2, "relate"), (3, "the"), (4, None)], "query_id bigint, query_text string")
    found = search_stemmed(body, titles, queries, **OPTIONS).collect()
    hits = {(r.query_id, r.doc_id): r.hits for r in found}
    assert hits == {(1, 1): 2, (1, 2): 1, (1, 3): 1, (1, 5): 2, (2, 3): 1}
    plain = {(r.query_id, r.doc_id) for r in search(body, titles, queries, **OPTIONS).collect()}
    assert plain < set(hits)
    listed = search_title(titles.stemmed(), queries, **OPTIONS).collect()
    assert [(r.query_id, r.doc_id, r.hits) for r in listed] == [(1, 1, 2), (1, 5, 2), (1, 2, 1)]


def test_stemmed_search_equals_a_search_of_stemmed_texts(spark, build):
    """The same ranking and scores as an index of texts whose words were stemmed before."""
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60).collect()
    words = {r.doc_id: re.findall(r"[a-z]{3,25}", (r.text or "").lower()) for r in rows}
    asked = {i: w[:6] for i, w in list(words.items())[:8]}

    def table(texts, name):
        return spark.createDataFrame([(i, " ".join(w)) for i, w in texts.items()], f"{name}_id bigint, {name} string")

    def frames(change):
        docs, queries = ({i: [change(x) for x in w] for i, w in t.items()} for t in (words, asked))
        return (
            table(docs, "doc").withColumnRenamed("doc", "text"),
            table(queries, "query").withColumnRenamed("query", "query_text"),
        )

    options = dict(pattern="[a-z]{1,25}", stopwords=())
    docs, queries = frames(lambda word: word)
    by_stem = build(docs, stem=True, **options)
    a = search_stemmed(by_stem, by_stem, queries, **options)
    docs, queries = frames(stem)
    before = build(docs, **options)
    b = search(before, before, queries, **options)
    columns = ("query_id", "rank", "doc_id", "hits", "score")
    assert sorted(map(tuple, a.select(*columns).collect())) == sorted(map(tuple, b.select(*columns).collect()))
    assert a.count() > 20


# --- titles and postings


def test_titles_are_looked_up_by_bucket(spark, build, monkeypatch):
    """For some results only the buckets of their ids are opened, and no document is shuffled."""
    monkeypatch.setattr(plans, "DOC_BUCKET_ROWS", 1)
    rows = [(i, f"word{i} common text", f"title {i}") for i in range(40)]
    index = build(spark.createDataFrame(rows, "doc_id bigint, text string, title string"))
    assert index.doc_buckets == 40
    ids = spark.createDataFrame([(3,), (17,), (17,), (99,)], "doc_id bigint")
    found = index.docs_of(ids, 4)
    text = plan(found)
    assert "dynamicpruning" in text and "BroadcastHashJoin" in text
    assert not re.search(r"FileScan parquet (?!.*docs)", text) or "documents" not in text
    assert {(r.doc_id, r.title) for r in found.collect()} == {(3, "title 3"), (17, "title 17")}
    assert "/documents" not in "".join(index.docs().inputFiles())
    read = {re.search(r"bucket=(\d+)", f).group(1) for f in index.doc_table().inputFiles()}
    assert len(read) > 10
    # Without a bound of the ids both sides are shuffled; the rows are the same.
    assert sorted(map(tuple, index.docs_of(ids).collect())) == sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("min_df", [0, 1, 2])
def test_postings_of_one_batch_need_no_shuffle(build, mini, min_df):
    index = build(mini, min_df=min_df)
    frequent = {t for t, n in Counter(t for t, _ in counted(MINI_DOCS)).items() if n > min_df}
    wanted = {k: n for k, n in counted(MINI_DOCS).items() if k[0] in frequent}
    assert {(r.term, r.doc_id): r.tf for r in index.postings().collect()} == wanted
    text = plan(index.postings())
    assert "Exchange" not in text and "Join" not in text
    lengths = index.postings(lengths=True)
    assert "Exchange" not in plan(lengths) and "doc_len" in lengths.columns


@pytest.mark.parametrize("part_rows", [1, 2, None])
def test_rare_terms_of_batches_and_parts(build, mini, part_rows):
    """A term that is rare in every batch may be frequent in all; parts of a term are not rare terms."""
    index = build(mini.filter("doc_id = 1"), min_df=1, part_rows=part_rows)
    for i in (2, 3, 4, 5):
        index = add_documents(index, mini.filter(F.col("doc_id") == i))
    for version in (index, plans.compact(index), build(mini, min_df=1, part_rows=part_rows)):
        frequent = {t for t, n in Counter(t for t, _ in counted(MINI_DOCS)).items() if n > 1}
        wanted = {k: n for k, n in counted(MINI_DOCS).items() if k[0] in frequent}
        assert {(r.term, r.doc_id): r.tf for r in version.postings().collect()} == wanted


# --- lists and links


def test_string_lists_are_whole_ordered_and_bounded(spark):
    rows = [("hot", f"d{i:04d}", i % 7 + 1) for i in range(500)] + [("cold", "x", 1), ("cold", "a", 2)]
    df = spark.createDataFrame(rows, "term string, doc_id string, tf int").repartition(5)
    lists = ops.posting_lists(df, block_docs=64).collect()
    assert max(r.n for r in lists) == 64 and all(len(r.postings) == r.n for r in lists)
    for term in ("hot", "cold"):
        blocks = sorted((r for r in lists if r.term == term), key=lambda r: r.block)
        assert [r.block for r in blocks] == list(range(len(blocks)))
        whole = [(p.doc_id, p.tf) for r in blocks for p in r.postings]
        assert whole == sorted((d, n) for t, d, n in rows if t == term)


def test_truth_lists_of_string_ids(spark, tmp_path):
    rows = [("q", f"d{i:03d}") for i in range(100)] + [("r", "x")]
    write_qrels(spark.createDataFrame(rows, "query_text string, doc_id string"), f"{tmp_path}/truth", block_docs=30)
    lines = [r.value for r in spark.read.text(f"{tmp_path}/truth").collect()]
    assert sorted(line.count('"d') for line in lines) == [0, 10, 30, 30, 30]


LINKS = [
    ('<a href="/x">plain</a>', "/x", "plain"),
    ("<A class=c HREF='/y'>single</A>", "/y", "single"),
    ('<a data-href="/no" title="a > b href=/no" href=/z>un<b>quot</b>ed</a >', "/z", "unquoted"),
    ('<a\nhref = "/w?a=1&amp;b=2" rel="x">a &amp; b\nc</a>', "/w?a=1&b=2", "a & b\nc"),
    ('<a href="">same</a>', "", "same"),
]


def test_links_in_any_form(spark):
    html = "<p>text " + " and ".join(link for link, *_ in LINKS) + '<a name="n">none</a> <abbr href="/no">no</abbr> <a>bare</a>'
    pages = spark.createDataFrame([("http://h/p#f", html), ("http://h/q", None), ("http://h/r", "")], "url string, html string")
    rows = link_source(pages).collect()
    assert [(r.page, r.href, r.anchor_text) for r in rows] == [("http://h/p", href, text) for _, href, text in LINKS]
    assert rows[0].target == "http://h/x" and rows[4].target == "http://h/p"


# The examples of RFC 3986, 5.4, without their fragments.
RESOLVED = {
    "g:h": "g:h", "g": "http://a/b/c/g", "./g": "http://a/b/c/g", "g/": "http://a/b/c/g/", "/g": "http://a/g",
    "//g": "http://g", "?y": "http://a/b/c/d;p?y", "g?y": "http://a/b/c/g?y", "#s": "http://a/b/c/d;p?q",
    "g#s": "http://a/b/c/g", "g?y#s": "http://a/b/c/g?y", ";x": "http://a/b/c/;x", "g;x": "http://a/b/c/g;x",
    "": "http://a/b/c/d;p?q", ".": "http://a/b/c/", "./": "http://a/b/c/", "..": "http://a/b/", "../": "http://a/b/",
    "../g": "http://a/b/g", "../..": "http://a/", "../../": "http://a/", "../../g": "http://a/g",
    "../../../g": "http://a/g", "/./g": "http://a/g", "/../g": "http://a/g", "g.": "http://a/b/c/g.", "..g": "http://a/b/c/..g",
    "./../g": "http://a/b/g", "./g/.": "http://a/b/c/g/", "g/./h": "http://a/b/c/g/h", "g/../h": "http://a/b/c/h",
    "g?y/../x": "http://a/b/c/g?y/../x", "mailto:x@y": "mailto:x@y",
}


def test_addresses_are_resolved_as_the_standard_says(spark):
    df = spark.createDataFrame([(h,) for h in RESOLVED], "href string")
    rows = df.select("href", resolved(F.lit("http://a/b/c/d;p?q"), F.col("href")).alias("target")).collect()
    assert {r.href: r.target for r in rows} == RESOLVED
    bare = df.select(resolved(F.lit("http://a"), F.lit("g")).alias("t"), page_address(F.lit("http://a/b#c")).alias("p")).first()
    assert tuple(bare) == ("http://a/g", "http://a/b")
    assert df.select(href_of(F.lit(" id=3 checked")).alias("h")).first().h is None


def test_titles_of_link_targets(spark, build):
    """Results of link texts have the title of the page that the resolved address names."""
    pages = spark.createDataFrame(
        [
            ("http://h/a/one", '<title>One</title><a href="two">rubber duck</a>'),
            ("http://h/a/two#top", "<title>Two</title><a href='../a/one'>boat</a> <a href='/gone'>duck</a>"),
        ],
        "url string, html string",
    )
    links = link_source(pages)
    index = build(links.select(F.col("target").alias("doc_id"), F.col("anchor_text").alias("text")), single_row=False)
    titles = pages.select(page_address(F.col("url")).alias("doc_id"), F.regexp_extract("html", "<title>([^<]*)", 1).alias("title"))
    from termloom import search_anchor

    queries = spark.createDataFrame([(1, "duck"), (2, "boat")], "query_id bigint, query_text string")
    rows = search_anchor(index, titles, queries, **OPTIONS).collect()
    assert [(r.query_id, r.doc_id, r.title, r.hits) for r in rows] == [
        (1, "http://h/a/two", "Two", 1), (1, "http://h/gone", None, 1), (2, "http://h/a/one", "One", 1),
    ]

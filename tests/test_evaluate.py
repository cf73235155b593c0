"""Average precision, cosine, and the id look-ups."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from mini import MINI_STOP
from termloom import evaluate, get_pagerank, get_pageview, mean_average_precision
from termloom.functions.weights import cosine
from termloom.operators.ranking import top_per_group
from termloom.plans.evaluate import average_precision
from termloom.plans.requests import id_list
from termloom.sources import tables


def rankings(spark, lists):
    rows = [(q, i + 1, d) for q, docs in lists.items() for i, d in enumerate(docs)]
    return spark.createDataFrame(rows, "query_id int, rank int, doc_id int")


def truths(spark, lists):
    rows = [(q, d) for q, docs in lists.items() for d in docs]
    return spark.createDataFrame(rows, "query_id int, doc_id int")


def test_average_precision(spark):
    truth = truths(spark, {1: [1, 5, 9], 2: [7], 3: [1, 2, 3], 4: [1], 5: [40], 6: [41]})
    ranked = rankings(
        spark,
        {1: [1, 2, 5], 2: [1, 2], 3: [3, 9, 1, 2], 5: range(1, 101), 6: range(1, 101)},
    )
    scores = average_precision(truth, ranked)
    assert {r.query_id: r.ap for r in scores.collect()} == {
        1: 0.833, 2: 0.0, 3: 0.806, 4: 0.0, 5: 0.025, 6: 0.0,
    }
    summary = mean_average_precision(scores).first()
    assert summary.n_queries == 6
    assert summary.mean_average_precision == pytest.approx((0.833 + 0.806 + 0.025) / 6)


def test_no_common_document(spark):
    truth = truths(spark, {1: range(1000, 1094)})
    scores = average_precision(truth, rankings(spark, {1: range(100)}))
    assert scores.first().ap == 0.0


def test_cosine_by_hand(spark):
    value = cosine(F.lit(10.0), F.lit(4.0), F.lit(38.0))
    row = spark.range(1).select(F.round(value, 5), cosine(F.lit(0.0), F.lit(0.0), F.lit(1.0)))
    assert tuple(row.first()) == (0.81111, None)


def test_evaluate(spark, body, titles):
    rows = [(1, "rubber duck", 3), (1, "rubber duck", 5), (2, "nothing known", 1)]
    qrels = spark.createDataFrame(rows, "query_id int, query_text string, doc_id bigint")
    scores = evaluate(body, titles, qrels, stopwords=MINI_STOP)
    found = {r.query_id: (r.n_hits, r.ap) for r in scores.collect()}
    assert found == {1: (2, 0.5), 2: (0, 0.0)}


@pytest.mark.parametrize("spread", [None, "item"])
def test_top_per_group(spark, spread):
    rows = [(g, i, (i * 37) % 101) for g in range(3) for i in range(300)]
    table = spark.createDataFrame(rows, "g int, item int, v int")
    order = [F.desc("v"), F.asc("item")]
    got = top_per_group(table, "g", order, 5, spread=spread).collect()
    ordered = sorted(((v, i) for g, i, v in rows if g == 0), key=lambda r: (-r[0], r[1]))
    expected = [(g, n + 1, i, v) for g in range(3) for n, (v, i) in enumerate(ordered[:5])]
    assert sorted((r.g, r["rank"], r.item, r.v) for r in got) == sorted(expected)


@pytest.fixture(scope="module")
def asked(spark):
    rows = [(1, [3, 1, 3]), (2, [3, 2]), (3, [])]
    return id_list(spark.createDataFrame(rows, "req_id int, ids array<bigint>"))


def ranks_file(spark, tmp_path, rows):
    path = tmp_path / "ranks.csv"
    path.write_text("".join(f"{i},{r}\n" for i, r in rows))
    return tables.scan_pagerank(spark, str(path))


def test_pagerank(spark, asked, tmp_path):
    ranks = ranks_file(spark, tmp_path, [(1, 0.5), (3, 0.25), (3, 0.9)])
    first = get_pagerank(asked.filter("req_id = 1"), ranks).collect()
    assert [(r.id, r["rank"]) for r in first] == [(3, 0.25), (1, 0.5), (3, 0.25)]
    with pytest.raises(PySparkException, match="no rank for id 2"):
        get_pagerank(asked, ranks).collect()
    lenient = get_pagerank(asked.filter("req_id = 2"), ranks, strict=False).collect()
    assert [(r.id, r["rank"]) for r in lenient] == [(3, 0.25), (2, None)]


def test_pageview(spark, asked):
    views = spark.createDataFrame([(1, 10), (3, 7)], "id bigint, views bigint")
    found = get_pageview(asked, views).collect()
    assert [(r.req_id, r.views) for r in found] == [(1, 7), (1, 10), (1, 7), (2, 7)]


def test_qrels_round_trip(spark, tmp_path):
    rows = [("best movie", d) for d in (5, 9, 70_000)] + [('a "quoted" one', 1)]
    qrels = spark.createDataFrame(rows, "query_text string, doc_id bigint")
    path = str(tmp_path / "qrels")
    tables.write_qrels(qrels, path)
    found = tables.scan_qrels(spark, path)
    assert sorted(map(tuple, found.select("query_text", "doc_id").collect())) == sorted(rows)
    assert found.select("query_id").distinct().count() == 2


def test_qrels_in_one_object(spark, tmp_path):
    path = tmp_path / "truth.json"
    truth = {"one": [1, 2], "two": [3]}
    expected = {("one", 1), ("one", 2), ("two", 3)}
    path.write_text(json.dumps(truth))
    found = tables.scan_qrels(spark, str(path)).select("query_text", "doc_id")
    assert set(map(tuple, found.collect())) == expected
    path.write_text(json.dumps(truth, indent=1))
    whole = tables.scan_qrels(spark, str(path), whole_files=True)
    assert set(map(tuple, whole.select("query_text", "doc_id").collect())) == expected


@pytest.mark.parametrize("split", ["64b", "128m"])
def test_qrels_over_lines_in_splits(spark, tmp_path, split):
    odd = ["plain", "a ] b", "[x], [y]", 'say "]" twice ]]', "], ", "}{", "tab\t\\ ]", "ünï ] ✓", "last"]
    truth = {f"{text} {i}": [10 * i + k for k in range(i % 4)] for i, text in enumerate(odd * 3)}
    for name, indent in (("one.json", 2), ("two.json", None)):
        (tmp_path / name).write_text(json.dumps({f"{name} {q}": ids for q, ids in truth.items()}, indent=indent))
    (tmp_path / "empty.json").write_text("{}\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        found = tables.scan_qrels(spark, str(tmp_path), whole_files=True)
        rows = sorted(map(tuple, found.select("query_text", "doc_id").collect()))
        tasks = spark.read.option("lineSep", "]").text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    names = ("one.json", "two.json")
    assert rows == sorted((f"{n} {q}", i) for n in names for q, ids in truth.items() for i in ids)
    assert tasks > 20 or split == "128m"


def test_page_readers(spark):
    html = '<title>Home</title><a href="/x">to x</a> <a href="/y"></a><a href="/x">x</a>'
    pages = spark.createDataFrame([(1, "u", html)], "page_id int, url string, html string")
    assert tables.page_titles(pages).first().title == "Home"
    links = [tuple(r) for r in tables.anchor_source(pages).collect()]
    assert links == [("/x", "to x"), ("/y", ""), ("/x", "x")]

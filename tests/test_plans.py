"""Shapes of physical plans that matter on large data."""

import re

import pytest
from pyspark.sql import functions as F

from mini import MINI_STOP
from termloom.functions.text import BUILD_PATTERN
from termloom.operators.matching import match_postings
from termloom.operators.postings import document_frequency, word_count
from termloom.operators.ranking import top_per_group
from termloom.operators.query_terms import query_term_counts
from termloom.plans import search
from termloom.plans.build import _tokenised
from termloom.plans.search import body_scores, pair_weights, query_terms
from termloom.sources.tables import scan_documents

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def terms(body, queries):
    return query_terms(body, queries, pattern=BUILD_PATTERN, stopwords=MINI_STOP)


def test_counting_words_needs_no_shuffle(spark):
    docs = scan_documents(spark, f"{DATA}/documents.parquet", id_column="doc_id")
    text = plan(word_count(docs))
    assert "Exchange" not in text
    assert text.count("regexp_extract_all") == 1
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in text


def test_text_is_tokenised_once_per_write(spark, body, queries):
    docs = scan_documents(spark, f"{DATA}/documents.parquet", id_column="doc_id")
    assert plan(_tokenised(docs, body)).count("regexp_extract_all") == 1
    assert plan(query_term_counts(queries)).count("regexp_extract_all") == 1


def test_document_frequency_combines_before_its_shuffle(spark):
    docs = scan_documents(spark, f"{DATA}/documents.parquet", id_column="doc_id")
    text = plan(document_frequency(word_count(docs)))
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 1
    assert "partial_count" in text


def test_postings_are_pruned_by_bucket_and_stay_in_place(body, terms):
    wanted = terms.table.select("query_id", "term", "qtf", "df")
    text = plan(match_postings(body, wanted, terms.rows))
    assert "BroadcastHashJoin" in text
    assert "dynamicpruning" in text
    assert "hashpartitioning" not in text


def test_few_terms_reach_the_scan(body, terms):
    text = plan(pair_weights(body, terms))
    assert re.search(r"PushedFilters: \[.*In\(term, \[", text)


def test_scores_shuffle_pairs_once(body, terms):
    """By query and document: no query is gathered in one task before its cut."""
    text = plan(body_scores(body, terms))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(shuffles) == 1
    assert "query_id" in shuffles[0] and "doc_id" in shuffles[0]


def test_large_groups_are_cut_in_pieces_first(spark):
    table = spark.range(1000).selectExpr("id", "id % 3 AS g", "id % 9 AS v")
    text = plan(top_per_group(table, "g", [F.desc("v"), F.asc("id")], 5, spread="id"))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    assert len(shuffles) == 2
    assert sum("_piece" in s for s in shuffles) == 1
    assert text.count("WindowGroupLimit") >= 3


def test_hits_come_from_the_vocabulary_only(body):
    assert "GreaterThan(df,0)" in plan(body.vocabulary())
    text = plan(body.terms())
    assert "tf_bins" not in text


def test_matches_are_dealt_out_by_document(body, titles, queries, monkeypatch):
    """Beyond the rows of a task the wanted postings move once, before they are repeated for queries."""
    from termloom.operators import matching
    from termloom.sources import shared

    wanted = {}
    for rows in (None, 2):
        if rows:
            monkeypatch.setattr(shared, "TASK_ROWS", rows)
            monkeypatch.setattr(matching, "TASK_ROWS", rows)
        hits = search.index_hits(body, queries)
        found = search.search(body, titles, queries), search.search_body_cosine(body, titles, queries), hits
        text = plan(hits)
        wanted[rows] = [sorted(map(repr, f.collect())) for f in found]
        assert ("REPARTITION_BY_NUM" in text) == bool(rows)
    assert "hashpartitioning(query_id" not in text
    assert wanted[None] == wanted[2]


def test_all_pairs_of_a_query_do_not_meet_uncut(body, queries):
    terms = query_terms(body, queries, max_pairs=None)
    rows = search.candidates(body, terms, max_pairs=None)
    assert "Window" not in plan(rows.groupBy("query_id", "doc_id").agg(F.sum("w")))
    per_query = rows.groupBy("query_id").agg(F.max("ck").alias("last"), F.count("*").alias("n")).collect()
    assert per_query and all(r.last == r.n for r in per_query)

"""The registry: complete, and agreeing with its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module

DATA = Path("/root/testdata/sf0.001")
SAMPLE = [
    "add_documents_repeats", "append_anchors", "compact", "doc_matrix_dense", "evaluate",
    "evaluate_from_file", "in_vocabulary", "min_df_filter", "posting_lists_anchor", "scan_index",
    "scan_pagerank_repeats", "scan_qrels", "search", "search_all_pairs", "search_anchor_titled",
    "search_body_cosine", "search_few_pairs", "search_repeats", "search_title",
    "tokenize_no_stop_rare",
]


def test_names_agree():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())


def test_entry(spark):
    found = entry_module.entry(spark)
    assert found.columns == ["query_id", "rank", "doc_id", "title", "hits", "score"]
    assert found.count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, name):
    found = entry_module.queries()[name](spark, str(DATA))
    database = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        database.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    result = database.execute(entry_module.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(found.columns)
    expected = sorted(map(repr, result.fetchall()))
    assert expected == sorted(repr(tuple(r)) for r in found.select(*columns).collect())

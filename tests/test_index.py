"""The stored index: contents, appends, versions, removal."""

import pytest
from pyspark.sql import functions as F

from mini import MINI_STOP
from termloom import add_documents, build_index, delete_index, read_index
from termloom.operators import postings as ops
from termloom.plans import build as build_module
from termloom.plans import search
from termloom.plans.build import compact
from termloom.sources.index_store import drop_old_versions, index_exists
from termloom.streaming.append import append_stream

DF = dict(boat=2, dinghy=1, duck=3, food=1, life=1, pond=2, race=1, rubber=2)
TOTAL = dict(DF, duck=4, rubber=5)


def content(index):
    entries = sorted((r.term, r.doc_id, r.tf) for r in index.postings().collect())
    terms = sorted((r.term, r.df, r.term_total) for r in index.terms().collect())
    docs = sorted((r.doc_id, r.title or "", r.doc_len) for r in index.docs().collect())
    return entries, terms, docs, index.n_docs


def test_statistics(body):
    rows = body.terms().collect()
    assert {r.term: r.df for r in rows} == DF
    assert {r.term: r.term_total for r in rows} == TOTAL
    assert {r.doc_id: r.doc_len for r in body.docs().collect()} == {
        1: 4, 2: 4, 3: 6, 4: 2, 5: 1,
    }
    assert (body.n_docs, body.n_postings, body.max_df) == (5, 13, 3)


def test_stored_rows_equal_direct_count(body, mini):
    direct = ops.word_count(mini, stopwords=MINI_STOP)
    assert sorted(direct.collect()) == sorted(body.postings().collect())


def test_read_index(spark, body):
    again = read_index(spark, body.path)
    assert again == body
    assert content(again) == content(body)


def test_build_refuses_to_overwrite(body, mini):
    with pytest.raises(FileExistsError):
        build_index(mini, body.path)


def test_min_df(build, mini):
    index = build(mini, min_df=1)
    assert {r.term for r in index.terms().collect()} == {"boat", "duck", "pond", "rubber"}
    assert {r.term for r in index.postings().collect()} == {"boat", "duck", "pond", "rubber"}
    filtered = ops.min_df_filter(ops.word_count(mini, stopwords=MINI_STOP), 1)
    assert sorted(filtered.collect()) == sorted(index.postings().collect())


def test_hot_terms_are_cut_into_parts(build, mini, body):
    index = build(mini, part_rows=1)
    assert content(index) == content(body)
    placed = {(r.term, r.part) for r in index.posting_table().collect()}
    assert all(part < DF[term] for term, part in placed)
    known = {(r.term, r.part) for r in index.place(index.terms()).collect()}
    assert placed <= known


@pytest.mark.parametrize("entries", [0, 10**6, 880 * 10**6, 5 * 10**10])
def test_a_task_sorts_a_bounded_number_of_entries(entries):
    slices = build_module._slices(124, entries)
    assert slices % 124 == 0 and slices >= 124
    assert entries / slices <= 2_000_000


def test_slices_hold_the_same_index(build, mini, monkeypatch):
    whole = build(mini, buckets=2, part_rows=2)
    monkeypatch.setattr(build_module, "SLICE_ROWS", 2)
    sliced = build(mini, buckets=2, part_rows=2)
    assert content(sliced) == content(whole)
    places = [
        {(r.term, r.part, r.doc_id, r.bucket) for r in index.posting_table().collect()} for index in (whole, sliced)
    ]
    assert places[0] == places[1]
    assert len(sliced.posting_table().inputFiles()) > len(whole.posting_table().inputFiles())


@pytest.mark.parametrize("part_rows", [1, None])
def test_two_batches_equal_one(build, mini, part_rows):
    whole = build(mini, min_df=1, part_rows=part_rows)
    first = build(mini.filter("doc_id < 3"), min_df=1, part_rows=part_rows)
    both = add_documents(first, mini.filter("doc_id >= 3"))
    assert content(both) == content(whole)
    assert both.max_df == whole.max_df


def test_known_documents_are_left_out(build, mini):
    first = build(mini.filter("doc_id < 3"))
    assert content(add_documents(first, mini)) == content(build(mini))


def test_repeats_on_request(build, mini):
    index = add_documents(build(mini), mini.filter("doc_id = 5"), repeats=True)
    duck = index.terms().filter("term = 'duck'").first()
    assert (duck.df, duck.term_total) == (4, 5)
    assert index.postings().filter("term = 'duck' and doc_id = 5").count() == 2


def test_a_broken_append_stays_invisible(build, mini, monkeypatch):
    first = build(mini.filter("doc_id < 3"))
    before = content(first)

    def fail(index):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as broken:
        broken.setattr(build_module, "write_meta", fail)
        with pytest.raises(RuntimeError):
            add_documents(first, mini)
    assert content(read_index(first.spark, first.path)) == before
    assert content(add_documents(first, mini)) == content(build(mini))


def test_many_clashes_are_joined_not_broadcast(build, mini, monkeypatch):
    from termloom.sources import shared

    first = build(mini.filter("doc_id < 4"))
    monkeypatch.setattr(shared.broadcast_within, "__defaults__", (0,))
    assert content(add_documents(first, mini)) == content(build(mini))


def test_document_over_many_rows(build, spark):
    rows = [("a", "red red"), ("a", "red blue"), ("b", "blue")]
    index = build(spark.createDataFrame(rows, "doc_id string, text string"), single_row=False)
    entries, terms, docs, n_docs = content(index)
    assert entries == [("blue", "a", 1), ("blue", "b", 1), ("red", "a", 3)]
    assert terms == [("blue", 2, 2), ("red", 1, 3)]
    assert docs == [("a", "", 4), ("b", "", 1)]
    assert n_docs == 2


def test_empty_corpus(build, spark):
    index = build(spark.createDataFrame([], "doc_id bigint, text string"))
    assert content(index) == ([], [], [], 0)


def test_delete(build, spark, mini):
    index = build(mini)
    assert delete_index(spark, index.path)
    assert not index_exists(spark, index.path)
    assert not delete_index(spark, index.path)


def test_posting_lists(body):
    lists = ops.posting_lists(body.postings(), block_docs=2)
    duck = lists.filter("term = 'duck'").orderBy("block").collect()
    found = [[(p.doc_id, p.tf) for p in row.postings] for row in duck]
    assert found == [[(1, 1)], [(2, 2)], [(5, 1)]]
    whole = ops.posting_lists(body.postings()).filter("term = 'rubber'").collect()
    assert [[(p.doc_id, p.tf) for p in r.postings] for r in whole] == [[(1, 2), (3, 3)]]


def test_tf_bins_add_up(spark, build):
    rows = [(d, "word " * d) for d in range(1, 70)]
    index = build(spark.createDataFrame(rows, "doc_id bigint, text string"))
    row = index.term_table().first()
    assert row.tf_bins == [1, 2, 4, 8, 16, 38]
    assert sum(row.tf_bins) == row.df == 69


def test_stemmed_postings(spark):
    rows = [("ducks", 1, 2), ("duck", 1, 1), ("duck", 2, 1)]
    entries = spark.createDataFrame(rows, "term string, doc_id bigint, tf int")
    found = {(r.stem, r.doc_id, r.tf) for r in ops.stem_vocabulary(entries).collect()}
    assert found == {("duck", 1, 3), ("duck", 2, 1)}


def test_append_stream(spark, mini, build, tmp_path):
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    path = str(tmp_path / "index")
    settings = dict(stopwords=MINI_STOP, min_df=0, buckets=4)
    for part in (mini.filter("doc_id < 3"), mini.filter("doc_id >= 2")):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(mini.schema).parquet(source)
        append_stream(stream, path, checkpoint, **settings).awaitTermination()
    assert content(read_index(spark, path)) == content(build(mini))


def test_properties_on_documents(spark, build):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    index = build(docs.select("doc_id", "text"))
    totals = index.terms().agg(F.sum("df"), F.min(F.col("term_total") - F.col("df"))).first()
    assert totals[0] == index.n_postings == index.postings().count()
    assert totals[1] >= 0
    lengths = index.docs().agg(F.sum("doc_len")).first()[0]
    assert lengths == index.terms().agg(F.sum("term_total")).first()[0]


def asked(spark, text):
    return spark.createDataFrame([(1, text)], "query_id bigint, query_text string")


def test_a_document_added_again_is_one_document(build, mini, spark):
    once = build(mini)
    twice = add_documents(once, mini.filter("doc_id = 1"), repeats=True)
    assert twice.repeats and twice.n_docs == 5
    rows = search.search_body_cosine(twice, twice, asked(spark, "rubber duck")).collect()
    assert all(r.score <= 1.0 for r in rows) and len({r.doc_id for r in rows}) == len(rows)
    ranked = search.search(twice, twice, asked(spark, "rubber duck")).collect()
    assert [r.rank for r in ranked] == list(range(1, len(ranked) + 1))
    terms = search.query_terms(twice, asked(spark, "rubber duck"))
    pairs = [(r.doc_id, r.term) for r in search.candidates(twice, terms).collect()]
    assert len(set(pairs)) == len(pairs)


def test_an_id_given_twice_in_a_batch(build, mini, spark):
    rows = spark.createDataFrame([(7, "duck boat", None), (7, "duck", None)], mini.schema)
    index = build(mini.unionByName(rows))
    assert index.repeats and index.n_docs == 6
    hits = {r.doc_id: r.hits for r in search.index_hits(index, asked(spark, "duck boat")).collect()}
    assert hits[7] == 2
    docs = {r.doc_id: r.doc_len for r in index.docs().collect()}
    assert docs[7] == 3


def test_rows_of_a_document_in_two_batches(build, spark):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "doc_id string, text string")

    index = build(rows(("x", "rubber duck"), ("y", "duck")), single_row=False)
    index = add_documents(index, rows(("x", "duck"), ("z", "rubber")))
    assert {r.term: r.df for r in index.terms().collect()} == {"duck": 2, "rubber": 2}
    hits = {r.doc_id: r.hits for r in search.index_hits(index, asked(spark, "rubber duck")).collect()}
    assert hits == {"x": 2, "y": 1, "z": 1}
    whole = build(rows(("x", "rubber duck"), ("y", "duck"), ("x", "duck"), ("z", "rubber")), single_row=False)
    assert content(index) == content(whole) == content(compact(index))


def test_a_stream_batch_is_stored_once(build, spark):
    links = spark.createDataFrame([("x", "duck")], "doc_id string, text string")
    index = build(links, single_row=False, last_batch="s#0")
    assert add_documents(index, links, batch="s#0") is index
    more = add_documents(index, links, batch="s#1")
    assert read_index(spark, more.path).last_batch == "s#1"


def test_growth_brings_more_buckets(build, mini, spark, monkeypatch):
    for name, value in (("SMALL_BUCKET_ROWS", 20), ("PART_ROWS", 10)):
        monkeypatch.setattr(build_module, name, value)
    words = [(100 + i, " ".join(f"word{(i * 7 + k) % 40}" for k in range(8)), None) for i in range(60)]
    more = spark.createDataFrame(words, mini.schema)
    index = build(mini, buckets=None)
    assert index.buckets == 1
    grown = add_documents(index, more)
    assert grown.buckets > 4 and grown.base == grown.version
    whole = build(mini.unionByName(more))
    assert content(grown) == content(whole)
    drop_old_versions(grown)
    assert content(read_index(spark, grown.path)) == content(whole)
    assert content(add_documents(grown, mini)) == content(whole)


def test_many_batches_are_compacted(build, mini, monkeypatch):
    monkeypatch.setattr(build_module, "MAX_BATCHES", 3)
    index = build(mini.filter("doc_id = 1"))
    for i in range(2, 6):
        index = add_documents(index, mini.filter(f"doc_id = {i}"))
    assert index.version - index.base < 3
    assert content(index) == content(build(mini))


def test_documents_given_as_tokens(build, mini, spark):
    rows = [(1, ["Duck", "duck", None, "the"]), (2, None), (3, [])]
    index = build(spark.createDataFrame(rows, "doc_id bigint, tokens array<string>"))
    assert content(index)[0] == [("Duck", 1, 1), ("duck", 1, 1)]


def test_posting_lists_of_string_ids(build, spark):
    rows = spark.createDataFrame([("a", "red red"), ("b", "red")], "doc_id string, text string")
    lists = ops.posting_lists(build(rows).postings()).collect()
    entries = sorted((p.doc_id, p.tf) for r in lists for p in r.postings)
    assert entries == [("a", 2), ("b", 1)]


def test_no_index_where_there_is_nothing(spark, tmp_path):
    assert not index_exists(spark, str(tmp_path / "none"))


def test_an_append_writes_its_own_terms_only(build, mini, spark):
    def rows_written(index):
        return spark.read.parquet(f"{index.path}/terms/version={index.version}").count()

    index = build(mini)
    one = spark.createDataFrame([(50, "duck kayak", None)], mini.schema)
    more = add_documents(index, one)
    assert rows_written(more) == 2 and more.levels == ((0, 8), (1, 2))
    assert content(more) == content(build(mini.unionByName(one))) == content(read_index(spark, more.path))
    assert (more.max_df, more.n_postings) == (4, 15)
    bins = {r.term: r.tf_bins[:2] for r in more.term_table().collect()}
    assert bins["duck"] == [3, 1] and bins["kayak"] == [1, 0]
    drop_old_versions(more)
    assert content(read_index(spark, more.path)) == content(more)


def test_levels_of_like_size_are_merged(build, mini, spark):
    index = build(mini)
    parts = [(60 + i, f"duck canoe{i % 2}", None) for i in range(6)]
    sizes = []
    for part in parts:
        index = add_documents(index, spark.createDataFrame([part], mini.schema))
        sizes.append([rows for _, rows in index.levels])
        for larger, i in zip(sizes[-1], range(1, len(sizes[-1]))):
            assert larger > 2 * sum(sizes[-1][i:])
    assert max(map(len, sizes)) > 1
    assert content(index) == content(build(mini.unionByName(spark.createDataFrame(parts, mini.schema))))


def test_a_document_moves_to_another_bin(build, spark):
    def rows(*pairs):
        return spark.createDataFrame(pairs, "doc_id string, text string")

    many = [(f"d{i}", f"word{i} other{i}") for i in range(10)]
    index = build(rows(("x", "duck"), *many), single_row=False)
    index = add_documents(index, rows(("x", "duck")))
    assert len(index.levels) == 2
    duck = index.term_table().filter("term = 'duck'").first()
    assert (duck.df, duck.term_total, duck.tf_bins[:2]) == (1, 2, [0, 1])


def test_look_ups_in_levels_open_few_buckets(build, mini, spark):
    words = [(100 + i, " ".join(f"word{k}" for k in range(i, i + 8)), None) for i in range(30)]
    index = build(spark.createDataFrame(words, mini.schema), buckets=16)
    index = add_documents(index, mini.filter("doc_id = 5"))
    assert len(index.levels) == 2
    wanted = spark.createDataFrame([("duck", 1)], "term string, df bigint")
    side = F.broadcast(index.place(wanted).select("bucket", "term").filter("bucket >= 0"))
    joined = index.vocabulary().join(side, ["bucket", "term"])
    text = joined._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    assert [r.term for r in joined.collect()] == ["duck"]

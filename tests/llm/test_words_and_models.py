"""Toxicity, language, byte-level BPE."""

import base64
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from termloom.llm import bpe, language, queries, toxicity

DATA = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    lines = (line.split() for line in open(PATH, "rb"))
    ranks = {base64.b64decode(a): int(b) for a, b in lines}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@pytest.mark.parametrize("letters", ["ab", "thereand in", "é한字a'", "\U0001f600x y\n\t", "  \n"])
@pytest.mark.parametrize("size", [0, 1, 16, 17, 33, 300, 5000])
def test_bpe_equals_reference(reference, letters, size):
    pick = random.Random(size)
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    text = "".join(pick.choice(letters) for _ in range(size))
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_bpe_of_a_very_long_piece(reference):
    text = "ab" * 60_000 + "c" * 60_000
    assert bpe.Encoder(PATH, public_tokenizers.PATTERN).encode(text) == reference.encode_ordinary(text)


def test_bpe_cache_generations(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.Encoder(PATH, public_tokenizers.PATTERN)
    text = "aaba bbaa abab bcbc aaba cdcd aaba xyxyz bbaa"
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_bpe_round_trip(odd):
    coded = bpe.encode(odd, PATH, public_tokenizers.PATTERN, decoded="decoded")
    texts = sorted((t.text or "") for t in odd.collect())
    rows = coded.collect()
    assert sorted(bytes(r.decoded).decode() for r in rows) == texts
    again = bpe.decode(coded.select("doc_id", "ids"), PATH)
    assert sorted(bytes(r.decoded) for r in again.collect()) == sorted(bytes(r.decoded) for r in rows)
    assert "text" not in coded.columns and rows[0].score == "mine"


def test_bpe_of_an_empty_table(odd):
    assert bpe.encode(odd.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_query(spark, reference):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    for row in queries.op7_byte_bpe(spark, DATA).collect():
        assert row.n_tokens == len(reference.encode_ordinary(texts[row.doc_id]))


def test_risk_correction():
    """A word of toxic texts only gets a high score although most toxic texts are unlabelled."""
    pick = np.random.default_rng(0)
    toxic = np.column_stack([np.ones(200), pick.random((200, 3)) < 0.5, np.ones(200)])
    clean = np.column_stack([np.zeros(900), pick.random((900, 3)) < 0.5, np.ones(900)])
    hidden = np.column_stack([np.ones(100), pick.random((100, 3)) < 0.5, np.ones(100)])
    w = toxicity.nonnegative_pu(
        toxic.astype(np.float32), np.vstack([clean, hidden]).astype(np.float32), prior=0.1
    )
    assert toxicity.sigmoid(hidden @ w).min() > 0.5 > toxicity.sigmoid(clean @ w).max()


def test_toxicity_learns_only_toxic_labels(spark, docs_of):
    rows = [(i, "nice calm words" if i % 4 else "you awful bad words") for i in range(200)]
    labels = spark.createDataFrame(
        [(i, 1) for i in range(0, 100, 4)] + [(1, None), (2, 0)], "doc_id bigint, toxic int"
    )
    model = toxicity.fit(docs_of(rows), labels, prior=0.25)
    found = toxicity.predict(docs_of(rows), model).collect()
    assert all(r.predicted == (r.doc_id % 4 == 0) and 0 <= r.score <= 1 for r in found)


def test_toxicity_of_odd_texts(spark, odd):
    none = spark.createDataFrame([], "doc_id bigint, toxic int")
    model = toxicity.fit(odd, none)
    assert {r.score for r in toxicity.predict(odd, model).collect()} == {0.0}
    some = toxicity.fit(odd, spark.createDataFrame([(4, 1), (4, 0), (None, 1)], none.schema))
    rows = toxicity.predict(odd, some).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.predict(odd.limit(0), some).count() == 0


def test_toxicity_query_on_held_out_labels(spark):
    found = {r.doc_id: r for r in queries.op1_toxicity(spark, "/root/testdata/sf0.01").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()
    asked = [(found[r.doc_id].score, r.toxic) for r in labels if found[r.doc_id].held_out]
    toxic = [s for s, t in asked if t]
    clean = [s for s, t in asked if not t]
    better = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean)
    assert better / (len(toxic) * len(clean)) > 0.75
    assert sum(s >= 0.5 for s in clean) < 0.05 * len(clean)


def test_language_backs_off(spark, docs_of):
    rows = [(i, "the thing that they thought") for i in range(20)]
    others = docs_of([(100 + i, "der große schöne weg") for i in range(20)])

    model = language.fit(docs_of(rows).unionByName(others.withColumn("lang", F.lit("de"))))
    asked = docs_of([(1, "thoughtthing"), (2, "größe"), (3, "123 !"), (4, None), (5, "жук")])
    found = {r.doc_id: r for r in language.predict(asked, model).collect()}
    assert [found[i].lang_pred for i in range(1, 5)] == ["en", "de", "und", "und"]
    assert found[3].score == 0.0 and 0.5 < found[1].score <= 1
    assert found[5].lang_pred in ("de", "en")


def test_language_of_odd_texts(odd):
    model = language.fit(odd)
    rows = language.predict(odd, model).collect()
    assert len(rows) == odd.count()
    assert all((r.lang_pred == "und") == (r.score == 0) for r in rows)
    nothing = language.fit(odd.limit(0))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}


def test_language_query_on_held_out_texts(spark):
    rows = queries.op6_language_id(spark, DATA).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    right = [r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]
    assert sum(right) >= 0.95 * len(right) and len(rows) == len(truth)


def test_letters_are_those_of_the_jvm(spark):
    """Number signs are no letters; Python's word class takes them for some."""
    from termloom.llm.common import letter_words

    texts = ["\u00bd \u2461 \u2167", "a\u00bdb x_1y", "\u00e9t\u00e9 \u4e2d\u6587 \u0663ab", "", "don't 2nd \u02b0\u00aa"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select("text", F.regexp_extract_all("text", F.lit(r"\p{L}+"), F.lit(0)).alias("w")).collect()
    assert {r.text: r.w for r in rows} == {t: letter_words(t) for t in texts}


def test_a_text_without_letters_has_no_language(docs_of):
    from termloom.llm import language

    docs = docs_of([(i, "these are some plain words of one language") for i in range(1, 9)])
    asked = docs_of([(1, "\u00bd \u2461 \u2167"), (2, None), (3, "plain words"), (4, "12 % _")])
    found = {r.doc_id: (r.lang_pred, r.score) for r in language.predict(asked.select("doc_id", "text"), language.fit(docs)).collect()}
    assert [found[i][0] for i in (1, 2, 3, 4)] == ["und", "und", "en", "und"]
    assert language.predict(asked.select("doc_id", "text").limit(0), language.fit(docs)).count() == 0

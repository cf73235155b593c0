"""Tokenizing and counting against plain Python."""

import re
from collections import Counter

import pytest
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import functions as F

from porter import stem

from termloom.functions.stemmer import IRREGULAR, STEP_2, STEP_3, STEP_4, with_stem
from termloom.functions.text import (
    BUILD_PATTERN,
    QUERY_PATTERN,
    drop_words,
    term_counts,
    tokenize,
    total_count,
    with_terms,
    word_runs,
)
from termloom.functions.words import BUILD_STOPWORDS, CORPUS, ENGLISH

DATA = "/root/testdata/sf0.001"
PYTHON = {
    BUILD_PATTERN: re.compile(r"[#@\w](?:['\-]?\w){2,24}"),
    QUERY_PATTERN: re.compile(r"[#@\w](?:['\-]?\w){0,24}"),
}


def tokens_of(spark, text, pattern=BUILD_PATTERN):
    return spark.range(1).select(tokenize(F.lit(text), pattern)).first()[0]


@pytest.mark.parametrize("pattern", [BUILD_PATTERN, QUERY_PATTERN])
@pytest.mark.parametrize("table", ["documents", "conversations", "benchmark"])
def test_tokens_equal_python(spark, pattern, table):
    rows = spark.read.parquet(f"{DATA}/{table}.parquet").select(
        "text", tokenize(F.col("text"), pattern).alias("tokens")
    )
    for row in rows.collect():
        assert row.tokens == PYTHON[pattern].findall(row.text.lower())


def test_long_words_are_cut(spark):
    assert [len(t) for t in tokens_of(spark, "x" + 60 * "y")] == [25, 25, 11]


def test_marks_inside_words(spark):
    text = "Don't go: #spark @you state-of-the-art a bb ccc Café 中文字"
    build = ["don't", "#spark", "@you", "state-of-the-art", "ccc", "café", "中文字"]
    assert tokens_of(spark, text) == build
    assert set(tokens_of(spark, text, QUERY_PATTERN)) == {*build, "go", "a", "bb"}


@pytest.mark.parametrize("text", ["", "a b", "...", "one", "one two one two two"])
def test_term_counts_small(spark, text):
    tokens = tokenize(F.lit(text))
    counts = spark.range(1).select(term_counts(tokens)).first()[0]
    expected = Counter(PYTHON[BUILD_PATTERN].findall(text))
    assert [(c.term, c.tf) for c in counts] == sorted(expected.items())


def test_term_counts_equal_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = with_terms(docs.select("text"), "text", BUILD_PATTERN, ENGLISH)
    for row in rows.withColumn("total", total_count(F.col("terms"))).collect():
        words = [w for w in PYTHON[BUILD_PATTERN].findall(row.text.lower())]
        expected = Counter(w for w in words if w not in ENGLISH)
        assert {c.term: c.tf for c in row.terms} == expected
        assert row.total == expected.total()


def test_null_text_has_no_tokens(spark):
    assert tokens_of(spark, None) is None
    nothing = spark.range(1).select(F.lit(None).cast("string").alias("text"))
    assert with_terms(nothing, "text", BUILD_PATTERN, ENGLISH).first().terms == []


def test_stop_words_with_quotes(spark):
    row = spark.range(1).select(F.lit("don't won't back\\slash").alias("text"))
    terms = with_terms(row, "text", BUILD_PATTERN, ["don't", "back\\"]).first().terms
    assert [t.term for t in terms] == ["back", "slash", "won't"]


def test_drop_words_keeps_order_and_repeats(spark):
    tokens = F.split(F.lit("b the a b the c"), " ")
    kept = spark.range(1).select(drop_words(tokens, ["the", "c"])).first()[0]
    assert kept == ["b", "a", "b"]


def test_word_runs(spark):
    text = F.lit("Aaa bbb ccc ddd")
    row = spark.range(1).select(word_runs(tokenize(text), 3)).first()
    assert row[0] == ["aaa bbb ccc", "bbb ccc ddd"]
    short = spark.range(1).select(word_runs(tokenize(F.lit("aaa")), 3)).first()
    assert short[0] == []


def test_word_lists(spark):
    assert list(ENGLISH) == StopWordsRemover.loadDefaultStopWords("english")
    assert len(CORPUS) == 21
    assert set(BUILD_STOPWORDS) == set(ENGLISH) | set(CORPUS)


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "dies": "die", "cats": "cat",
    "feed": "feed", "agreed": "agre", "plastered": "plaster", "bled": "bled",
    "motoring": "motor", "sing": "sing", "conflated": "conflat", "sized": "size",
    "hopping": "hop", "falling": "fall", "fizzed": "fizz", "filing": "file",
    "happy": "happi", "enjoy": "enjoy", "sky": "sky", "relational": "relat",
    "rational": "ration", "digitizer": "digit", "radicalli": "radic", "vileli": "vile",
    "vietnamization": "vietnam", "operator": "oper", "hopefulness": "hope",
    "sensibiliti": "sensibl", "triplicate": "triplic", "formalize": "formal",
    "electrical": "electr", "goodness": "good", "adoption": "adopt", "revival": "reviv",
    "gyroscopic": "gyroscop", "replacement": "replac", "effective": "effect",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control",
    "roll": "roll", "geology": "geolog", "a": "a", "by": "by",
}


def test_stems(spark):
    assert {w: stem(w) for w in STEMS} == STEMS
    words = spark.createDataFrame([(w,) for w in STEMS], "term string")
    assert {r.term: r.stem for r in with_stem(words).collect()} == STEMS


def test_stems_of_any_word_equal_the_plain_algorithm(spark):
    """Every suffix on many beginnings, runs of y, signs, other alphabets, and the words of the tables."""
    beginnings = ["", "a", "b", "y", "yy", "by", "oyy", "tr", "ee", "hopp", "controll", "fizz", "crat", "siz", "été", "w-x", "y'y", "syzyg", "ox", "motor"]
    suffixes = {s for s, _ in (*STEP_2, *STEP_3)} | set(STEP_4)
    suffixes |= {"", "s", "ies", "sses", "ss", "ed", "ing", "ied", "eed", "y", "e", "ll", "logi", "alli", "ally", "er", "ationalli"}
    ends = ["", "s", "ed", "e", "y", "ing"]
    words = {b + s + e for b in beginnings for s in suffixes for e in ends} | set(IRREGULAR) | {"😀ing", "2nd", "x_y", "news"}
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.explode(tokenize(F.col("text"))).alias("term"))
    words |= {r.term for r in texts.distinct().collect()}
    rows = with_stem(spark.createDataFrame([(w,) for w in words], "term string")).collect()
    wrong = {(r.term, r.stem, stem(r.term)) for r in rows if r.stem != stem(r.term)}
    assert not wrong and len(rows) == len(words)

import pytest


def documents(spark, rows):
    """``(doc_id, text)`` pairs as a documents table."""
    full = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id bigint, text string, lang string, source string, n_chars bigint"
    )


@pytest.fixture(scope="session")
def docs_of(spark):
    return lambda rows: documents(spark, rows)


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, repeated and very long texts, a null id, and a column that clashes
    with names used inside."""
    from pyspark.sql import functions as F

    long = "word " * 40_000 + "end"
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, "one two three"), (4, "one two three"),
        (None, "lonely text of a null id"), (None, "lonely text of a null id"), (5, long),
        (6, "token = abcdefgh12345678 " * 30), (7, "あい\U0001f600 été  x"),
    ]
    made = documents(spark, rows)
    clashes = [
        "key", "node", "spans", "text_", "score", "_rank", "weight", "rank", "hash", "root", "_of", "_least",
        "_root", "_size", "_blank", "_id", "_node", "_text", "_k1", "_k2", "k1", "k2", "_base", "_more", "_live",
    ]
    return made.withColumns({name: F.lit("mine") for name in clashes})

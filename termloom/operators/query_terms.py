"""Query texts as rows of weighted terms."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.stemmer import with_stem
from termloom.functions.text import (
    QUERY_PATTERN,
    kept_terms,
    total_count,
    with_term_counts,
)
from termloom.functions.weights import query_weight
from termloom.functions.words import QUERY_STOPWORDS


def query_term_counts(
    queries: DataFrame,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    stem: bool = False,
) -> DataFrame:
    """``(query_id, query_text)`` to ``(query_id, term, qtf, query_len)``.

    ``query_len`` counts all kept words, known to the index or not.  An empty query
    gives no rows.  With ``stem`` the terms are the stems of the words that are no stop words.
    """
    texts = queries.select("query_id", "query_text")
    counted = with_term_counts(texts, "query_text", pattern)
    kept = kept_terms(stopwords)
    sized = counted.withColumn("query_len", total_count(kept))
    counts = sized.select("query_id", "query_len", F.inline(kept)).select(
        "query_id", "term", F.col("tf").cast("bigint").alias("qtf"), "query_len"
    )
    if not stem:
        return counts
    per_stem = with_stem(counts).groupBy("query_id", F.col("stem").alias("term"), "query_len")
    return per_stem.agg(F.sum("qtf").alias("qtf")).select("query_id", "term", "qtf", "query_len")


def in_vocabulary(query_terms: DataFrame, terms: DataFrame) -> DataFrame:
    """Keep the query terms the index knows, with the statistics in ``terms``."""
    keys = [k for k in ("bucket", "term") if k in query_terms.columns and k in terms.columns]
    return query_terms.join(terms, keys)


def query_tfidf(
    query_terms: DataFrame, n_docs: int, skip_zeros: bool = True
) -> DataFrame:
    """Add ``weight``, ``term_no`` and ``ord`` to query terms that have ``df``.

    ``term_no`` numbers the query's terms by name.  ``ord`` is the term's place in the
    query vector: the same, but with ``skip_zeros`` terms of weight zero come last.
    """
    weight = query_weight(F.col("qtf"), F.col("query_len"), n_docs, F.col("df"))
    weighted = query_terms.withColumn("weight", weight)
    in_query = Window.partitionBy("query_id")
    numbered = weighted.withColumn(
        "term_no", F.row_number().over(in_query.orderBy("term"))
    )
    if not skip_zeros:
        return numbered.withColumn("ord", F.col("term_no"))
    zeros_last = in_query.orderBy(F.col("weight") == 0, "term_no")
    return numbered.withColumn("ord", F.row_number().over(zeros_last))

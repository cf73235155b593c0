"""Scoring a ranking against known relevant documents."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.text import BUILD_PATTERN
from termloom.functions.words import QUERY_STOPWORDS
from termloom.plans.search import ranked
from termloom.sources.index_store import Index

# Fixed values of the evaluation: depth of the cut, and pairs considered per query.
DEPTH = 40
EVALUATION_PAIRS = 20_000


def cut_at_k(predicted: DataFrame, k: int = DEPTH) -> DataFrame:
    """The first ``k`` of ``predicted(query_id, rank, doc_id)`` per query."""
    return predicted.filter(F.col("rank") <= k)


def truth_membership(predicted: DataFrame, qrels: DataFrame) -> DataFrame:
    """Add ``hit``, 1 if the document is relevant to the query and 0 otherwise."""
    relevant = qrels.select("query_id", "doc_id").distinct()
    marked = relevant.withColumn("_relevant", F.lit(1))
    joined = predicted.join(marked, ["query_id", "doc_id"], "left")
    return joined.withColumn("hit", F.coalesce("_relevant", F.lit(0))).drop("_relevant")


def precision_at_hit(marked: DataFrame) -> DataFrame:
    """``(query_id, rank, doc_id, precision)`` at each relevant document."""
    so_far = (
        Window.partitionBy("query_id")
        .orderBy("rank")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    counted = marked.withColumn("hit_no", F.sum("hit").over(so_far))
    hits = counted.filter(F.col("hit") == 1)
    precision = F.col("hit_no") / F.col("rank")
    return hits.select("query_id", "rank", "doc_id", precision.alias("precision"))


def average_precision(
    qrels: DataFrame, predicted: DataFrame, k: int = DEPTH
) -> DataFrame:
    """``(query_id, n_hits, ap)`` for every query in ``qrels``.

    The mean is over the hits found, not over all relevant documents; a query without
    hits has 0.
    """
    precisions = precision_at_hit(truth_membership(cut_at_k(predicted, k), qrels))
    means = precisions.groupBy("query_id").agg(
        F.count("*").alias("n_hits"), F.avg("precision").alias("mean")
    )
    every = qrels.select("query_id").distinct().join(means, "query_id", "left")
    return every.select(
        "query_id",
        F.coalesce("n_hits", F.lit(0)).alias("n_hits"),
        F.round(F.coalesce("mean", F.lit(0.0)), 3).alias("ap"),
    )


def mean_average_precision(scores: DataFrame) -> DataFrame:
    """One row: the number of queries and the mean of their ``ap``."""
    return scores.agg(
        F.count("*").alias("n_queries"), F.avg("ap").alias("mean_average_precision")
    )


def predict(
    body: Index,
    titles: Index,
    qrels: DataFrame,
    *,
    pattern: str = BUILD_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    max_pairs: int = EVALUATION_PAIRS,
    **options,
) -> DataFrame:
    """Rank the queries of ``qrels(query_id, query_text, doc_id)`` as ``search`` does; titles are not looked up."""
    queries = qrels.select("query_id", "query_text").distinct()
    settings = dict(pattern=pattern, stopwords=stopwords, max_pairs=max_pairs)
    return ranked(body, titles, queries, skip_zeros=False, **settings, **options)[0]


def evaluate(
    body: Index, titles: Index, qrels: DataFrame, *, k: int = DEPTH, **options
) -> DataFrame:
    """``(query_id, n_hits, ap)``: average precision of every query in ``qrels``."""
    return average_precision(qrels, predict(body, titles, qrels, **options), k)

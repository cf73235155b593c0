"""Candidate weights, the two dot products, and scores."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from termloom.functions.weights import cosine, idf
from termloom.operators.postings import TF_EDGES
from termloom.operators.ranking import top_per_group
from termloom.sources.shared import broadcast_within

SCORE_DIGITS = 5


def with_floor(query_terms: DataFrame, k: int) -> DataFrame:
    """Add ``floor``, a weight that the best ``k`` pairs of the query all reach.

    It comes from counting, before any posting is read.  A pair in a ``tf`` bin weighs
    at least the bin's lower edge times idf.  Taking a query's bins from the heaviest
    down until they hold ``k`` pairs gives a weight that ``k`` pairs have at least, so
    no lighter pair is among the best ``k``.  With fewer than ``k`` pairs in all there
    is no floor.  A term in more documents than the corpus size given has a negative idf
    and no least weight.  ``reach`` is the most pairs of the query that can weigh
    ``floor`` or more.
    """
    lowest = F.lit(float("-inf"))
    fields = [c for c in query_terms.columns if c != "query_id"]
    per_query = query_terms.groupBy("query_id").agg(
        F.collect_list(F.struct(*fields)).alias("terms")
    )
    edges = F.array(*(F.lit(e) for e in TF_EDGES))
    bins = F.flatten(
        F.transform(
            "terms",
            lambda t: F.transform(
                t["tf_bins"],
                lambda n, i: F.struct(
                    (-F.when(t["idf"] < 0, lowest).otherwise(F.get(edges, i) * t["idf"]))
                    .alias("w"),
                    n.alias("n"),
                ),
            ),
        )
    )
    start = F.struct(F.lit(0).cast("bigint").alias("pairs"), lowest.alias("floor"))
    found = F.aggregate(
        F.sort_array(bins),
        start,
        lambda acc, b: F.struct(
            (acc["pairs"] + b["n"]).alias("pairs"),
            F.when((acc["pairs"] < k) & (acc["pairs"] + b["n"] >= k), -b["w"])
            .otherwise(acc["floor"])
            .alias("floor"),
        ),
        lambda acc: acc["floor"],
    )
    floored = per_query.select("query_id", "terms", found.alias("floor"))
    # A bin counts in full if its upper edge, the last one without end, can reach it.
    reach = F.aggregate(
        "terms",
        F.lit(0).cast("bigint"),
        lambda acc, t: acc
        + F.aggregate(
            F.filter(
                t["tf_bins"],
                lambda _, i: (i == len(TF_EDGES) - 1)
                | (t["idf"] < 0)
                | (F.get(edges, i + 1) * t["idf"] >= F.col("floor")),
            ),
            F.lit(0).cast("bigint"),
            lambda total, n: total + n,
        ),
    )
    return floored.select(
        "query_id", "floor", reach.alias("reach"), F.inline("terms")
    ).drop("tf_bins")


def without_floor(query_terms: DataFrame) -> DataFrame:
    """The columns of ``with_floor`` where no pair may be left out."""
    in_query = Window.partitionBy("query_id")
    return query_terms.withColumns(
        {
            "floor": F.lit(float("-inf")),
            "reach": F.sum("df").over(in_query).cast("bigint"),
        }
    ).drop("tf_bins")


def raw_tf_weights(matches: DataFrame, n_docs: int) -> DataFrame:
    """Replace ``tf`` by ``w``, which is ``tf * log10(N / df)``.

    Rows that carry a ``floor`` below which they cannot count are held against it.
    """
    weighted = matches.withColumn("w", F.col("tf") * _idf_of(matches, n_docs))
    if "floor" in matches.columns:
        weighted = weighted.filter(F.col("w") >= F.col("floor"))
    return weighted.drop("tf", "df", "idf", "qtf", "floor", "doc_len")


def _idf_of(rows: DataFrame, n_docs: int) -> Column:
    return F.col("idf") if "idf" in rows.columns else idf(n_docs, F.col("df"))


def norm_tf_weights(
    matches: DataFrame, docs: DataFrame, n_docs: int, rows: int | None = None
) -> DataFrame:
    """Replace ``tf`` by ``w``, which is ``(tf / doc_len) * log10(N / df)``.

    Matches that carry their document's length need no join.  Otherwise, if their number
    is known and small, the lengths are read in place.
    """
    weight = (F.col("tf") / F.col("doc_len")) * _idf_of(matches, n_docs)
    if "doc_len" in matches.columns:
        return matches.withColumn("w", weight).drop("tf", "df", "idf", "qtf", "doc_len")
    side = matches if rows is None else broadcast_within(matches, rows)
    joined = docs.select("doc_id", "doc_len").join(side, "doc_id")
    return joined.withColumn("w", weight).drop("tf", "df", "idf", "qtf", "doc_len")


def top_candidates(
    weights: DataFrame, k: int | None, reach: int | None = None, term: str = "term"
) -> DataFrame:
    """The ``k`` best pairs of each query, or all of them, numbered by ``ck``.

    ``term`` is a column that orders a query's terms by name.  ``reach`` bounds the
    pairs per query if it is known; a small one is cut in one step.
    """
    order = [F.desc("w"), F.asc(term), F.asc("doc_id")]
    if k is None:
        return weights.withColumn("ck", F.row_number().over(Window.partitionBy("query_id").orderBy(*order)))
    spread = None if reach is not None and reach <= 10 * k else "doc_id"
    return top_per_group(weights, "query_id", order, k, rank="ck", spread=spread)


def sparse_rows(weights: DataFrame, term: str = "term_no") -> DataFrame:
    """Nonzero pairs with ``ord``, the pair's place in its document by weight."""
    in_doc = Window.partitionBy("query_id", "doc_id").orderBy(F.desc("w"), F.asc(term))
    nonzero = weights.filter(F.col("w") != 0)
    return nonzero.withColumn("ord", F.row_number().over(in_doc))


def doc_matrix_sparse(rows: DataFrame) -> DataFrame:
    """One row per query and document with its weights in descending order.

    A document has at most one weight per query term, so the arrays stay short.
    """
    pairs = F.sort_array(F.collect_list(F.struct("ord", "w")))
    return rows.groupBy("query_id", "doc_id").agg(
        F.transform(pairs, lambda p: p["w"]).alias("weights")
    )


def doc_matrix_dense(weights: DataFrame, query_terms: DataFrame, rows: int) -> DataFrame:
    """One row per query and document: its weights by query term, zero where it lacks one.

    Both sides have ``term_no``, the query's terms in order.  ``rows`` bounds
    ``query_terms``.
    """
    sizes = query_terms.groupBy("query_id").agg(F.max("term_no").alias("n_terms"))
    found = weights.groupBy("query_id", "doc_id").agg(
        F.map_from_entries(F.collect_list(F.struct("term_no", "w"))).alias("found")
    )
    filled = F.transform(
        F.sequence(F.lit(1), F.col("n_terms")),
        lambda i: F.coalesce(F.try_element_at("found", i), F.lit(0.0)),
    )
    sized = found.join(broadcast_within(sizes, rows), "query_id")
    return sized.select("query_id", "doc_id", filled.alias("weights"))


def dot_positional(rows: DataFrame, query_vector: DataFrame) -> DataFrame:
    """Match the n-th query term by name with the document's n-th weight by size."""
    vector = query_vector.select("query_id", "ord", F.col("weight").alias("q"))
    return _dot(rows.join(vector, ["query_id", "ord"], "left"))


def dot_aligned(rows: DataFrame, query_vector: DataFrame) -> DataFrame:
    """Match query and document weights of the same term."""
    vector = query_vector.select("query_id", "term_no", F.col("weight").alias("q"))
    return _dot(rows.join(vector, ["query_id", "term_no"], "left"))


def _dot(pairs: DataFrame) -> DataFrame:
    """Dot product, number of pairs, and the document's best pair for breaking ties."""
    return pairs.groupBy("query_id", "doc_id").agg(
        F.coalesce(F.sum(F.col("q") * F.col("w")), F.lit(0.0)).alias("dot"),
        F.count("*").alias("coordination"),
        F.max("w").alias("best_w"),
        F.min(F.when(F.col("ord") == 1, F.col("term_no"))).alias("best_no"),
    )


def score_coordinated(dots: DataFrame) -> DataFrame:
    """Dot product times the number of nonzero weights, rounded."""
    value = F.round(F.col("dot") * F.col("coordination"), SCORE_DIGITS)
    return dots.withColumn("score", value)


def score_cosine(weights: DataFrame, query_vector: DataFrame) -> DataFrame:
    """Cosine over the query's terms, rounded; documents of zero norm drop out."""
    vector = query_vector.select(
        "query_id",
        "term_no",
        F.col("weight").alias("q"),
        F.sum(F.col("weight") * F.col("weight"))
        .over(Window.partitionBy("query_id"))
        .alias("q_norm2"),
    )
    sums = (
        weights.join(vector, ["query_id", "term_no"])
        .groupBy("query_id", "doc_id")
        .agg(
            F.sum(F.col("q") * F.col("w")).alias("dot"),
            F.sum(F.col("w") * F.col("w")).alias("d_norm2"),
            F.max("q_norm2").alias("q_norm2"),
        )
    )
    value = cosine(F.col("dot"), F.col("q_norm2"), F.col("d_norm2"))
    scored = sums.select(
        "query_id", "doc_id", F.round(value, SCORE_DIGITS).alias("score")
    )
    return scored.filter(F.col("score").isNotNull())

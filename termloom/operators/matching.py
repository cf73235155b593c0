"""Query terms meet postings, document lengths and titles."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from termloom.sources.index_store import Index, bucket_of
from termloom.sources.shared import (
    BROADCAST_ROWS,
    TASK_ROWS,
    broadcast_within,
    dealt_by,
    materialize,
    rows_up_to_limit,
)

# Up to this many query terms are also written into the scan's filter, where files sorted by
# term let whole row groups be passed over.
SCAN_TERMS = 10

# Queries served by one copy of a term's postings when both sides are shuffled.
QUERIES_PER_COPY = 100


def lookup_terms(index: Index, query_terms: DataFrame, rows: int) -> DataFrame:
    """Statistics for the rows of ``query_terms`` whose term is in the vocabulary.

    ``rows`` bounds the number of query rows; within the broadcast limit the term table
    is read by bucket and never shuffled.
    """
    bucket = bucket_of(F.col("term"), F.lit(0), index.buckets)
    placed = query_terms.withColumn("bucket", bucket).filter(F.col("qtf") > 0)
    side = broadcast_within(placed, rows)
    return index.vocabulary().join(side, ["bucket", "term"]).drop("bucket")


def least_tf() -> Column:
    """The smallest ``tf`` with which an entry of a term can reach its query's ``floor``."""
    # A little less than the quotient, as the product that is held against the floor is rounded.
    quotient = F.ceil(F.col("floor") / F.col("idf") * (1 - 1e-9)).cast("int")
    bounded = (F.col("idf") > 0) & (F.col("floor") > 0)
    return F.greatest(F.lit(1), F.when(bounded, quotient).otherwise(1))


def _least_of(index: Index, places: DataFrame) -> Column:
    # Of several entries, or those of a stem's words, one says nothing about their sum.
    summed = index.by_stem or index.scattered
    return least_tf() if "floor" in places.columns and not summed else F.lit(1)


def match_postings(index: Index, query_terms: DataFrame, rows: int, n_pairs: int = 0) -> DataFrame:
    """Join ``query_terms`` (with ``df``) to the index's postings.

    The small side is one row per query, term and part of the term (by stem: of each of its words).  It is broadcast
    when ``rows``, the number of such rows, is within the limit, and postings then stay
    where they are.  A few terms also go into the scan's filter; with a ``floor``, so does the least ``tf`` that reaches it,
    and blocks of lighter entries are not opened.  Otherwise both sides are shuffled; see ``_shuffled_match``.

    ``n_pairs`` is the number of matches if it is known.  A file's postings may match many times their number; beyond
    ``TASK_ROWS`` the wanted postings are moved once, by document, to as many tasks as the matches need.  What is
    then grouped by query and document is in place.
    """
    # Always true, but it marks the side as selective, so that the planner prunes the
    # scan to the buckets on that side.
    places = index.place(query_terms).filter(F.col("qtf") > 0)
    # In an index of one batch the terms asked for are none of its rare ones.
    one_batch = index.version == index.base and not index.by_stem
    postings = index.posting_table(rare=False if one_batch else None)
    if index.repeats or not index.single_row:
        postings = postings.drop("doc_len")
    word = "variant" if index.by_stem else "term"
    postings = postings.withColumnRenamed("term", word)
    if rows <= SCAN_TERMS:
        few = places.groupBy(word).agg(F.min(_least_of(index, places))).collect()
        postings = postings.filter(F.col(word).isin([term for term, _ in few]))
        if any(tf > 1 for _, tf in few):
            heavy = ((F.col(word) == term) & (F.col("tf") >= tf) for term, tf in few)
            postings = postings.filter(reduce(Column.__or__, heavy))
    keys = ["bucket", word, "part"]
    if rows <= BROADCAST_ROWS:
        if n_pairs > TASK_ROWS:
            least = F.min(_least_of(index, places)).alias("least")
            wanted = postings.join(F.broadcast(places.groupBy(*keys).agg(least)), keys)
            wanted = wanted.filter(F.col("tf") >= F.col("least")).drop("least")
            postings = dealt_by(wanted, "doc_id", n_pairs)
        matches = postings.join(F.broadcast(places), keys)
    else:
        matches = _shuffled_match(postings, places, keys)
    matches = matches.drop("bucket", "part", "variant")
    if index.scattered or index.by_stem:
        # One weight per query, term and document, whatever the number of entries.
        others = [c for c in matches.columns if c != "tf"]
        matches = matches.groupBy(*others).agg(F.sum("tf").cast("int").alias("tf"))
    return matches


def _shuffled_match(postings: DataFrame, places: DataFrame, keys: list[str]) -> DataFrame:
    """Join on term and part, so that a term in many documents is many keys.

    A term in many queries gets a number of copies of its postings, each for
    ``QUERIES_PER_COPY`` of the queries, which bounds the work of a key on both sides.
    """
    n_copies = F.ceil(F.count("*") / QUERIES_PER_COPY).cast("int").alias("n_copies")
    asked_for = materialize(places.groupBy(*keys).agg(n_copies), "wanted-terms")
    # Far fewer than the query terms: where they can be broadcast, only their postings move.
    distinct = broadcast_within(asked_for.select(*keys), rows_up_to_limit(asked_for))
    postings = postings.join(distinct, keys, "left_semi")
    wanted = asked_for.filter(F.col("n_copies") > 1)
    wanted = broadcast_within(wanted, rows_up_to_limit(wanted))
    copies = F.coalesce("n_copies", F.lit(1))
    some_copy = F.pmod(F.xxhash64("query_id"), copies).cast("int")
    every_copy = F.explode(F.sequence(F.lit(0), copies - 1))
    asked = places.join(wanted, keys, "left").withColumn("copy", some_copy)
    copied = postings.join(wanted, keys, "left").withColumn("copy", every_copy)
    joined = copied.drop("n_copies").join(asked.drop("n_copies"), [*keys, "copy"])
    return joined.drop("copy")


def hit_counts(matches: DataFrame) -> DataFrame:
    """Number of query words, with repeats, that each matched document contains."""
    return matches.groupBy("query_id", "doc_id").agg(F.sum("qtf").alias("hits"))


def with_titles(results: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``title``; a document without one stays, with a null."""
    return results.join(docs.select("doc_id", "title"), "doc_id", "left")


def with_titles_strict(results: DataFrame, docs: DataFrame) -> DataFrame:
    """Add ``title``, dropping results whose document has none."""
    titles = docs.select("doc_id", "title").filter(F.col("title").isNotNull())
    return results.join(titles, "doc_id")

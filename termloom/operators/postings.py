"""Postings and the statistics of terms and documents, from document rows."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from termloom.functions.stemmer import with_stem
from termloom.functions.text import BUILD_PATTERN, kept_terms, with_term_counts
from termloom.functions.words import BUILD_STOPWORDS
from termloom.sources.shared import broadcast_within, materialize, rows_up_to_limit

# A posting list is given out in blocks of this many neighbouring document ids, so one
# array never holds more entries than that, however frequent the term.
BLOCK_DOCS = 65_536

# Lower ends of the bins in which the documents of a term are counted by ``tf``.
TF_EDGES = (1, 2, 4, 8, 16, 32)


def word_count(
    docs: DataFrame,
    pattern: str = BUILD_PATTERN,
    stopwords: Sequence[str] = BUILD_STOPWORDS,
) -> DataFrame:
    """``(doc_id, text)`` to ``(term, doc_id, tf)``, one row per term of a document row.

    Counting happens inside the row; there is no shuffle.
    """
    counted = with_term_counts(docs.select("doc_id", "text"), "text", pattern)
    entries = counted.select("doc_id", F.inline(kept_terms(stopwords)))
    return entries.select("term", "doc_id", "tf")


def merge_counts(postings: DataFrame) -> DataFrame:
    """One row per term and document when a document is spread over several rows."""
    return postings.groupBy("term", "doc_id").agg(F.sum("tf").cast("int").alias("tf"))


def document_frequency(postings: DataFrame) -> DataFrame:
    """Number of documents per term."""
    return postings.groupBy("term").agg(F.count("*").alias("df"))


def term_total(postings: DataFrame) -> DataFrame:
    """Number of occurrences per term."""
    return postings.groupBy("term").agg(F.sum("tf").alias("term_total"))


def doc_length(postings: DataFrame) -> DataFrame:
    """Number of kept words per document."""
    return postings.groupBy("doc_id").agg(F.sum("tf").alias("doc_len"))


def vocabulary_size(terms: DataFrame) -> DataFrame:
    return terms.agg(F.count("*").alias("n_terms"))


def corpus_size(docs: DataFrame) -> DataFrame:
    return docs.agg(F.count("*").alias("n_docs"))


def term_statistics(
    rows: DataFrame, keys: Sequence[str] = ("term",), merge: bool = False
) -> DataFrame:
    """``df``, ``term_total`` and ``tf_bins`` per term, in one combining aggregate.

    ``tf_bins[i]`` is the number of documents whose ``tf`` is at least ``TF_EDGES[i]``
    and below the next edge.  ``rows`` are postings, or with ``merge`` such statistics.
    """
    if merge:
        bins = [F.sum(F.col("tf_bins")[i]) for i in range(len(TF_EDGES))]
        sizes = [F.sum("df").alias("df"), F.sum("term_total").alias("term_total")]
    else:
        tf, uppers = F.col("tf"), (*TF_EDGES[1:], None)
        inside = [
            (tf >= low) & (tf < high) if high else tf >= low
            for low, high in zip(TF_EDGES, uppers)
        ]
        bins = [F.count_if(condition) for condition in inside]
        sizes = [F.count("*").alias("df"), F.sum("tf").alias("term_total")]
    return rows.groupBy(*keys).agg(*sizes, F.array(*bins).alias("tf_bins"))


def numbered(rows: DataFrame, key: str, order: str) -> DataFrame:
    """``rows`` with ``place``, the number from 0 of a row among those of its key by ``order``.

    Rows are dealt out by ranges of key and order and written.  A row's place is the one it has in its range
    after the rows that its key has in earlier ranges; so a key in very many rows is in many tasks.
    """
    ranged = rows.repartitionByRange(key, order).withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged, "ranges")
    sizes = ranged.groupBy(key, "_range").agg(F.count("*").alias("_size"))
    earlier = Window.partitionBy(key).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(key, "_range", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    inside = F.row_number().over(Window.partitionBy(key, "_range").orderBy(order)) - 1
    placed = ranged.withColumn("_inside", inside).join(starts, [key, "_range"])
    return placed.select(*rows.columns, (F.col("_start") + F.col("_inside")).alias("place"))


def posting_lists(postings: DataFrame, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``(term, block, n, postings)`` with the entries of a block sorted by document.

    The blocks of a term in order are its whole list.  Whole-number ids are cut into ranges of ``block_docs``;
    of string ids, so many neighbours make a block, and a term has as many blocks as its entries need.
    """
    if isinstance(postings.schema["doc_id"].dataType, StringType):
        postings = numbered(postings.select("term", "doc_id", "tf"), "term", "doc_id")
        block = F.floor(F.col("place") / block_docs)
    else:
        block = F.floor(F.col("doc_id") / block_docs)
    entry = F.struct("doc_id", "tf")
    return postings.groupBy("term", block.alias("block")).agg(
        F.count("*").alias("n"), F.sort_array(F.collect_list(entry)).alias("postings")
    )


def with_parts(entries: DataFrame, frequencies: DataFrame, part_rows: int) -> DataFrame:
    """Add ``part``, zero but for terms in more than ``part_rows`` documents: theirs is drawn from the document.

    ``hot_df`` is the frequency of such terms, null for others.
    """
    hot = frequencies.filter(F.col("df") > part_rows)
    hot = hot.select("term", F.ceil(F.col("df") / part_rows).cast("int").alias("n_parts"), F.col("df").alias("hot_df"))
    hot = broadcast_within(hot, rows_up_to_limit(hot))
    part = F.pmod(F.xxhash64("doc_id"), F.coalesce("n_parts", F.lit(1))).cast("int")
    return entries.join(hot, "term", "left").withColumn("part", part).drop("n_parts")


def min_df_filter(postings: DataFrame, min_df: int) -> DataFrame:
    """Keep the entries of terms found in more than ``min_df`` documents.

    The entries are written once, and counted and filtered from there.
    """
    postings = materialize(postings, "entries")
    return drop_rare(postings, document_frequency(postings), min_df)


def append_postings(old: DataFrame, new: DataFrame) -> DataFrame:
    """Multiset union: an entry present on both sides stays twice."""
    return old.unionByName(new)


def stem_vocabulary(postings: DataFrame) -> DataFrame:
    """``(stem, doc_id, tf)``: postings merged by the stem of their term.

    A distinct term is stemmed once.
    """
    stems = materialize(with_stem(postings.select("term").distinct()), "stems")
    joined = by_term(postings, stems, "inner")
    return joined.groupBy("stem", "doc_id").agg(F.sum("tf").alias("tf"))


def drop_rare(tokens: DataFrame, frequencies: DataFrame, min_df: int) -> DataFrame:
    """Keep the rows of ``tokens(.., term)`` whose ``df`` in ``frequencies(term, df)`` exceeds ``min_df``."""
    frequent = frequencies.filter(F.col("df") > min_df).select("term")
    return by_term(tokens, materialize(frequent, "frequent-terms"), "left_semi")


def by_term(rows: DataFrame, terms: DataFrame, how: str) -> DataFrame:
    """Join rows to a written table with one row per term.

    A small table is broadcast.  A larger one is joined by shuffle as a plain table, and so are ``rows`` if they
    are a table: then the planner splits the partition of a term in very many rows, as the other side of such a
    key is one row.
    """
    return rows.join(broadcast_within(terms, rows_up_to_limit(terms)), "term", how)


def term_documents(tokens: DataFrame) -> DataFrame:
    """Number of documents per term, from rows ``(doc_id, .., term)`` that may repeat both."""
    return document_frequency(tokens.select("term", "doc_id").distinct())

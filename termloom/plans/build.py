"""Building an index and appending to it."""

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from termloom.functions.stemmer import with_stem
from termloom.functions.text import BUILD_PATTERN, total_count, with_terms
from termloom.functions.words import BUILD_STOPWORDS
from termloom.operators.postings import merge_counts, term_statistics, with_parts
from termloom.sources.index_store import (
    Index,
    bucket_of,
    id_type_of,
    index_exists,
    write_docs,
    write_documents,
    write_meta,
    write_postings,
    write_terms,
)
from termloom.sources.shared import (
    broadcast_within,
    dealt_by,
    materialize,
    rows_up_to_limit,
    spread_rows,
)

# Terms in at most this many documents are left out of the vocabulary,
# and the postings of an index of ordinary size go to this many buckets.
MIN_DF = 50
BUCKETS = 124

SMALL_BUCKET_ROWS = 100_000  # entries per bucket below which fewer buckets are made
LARGE_BUCKET_ROWS = 20_000_000  # entries per bucket above which more buckets are made
MAX_BUCKETS = 16_384
SLICE_ROWS = 1_500_000  # entries that a task sorts into a file, some 500 MB; above, a bucket gets more files
MAX_SLICES = 300_000  # tasks that write a batch's postings at most; larger batches have larger files
PART_ROWS = 1_000_000  # entries per part of a term
MAX_HOT_TERMS = 100_000  # most terms that may have more than one part
DOC_BUCKET_ROWS = 100_000  # documents per bucket of the table that titles are read from
LEVEL_RATIO = 2  # a level of statistics is more than so many times larger than those after it
MAX_BATCHES = 100  # batches an index may have before they are rewritten as one


def build_index(
    docs: DataFrame,
    path: str,
    *,
    pattern: str = BUILD_PATTERN,
    stopwords: Sequence[str] = BUILD_STOPWORDS,
    min_df: int = MIN_DF,
    buckets: int | None = None,
    part_rows: int | None = None,
    single_row: bool = True,
    stem: bool = False,
    last_batch: str = "",
) -> Index:
    """Index ``docs(doc_id, text[, title])`` under ``path``.

    Instead of ``text`` the documents may have ``tokens``, an array of words that are
    taken as they are.  Rows with the same id are one document.  The text is tokenised once, into the ``documents`` table; terms and postings come
    from that table.  ``single_row=False`` is for inputs where a document's text is
    spread over many rows, such as the anchors that point to it.  ``stem=True`` stores statistics by stem
    beside those by term; ``Index.stemmed()`` is the index by stem, over the same postings.
    """
    spark = docs.sparkSession
    path = path.rstrip("/")
    if index_exists(spark, path):
        raise FileExistsError(f"there is an index under {path}")
    draft = Index(
        spark=spark,
        path=path,
        version=0,
        n_docs=0,
        n_postings=0,
        max_df=0,
        min_df=min_df,
        pattern=pattern,
        stopwords=tuple(stopwords),
        buckets=buckets or 0,
        part_rows=part_rows or 0,
        single_row=single_row,
        id_type=id_type_of(docs),
        fixed_sizes=bool(buckets and part_rows),
        last_batch=last_batch,
        stem=stem,
    )
    return _store_batch(draft, _tokenised(docs, draft), None)


def add_stems(index: Index) -> Index:
    """Store statistics by stem beside an index that has none; its postings stay as they are."""
    if index.stem:
        return index
    index = _changed(index, stem=True)
    _write_stems(index)
    write_meta(index)
    return index


def add_documents(
    index: Index, docs: DataFrame, *, repeats: bool = False, batch: str = ""
) -> Index:
    """Append ``docs`` to a stored index and return the new version.

    Documents already in the index are left out; ``repeats=True`` adds them again, with
    second entries and raised document frequencies, and searches then sum a document's
    entries of a term.  An index of documents spread over rows takes further rows.
    ``batch`` names the batch of a stream: one that was stored last is not stored again.

    An index that has outgrown its buckets, or has very many batches, is compacted.
    """
    if batch and batch == index.last_batch:
        return index
    if not repeats and index.single_row:
        docs = _without_known(docs, index)
    draft = _changed(
        index,
        version=index.version + 1,
        repeats=index.repeats or (repeats and index.single_row),
        last_batch=batch,
    )
    stored = _store_batch(draft, _tokenised(docs, draft), index)
    return compact(stored) if _outgrown(stored) else stored


def compact(index: Index) -> Index:
    """Rewrite all batches as one, with sizes chosen for what there is now.

    Nothing is tokenised again.  ``drop_old_versions`` removes the earlier batches.
    """
    number = index.version + 1
    sizes = {} if index.fixed_sizes else dict(buckets=0, part_rows=0)
    draft = _changed(index, version=number, base=number, **sizes)
    return _store_batch(draft, index.forward().drop("batch"), None)


def _outgrown(index: Index) -> bool:
    if index.version - index.base >= MAX_BATCHES:
        return True
    wanted = _with_sizes(_changed(index, buckets=0, part_rows=0), index.n_postings)
    grown = wanted.buckets >= 2 * index.buckets or wanted.part_rows >= 2 * index.part_rows
    return grown and not index.fixed_sizes


def _store_batch(draft: Index, rows: DataFrame, old: Index | None) -> Index:
    batch = draft.version
    seen = Observation()
    rows = rows.observe(
        seen,
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.size("terms").cast("bigint")), F.lit(0)).alias("entries"),
    )
    write_documents(rows, draft.path, batch)
    added = draft.forward().filter(F.col("batch") == batch)
    if batch == draft.base:
        draft = _changed(draft, doc_buckets=_doc_buckets(seen.get["rows"]))
    described = added.select("doc_id", "title", "doc_len")
    write_docs(described, draft.path, batch, draft.doc_buckets, draft.single_row)
    if draft.single_row and not draft.repeats:
        again = draft.doc_table().agg(F.max("n_rows")).first()[0]
        draft = _changed(draft, repeats=(again or 0) > 1)
    if not draft.buckets or not draft.part_rows:
        draft = _with_sizes(draft, seen.get["entries"])

    entries = added.select("doc_id", "doc_len", F.inline("terms"))
    if not draft.single_row:
        merged = merge_counts(entries)
        entries = materialize(merged.withColumn("doc_len", F.lit(None).cast("bigint")), "entries")
    draft, totals = _store_level(term_statistics(entries) if old is None else _additions(entries, draft, old), draft, old)
    if draft.single_row and not draft.repeats:
        n_docs = seen.get["rows"] + (old.n_docs if old else 0)
    else:
        n_docs = draft.docs().count()
    draft = _changed(draft, n_docs=n_docs, **totals)
    slices = _slices(draft.buckets, seen.get["entries"])
    parted = _with_parts(entries, draft)
    write_postings(parted, draft.path, batch, draft.buckets, slices, draft.min_df)
    if draft.stem:
        _write_stems(draft)
    write_meta(draft)
    return draft


def _doc_buckets(rows: int) -> int:
    return max(1, min(MAX_BUCKETS, rows // DOC_BUCKET_ROWS))


def _slices(buckets: int, entries: int) -> int:
    """In how many slices a batch's entries are sorted and written; a multiple of ``buckets``."""
    each = math.ceil(entries / (buckets * SLICE_ROWS))
    return buckets * max(1, min(each, MAX_SLICES // buckets))


def _write_stems(index: Index) -> None:
    """Statistics by stem, from those by term and from the postings of stems with several terms.

    Documents with several terms of a stem count once for it, so these terms' postings are merged; a stem
    of one term takes the term's statistics.
    """
    terms = materialize(with_stem(index.term_table().drop("bucket")), "stems")
    variant = F.struct("term", "df")
    families = terms.groupBy("stem").agg(F.sort_array(F.collect_list(variant)).alias("variants"))
    families = materialize(families, "stem-families")
    single = families.filter(F.size("variants") == 1).join(terms.drop("term"), "stem")
    words = families.filter(F.size("variants") > 1).select("stem", F.inline("variants"))
    words = materialize(words.select("stem", "term"), "stem-words")
    words = broadcast_within(words, rows_up_to_limit(words))
    entries = index.posting_table().select("term", "doc_id", "tf").join(words, "term")
    entries = dealt_by(entries.select("stem", "doc_id", "tf"), "doc_id", index.n_postings)
    merged = entries.groupBy("stem", "doc_id").agg(F.sum("tf").alias("tf"))
    several = term_statistics(merged, ["stem"]).join(families, "stem")
    columns = ["stem", "df", "term_total", "tf_bins", "variants"]
    rows = single.select(columns).unionByName(several.select(columns)).withColumnRenamed("stem", "term")
    bucket = bucket_of(F.col("term"), F.lit(0), index.buckets)
    write_terms(rows.withColumn("bucket", bucket), index.path, index.version, index.buckets, "stems")


def _additions(entries: DataFrame, draft: Index, old: Index) -> DataFrame:
    """What a batch's entries add to the statistics of their terms."""
    if draft.single_row:
        return term_statistics(entries)
    # A document may have had the term before, so the terms are counted anew, and the additions are the
    # differences; a bin of ``tf`` that a document has left loses it.
    touched = materialize(entries.select("term").distinct(), "touched-terms")
    touched = broadcast_within(touched, rows_up_to_limit(touched))
    there = old.posting_table().join(touched, "term", "left_semi")
    both = there.select("term", "doc_id", "tf").unionByName(entries.select("term", "doc_id", "tf"))
    again = term_statistics(merge_counts(both))
    before = old.term_table().join(touched, "term", "left_semi")
    taken = before.select(
        "term",
        (-F.col("df")).alias("df"),
        (-F.col("term_total")).alias("term_total"),
        F.transform("tf_bins", lambda n: -n).alias("tf_bins"),
    )
    return term_statistics(again.unionByName(taken), merge=True)


def _store_level(added: DataFrame, draft: Index, old: Index | None) -> tuple[Index, dict]:
    """Write a batch's additions as a level, with the levels before it that are not much larger.

    A level is more than ``LEVEL_RATIO`` times as large as all after it together.  So there are few, a term's row
    is written again a few times in all, and the level of a large index stays where it is when a small batch comes.
    Returns the index with its levels, and its totals of entries.
    """
    levels, taken = list(old.levels if old else ()), []
    if old is not None:
        added = materialize(added, "additions")
        rows = added.count()
        while levels and levels[-1][1] <= LEVEL_RATIO * rows:
            taken.append(levels[-1][0])
            rows += levels.pop()[1]
    merged = added
    if taken:
        before = old.level_rows(taken).select(*added.columns)
        merged = term_statistics(added.unionByName(before), merge=True)
    bucket = bucket_of(F.col("term"), F.lit(0), draft.buckets)
    write_terms(merged.withColumn("bucket", bucket), draft.path, draft.version, draft.buckets)
    # Read back: a sum observed while writing would count a task that ran twice twice.
    written = draft.level_rows([draft.version])
    size = F.count("*").alias("rows")
    sums = F.coalesce(F.sum("df"), F.lit(0)).alias("n_postings")
    most = F.coalesce(F.max("df"), F.lit(0)).alias("max_df")
    totals = written.agg(size, sums, most).first().asDict()
    levels.append((draft.version, totals.pop("rows")))
    draft = _changed(draft, levels=tuple(levels))
    if old is not None:
        # Only terms of the batch can have become more frequent.
        touched = broadcast_within(added.select("term"), rows_up_to_limit(added))
        now = draft.term_table().join(touched, "term", "left_semi").agg(most).first()[0]
        more = added.agg(sums).first()[0]
        totals = {"n_postings": old.n_postings + more, "max_df": max(old.max_df, now)}
    return draft, totals


def _tokenised(docs: DataFrame, index: Index) -> DataFrame:
    title = F.col("title") if "title" in docs.columns else F.lit(None).cast("string")
    given = "tokens" if "tokens" in docs.columns else "text"
    rows = spread_rows(docs).select(
        F.col("doc_id").cast(index.id_type).alias("doc_id"), title.alias("title"), given
    )
    counted = with_terms(rows, given, index.pattern, index.stopwords)
    sized = counted.withColumn("doc_len", total_count(F.col("terms")))
    return sized.select("doc_id", "title", "doc_len", "terms")


def _with_sizes(draft: Index, n_entries: int) -> Index:
    few = max(1, min(BUCKETS, n_entries // SMALL_BUCKET_ROWS))
    scaled = max(few, min(MAX_BUCKETS, n_entries // LARGE_BUCKET_ROWS))
    # At most n / part_rows terms can have more than part_rows entries, so this choice
    # bounds the number of hot terms by MAX_HOT_TERMS.
    rows = max(PART_ROWS, n_entries // MAX_HOT_TERMS)
    return _changed(
        draft, buckets=draft.buckets or scaled, part_rows=draft.part_rows or rows
    )


def _with_parts(entries: DataFrame, index: Index) -> DataFrame:
    """Add ``part``: zero, but for hot terms a number drawn from the document id."""
    if index.max_df <= index.part_rows:
        return entries.withColumn("part", F.lit(0))
    return with_parts(entries, index.term_table(), index.part_rows)


def _without_known(docs: DataFrame, index: Index) -> DataFrame:
    """Drop documents the index has, moving only ids, not texts, where it can."""
    known = index.docs().select("doc_id")
    clashes = docs.select("doc_id").join(known, "doc_id", "left_semi").distinct()
    clashes = materialize(clashes, "clashes")
    clashes = broadcast_within(clashes, rows_up_to_limit(clashes))
    return docs.join(clashes, "doc_id", "left_anti")


def _changed(index: Index, **changes) -> Index:
    return Index(**{**index.__dict__, **changes})

"""The four searches, each over a whole table of queries."""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from termloom.functions.text import QUERY_PATTERN
from termloom.functions.weights import idf
from termloom.functions.words import QUERY_STOPWORDS
from termloom.operators.matching import (
    hit_counts,
    lookup_terms,
    match_postings,
    with_titles,
    with_titles_strict,
)
from termloom.operators.query_terms import query_term_counts, query_tfidf
from termloom.operators.ranking import top_per_group
from termloom.operators.scoring import (
    dot_aligned,
    dot_positional,
    norm_tf_weights,
    raw_tf_weights,
    score_coordinated,
    score_cosine,
    sparse_rows,
    top_candidates,
    with_floor,
    without_floor,
)
from termloom.sources.index_store import Index
from termloom.sources.shared import broadcast_within, materialize, rows_up_to_limit

# Results per query, and the (document, term) pairs a search considers.
MAX_RESULTS = 100
MAX_PAIRS = 18_000


@dataclass(frozen=True)
class QueryTerms:
    """The terms of a batch of queries that an index knows, written out and counted."""

    table: DataFrame
    rows: int  # rows of the table, counting a term once per part
    n_queries: int
    reach: int  # most pairs of one query that can be among its best
    n_pairs: int  # postings that all rows of the table match


def query_terms(
    index: Index,
    queries: DataFrame,
    *,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    n_docs: int | None = None,
    max_pairs: int | None = MAX_PAIRS,
    skip_zeros: bool = True,
) -> QueryTerms:
    """Tokenise, look up and weigh ``queries(query_id, query_text)``."""
    counted = query_term_counts(queries, pattern, stopwords, stem=index.by_stem)
    total = n_docs or index.n_docs
    known = lookup_terms(index, counted, rows_up_to_limit(counted))
    known = known.withColumn("idf", idf(total, F.col("df")))
    vector = query_tfidf(known, total, skip_zeros)
    # With several entries per term and document, their counts say nothing about weights.
    open_end = max_pairs is None or index.scattered
    return _measured(index, without_floor(vector) if open_end else with_floor(vector, max_pairs))


def _measured(index: Index, terms: DataFrame) -> QueryTerms:
    totals = Observation()
    pieces = F.sum(index.pieces())
    firsts = F.count_if(F.col("ord") == 1) if "ord" in terms.columns else F.lit(0)
    reach = F.max("reach") if "reach" in terms.columns else F.lit(0)
    observed = terms.observe(
        totals,
        F.coalesce(pieces, F.lit(0)).alias("rows"),
        F.coalesce(firsts, F.lit(0)).alias("n_queries"),
        F.coalesce(reach, F.lit(0)).alias("reach"),
        F.coalesce(F.sum("df"), F.lit(0)).alias("n_pairs"),
    )
    table = materialize(observed, "query-terms")
    return QueryTerms(table, **totals.get)


def _words(index: Index) -> list[str]:
    """The column that places stems."""
    return ["variants"] if index.by_stem else []


def pair_weights(
    index: Index, terms: QueryTerms, n_docs: int | None = None
) -> DataFrame:
    """``(query_id, term, term_no, doc_id, w)``: the pairs that can be among the best."""
    wanted = terms.table.select(
        "query_id", "term", "term_no", "qtf", "df", "idf", "floor", *_words(index)
    )
    matches = match_postings(index, wanted, terms.rows, _pairs_left(terms))
    return raw_tf_weights(matches, n_docs or index.n_docs)


def _pairs_left(terms: QueryTerms) -> int:
    """A bound of the matches that reach their query's floor."""
    return min(terms.n_pairs, terms.reach * terms.n_queries) if terms.n_queries else terms.n_pairs


def candidates(
    index: Index,
    terms: QueryTerms,
    *,
    n_docs: int | None = None,
    max_pairs: int | None = MAX_PAIRS,
) -> DataFrame:
    """The best (document, term) pairs of each query by raw TF-IDF, numbered ``ck``.

    Without a cut a query's pairs meet only where ``ck`` is read.
    """
    weights = pair_weights(index, terms, n_docs)
    return top_candidates(weights, max_pairs, terms.reach, "term_no")


def body_scores(
    index: Index,
    terms: QueryTerms,
    *,
    scoring: str = "positional",
    n_docs: int | None = None,
    max_pairs: int | None = MAX_PAIRS,
) -> DataFrame:
    """``(query_id, doc_id, score, best_w, best_no)`` from the best pairs."""
    dot = {"positional": dot_positional, "aligned": dot_aligned}[scoring]
    pairs = pair_weights(index, terms, n_docs)
    if max_pairs is not None and terms.reach > max_pairs:
        pairs = top_candidates(pairs, max_pairs, terms.reach, "term_no")
    pairs = pairs.select("query_id", "doc_id", "term_no", "w")
    vector = terms.table.select("query_id", "term_no", "ord", "weight")
    dots = dot(sparse_rows(pairs), broadcast_within(vector, terms.rows))
    return score_coordinated(dots).drop("dot", "coordination")


def title_hits(titles: Index, terms: QueryTerms) -> DataFrame:
    """``(query_id, doc_id, hits)`` of the given query terms in the titles."""
    words = terms.table.select("query_id", "term", "qtf")
    found = lookup_terms(titles, words, terms.rows)
    found = found.select("query_id", "term", "qtf", "df", *_words(titles))
    # Hot title terms and stems take more rows, and titles have their own numbers of matches.
    known = _measured(titles, found)
    return hit_counts(match_postings(titles, known.table, known.rows, known.n_pairs))


def with_hits(scores: DataFrame, hits: DataFrame) -> DataFrame:
    """Add the title hits of scored documents; no hit counts as one."""
    joined = scores.join(hits, ["query_id", "doc_id"], "left")
    return joined.withColumn("hits", F.coalesce("hits", F.lit(1)))


def rerank_by_title(scores: DataFrame, hits: DataFrame, n: int) -> DataFrame:
    """Best ``n`` per query by title hits, then score.

    Ties go to the document whose best pair comes first among the candidates.
    """
    counted = with_hits(scores, hits)
    order = [
        F.desc("hits"),
        F.desc("score"),
        F.desc("best_w"),
        F.asc("best_no"),
        F.asc("doc_id"),
    ]
    best = top_per_group(counted, "query_id", order, n)
    return best.select("query_id", "rank", "doc_id", "hits", "score")


def ranked(
    body: Index,
    titles: Index,
    queries: DataFrame,
    *,
    scoring: str = "positional",
    n: int = MAX_RESULTS,
    max_pairs: int | None = MAX_PAIRS,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    n_docs: int | None = None,
    skip_zeros: bool = True,
) -> tuple[DataFrame, int]:
    """``(query_id, rank, doc_id, hits, score)`` of a search, and a bound of its rows."""
    terms = query_terms(
        body,
        queries,
        pattern=pattern,
        stopwords=stopwords,
        n_docs=n_docs,
        max_pairs=max_pairs,
        skip_zeros=skip_zeros,
    )
    scores = body_scores(body, terms, scoring=scoring, n_docs=n_docs, max_pairs=max_pairs)
    return rerank_by_title(scores, title_hits(titles, terms), n), n * terms.n_queries


def search(body: Index, titles: Index, queries: DataFrame, **options) -> DataFrame:
    """``(query_id, rank, doc_id, title, hits, score)``, up to ``n`` rows per query; options as for ``ranked``.

    Documents are scored on the body's best ``max_pairs`` pairs, then ordered by title
    hits and score.  A query has at most ``max_pairs`` documents left by then; None cuts
    nothing.
    """
    best, rows = ranked(body, titles, queries, **options)
    return _presented(best, titles, rows)


def search_stemmed(body: Index, titles: Index, queries: DataFrame, **options) -> DataFrame:
    """``search`` by stems: a query word finds all words of its stem, in texts and titles."""
    return search(body.stemmed(), titles.stemmed(), queries, **options)


def search_body(body: Index, titles: Index, queries: DataFrame, **options) -> DataFrame:
    """The same ranking as ``search``; the plain cosine is ``search_body_cosine``."""
    return search(body, titles, queries, **options)


def search_body_cosine(
    body: Index,
    titles: Index,
    queries: DataFrame,
    *,
    n: int = MAX_RESULTS,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    n_docs: int | None = None,
) -> DataFrame:
    """``(query_id, rank, doc_id, title, score)`` by the textbook cosine on the body.

    All matching documents are scored; there is no cut before the final one.
    """
    terms = query_terms(
        body, queries, pattern=pattern, stopwords=stopwords, n_docs=n_docs
    )
    scores = cosine_scores(body, terms, n_docs=n_docs)
    order = [F.desc("score"), F.asc("doc_id")]
    best = top_per_group(scores, "query_id", order, n, spread="doc_id")
    return _presented(best, titles, n * terms.n_queries)


def normalised_weights(
    index: Index, terms: QueryTerms, n_docs: int | None = None
) -> DataFrame:
    """Length-normalised TF-IDF of every pair the queries' terms match."""
    wanted = terms.table.select(
        "query_id", "term", "term_no", "qtf", "df", "idf", *_words(index)
    )
    matches = match_postings(index, wanted, terms.rows, terms.n_pairs)
    total = n_docs or index.n_docs
    return norm_tf_weights(matches, index.docs(), total, terms.n_pairs)


def cosine_scores(
    index: Index, terms: QueryTerms, n_docs: int | None = None
) -> DataFrame:
    """``(query_id, doc_id, score)`` for every document with a query term."""
    weights = normalised_weights(index, terms, n_docs)
    vector = terms.table.select("query_id", "term_no", "weight")
    return score_cosine(weights, broadcast_within(vector, terms.rows))


def search_title(
    titles: Index,
    queries: DataFrame,
    *,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
    strict: bool = True,
) -> DataFrame:
    """``(query_id, doc_id, title, hits)``: all documents with a query word in the title.

    Sorted by query, hits (most first) and document.
    """
    hits = index_hits(titles, queries, pattern=pattern, stopwords=stopwords)
    hits = materialize(hits, "title-hits")
    titled = with_titles_strict if strict else with_titles
    return _listed(titled(hits, titles.docs_of(hits, rows_up_to_limit(hits))))


def search_anchor(
    anchors: Index,
    titles: DataFrame,
    queries: DataFrame,
    *,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
) -> DataFrame:
    """``(query_id, doc_id, title, hits)``: all link targets with a query word in the
    text of a link to them.  ``titles`` is ``(doc_id, title)``; it need not have them all.

    Sorted by query, hits (most first) and target.
    """
    hits = index_hits(anchors, queries, pattern=pattern, stopwords=stopwords)
    return _listed(with_titles(hits, titles))


def index_hits(
    index: Index,
    queries: DataFrame,
    *,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
) -> DataFrame:
    """``(query_id, doc_id, hits)`` on one index."""
    terms = known_terms(index, queries, pattern=pattern, stopwords=stopwords)
    return hit_counts(match_postings(index, terms.table, terms.rows, terms.n_pairs))


def known_terms(
    index: Index,
    queries: DataFrame,
    *,
    pattern: str = QUERY_PATTERN,
    stopwords: Sequence[str] = QUERY_STOPWORDS,
) -> QueryTerms:
    """``(query_id, term, qtf, df)`` of the query terms that ``index`` knows."""
    counted = query_term_counts(queries, pattern, stopwords, stem=index.by_stem)
    known = lookup_terms(index, counted, rows_up_to_limit(counted))
    return _measured(index, known.select("query_id", "term", "qtf", "df", *_words(index)))


def sorted_by_hits(results: DataFrame) -> DataFrame:
    return results.orderBy("query_id", F.desc("hits"), "doc_id")


def _listed(results: DataFrame) -> DataFrame:
    return sorted_by_hits(results.select("query_id", "doc_id", "title", "hits"))


def _presented(best: DataFrame, titles: Index, rows: int) -> DataFrame:
    # Written out once: both the title look-up and the result read it.
    results = materialize(best, "results")
    results = with_titles(results, titles.docs_of(results, rows))
    front = ["query_id", "rank", "doc_id", "title"]
    return results.select(*front, *(c for c in best.columns if c not in front))

"""The given tables, read as the inputs of a search engine."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.text import tokenize, word_runs
from termloom.plans.build import add_stems, build_index
from termloom.sources.index_store import Index
from termloom.sources.shared import (
    broadcast_within,
    materialize,
    new_path,
    rows_up_to_limit,
    spread_rows,
)
from termloom.sources.links import link_source
from termloom.sources.tables import anchor_source, page_titles, title_source

TRUTH_WORDS = 8

_indexes: dict[tuple[str, str, str], Index] = {}
_qrels: dict[tuple[str, str], DataFrame] = {}


class Corpus:
    """Inputs derived from the tables under ``sf_dir``, and the indexes over them.

    An index is written to the shared folder once per session and then opened by every
    query that needs it.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def documents(self) -> DataFrame:
        return self.table("documents").select("doc_id", "text")

    def titles(self) -> DataFrame:
        return title_source(self.documents())

    def titled_documents(self, condition: Column | None = None) -> DataFrame:
        """``(doc_id, text, title)`` of all documents, or of those meeting a condition."""
        rows = self.table("documents")
        return title_source(
            rows if condition is None else rows.filter(condition), keep_text=True
        )

    def page_titles(self) -> DataFrame:
        return page_titles(self.table("pages"))

    def anchors(self) -> DataFrame:
        """``(doc_id, text)`` with the link target as id."""
        links = anchor_source(self.table("pages"))
        return links.select(
            F.col("target").alias("doc_id"), F.col("anchor_text").alias("text")
        )

    def links(self) -> DataFrame:
        """``(page, href, target, anchor_text)`` with the addresses of targets resolved."""
        return link_source(self.table("pages"))

    def queries(self) -> DataFrame:
        """The text of each benchmark item as ``(query_id, query_text)``."""
        return self.table("benchmark").select(
            F.col("item_id").alias("query_id"), F.col("text").alias("query_text")
        )

    def qrels(self) -> DataFrame:
        """``(query_id, query_text, doc_id)``: documents that share a run of eight words
        with an item, or hold the whole of a shorter one.  Written once per session."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir)
        if key not in _qrels:
            _qrels[key] = materialize(self._find_qrels(), "qrels")
        return _qrels[key]

    def _find_qrels(self) -> DataFrame:
        """An equi-join on the runs of words in each document."""
        items = self.queries().withColumn("words", tokenize(F.col("query_text")))
        items = items.filter(F.size("words") > 0)
        items = items.withColumn("n", F.least(F.size("words"), F.lit(TRUTH_WORDS)))
        # At most eight lengths, whatever the number of items.
        lengths = [r.n for r in items.select("n").distinct().orderBy("n").collect()]
        runs = _every_run(items, "words", lengths, F.col("n")).select(
            "query_id", "query_text", "run"
        )
        texts = spread_rows(self.documents()).withColumn("words", tokenize(F.col("text")))
        found = _every_run(texts, "words", lengths).select("doc_id", "run")
        runs = broadcast_within(runs, rows_up_to_limit(runs))
        return found.join(runs, "run").select("query_id", "query_text", "doc_id").distinct()

    def ranks(self) -> DataFrame:
        """``(id, rank)`` from the labels."""
        quality = F.col("quality").cast("double")
        return self.table("labels").select(
            F.col("doc_id").alias("id"), quality.alias("rank")
        )

    def views(self) -> DataFrame:
        """``(id, views)``: view events per user."""
        events = self.table("events").filter(F.col("event_type") == "view")
        per_user = events.groupBy(F.col("user_id").alias("id"))
        return per_user.agg(F.count("*").alias("views"))

    def rank_requests(self, only_ranked: bool = False) -> DataFrame:
        """Ten document ids to a request, as ``(req_id, pos, id)``."""
        ids = self.table("labels" if only_ranked else "documents")
        return _requests(ids.select(F.col("doc_id").alias("id")))

    def view_requests(self) -> DataFrame:
        return _requests(self.table("customer").select(F.col("c_custkey").alias("id")))

    def body_index(self) -> Index:
        return self._index("body", self.titled_documents)

    def title_index(self) -> Index:
        def docs():
            return self.titles().select("doc_id", F.col("title").alias("text"), "title")

        return self._index("title", docs, min_df=0)

    def stemmed_indexes(self) -> tuple[Index, Index]:
        """The body and title indexes with statistics by stem, over the same postings."""
        for field, index in (("body", self.body_index()), ("title", self.title_index())):
            _indexes[self._key(field)] = add_stems(index)
        return self.body_index(), self.title_index()

    def anchor_index(self) -> Index:
        return self._index("anchor", self.anchors, min_df=0, single_row=False)

    def link_index(self) -> Index:
        """The texts of links, by resolved target."""

        def docs():
            return self.links().select(F.col("target").alias("doc_id"), F.col("anchor_text").alias("text"))

        return self._index("links", docs, min_df=0, single_row=False)

    def new_path(self, name: str) -> str:
        return new_path(self.spark, name)

    def _key(self, field: str) -> tuple[str, str, str]:
        return (self.spark.sparkContext.applicationId, self.sf_dir, field)

    def _index(self, field: str, docs, **options) -> Index:
        key = self._key(field)
        if key not in _indexes:
            path = self.new_path(f"{field}-index")
            _indexes[key] = build_index(docs(), path, **options)
        return _indexes[key]


def _every_run(rows: DataFrame, words: str, lengths: list[int], n=None) -> DataFrame:
    """``rows`` with ``run``, one row per distinct run of a length; ``n``: the row's own."""
    runs = [
        F.array_distinct(word_runs(F.col(words), k))
        if n is None
        else F.when(n == k, F.array_distinct(word_runs(F.col(words), k)))
        for k in lengths
    ]
    if n is not None:
        runs = [F.coalesce(r, F.array().cast("array<string>")) for r in runs]
    every = F.concat(*runs) if runs else F.array().cast("array<string>")
    return rows.withColumn("run", F.explode(every))


def _requests(ids: DataFrame) -> DataFrame:
    return ids.select(
        F.floor(F.col("id") / 10).alias("req_id"), (F.col("id") % 10).alias("pos"), "id"
    )

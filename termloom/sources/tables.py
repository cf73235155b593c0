"""Readers for the inputs: documents, ranks, views, relevance lists, pages."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from termloom.operators.postings import numbered
from termloom.sources.shared import spread_rows

# Fixed value: a link of a page, with its address and its text.
LINK_PATTERN = r'<a href="([^"]*)">([^<]*)</a>'

QRELS = "map<string,array<bigint>>"


def scan_documents(spark: SparkSession, path: str, id_column: str = "id") -> DataFrame:
    """``(doc_id, text)`` from Parquet; other columns are not read."""
    return spark.read.parquet(path).select(F.col(id_column).alias("doc_id"), "text")


def scan_pagerank(spark: SparkSession, path: str) -> DataFrame:
    """``(id, rank, row_no)`` from CSV without a header.

    ``row_no`` follows file order: it sorts by file path, then place in the file.
    """
    rows = spark.read.schema("id bigint, rank double").csv(path, header=False)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )
    return rows.select("id", "rank", place.alias("row_no"))


def write_pagerank(ranks: DataFrame, path: str) -> None:
    ranks.select("id", "rank").write.csv(path, header=False)


def scan_pageviews(spark: SparkSession, path: str) -> DataFrame:
    """``(id, views)`` from Parquet."""
    return spark.read.schema("id bigint, views bigint").parquet(path)


def scan_qrels(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """``(query_id, query_text, doc_id)`` from JSON objects ``{query: [id, ...], ...}``.

    The query id is a hash of the text.  Normally a line holds an object.  ``whole_files`` is for objects that
    span lines.  Large files are read in splits either way.
    """
    if whole_files:
        lists = _lists_over_lines(spark, path)
    else:
        lists = spark.read.text(path).select(F.from_json("value", QRELS).alias("lists"))
    per_query = lists.select(F.explode("lists").alias("query_text", "ids"))
    query_id = F.xxhash64("query_text").alias("query_id")
    return per_query.select(query_id, "query_text", F.explode("ids").alias("doc_id"))


def _lists_over_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(lists)``: maps from query to ids, from objects over many lines, of which many tasks read one.

    Every list ends in ``]``, so files are read by pieces up to the next one, whatever split they lie in; with its end put
    back, a piece is an object of its own.  A query with ``]`` in its text lies in several pieces, none of which
    is an object: quotes inside a text are escaped.  Such neighbours are put together, in file order, and read then.
    """

    def lists_in(text: Column) -> Column:
        body = F.regexp_replace(text, r"^[\s{},]+", "")
        parsed = F.from_json(F.concat(F.lit("{"), body, F.lit("]}")), QRELS)
        return F.when(body != "", parsed).otherwise(F.create_map().cast(QRELS))

    place = F.struct(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    pieces = spark.read.option("lineSep", "]").text(path)
    pieces = pieces.select(F.col("_metadata.file_path").alias("file"), place.alias("at"), "value")
    pieces = pieces.withColumn("lists", lists_in(F.col("value")))
    whole = pieces.filter(F.col("lists").isNotNull()).select("lists")
    if pieces.filter(F.col("lists").isNull()).isEmpty():
        return whole
    # Blank pieces are the ends of objects, or inside a text.
    loose = F.col("lists").isNull() | (F.size("lists") == 0)
    kept = pieces.select("file", "at", F.when(loose, F.col("value")).alias("value"))
    among_all = numbered(kept, "file", "at").filter(F.col("value").isNotNull())
    among_all = among_all.select("file", "value", F.col("place").alias("number"))
    among_torn = numbered(among_all, "file", "number")
    # Neighbours have the same difference of the two numbers.
    run = (F.col("number") - F.col("place")).alias("run")
    runs = among_torn.groupBy("file", run).agg(F.sort_array(F.collect_list(F.struct("number", "value"))).alias("parts"))
    joined = F.array_join(F.transform("parts", lambda p: p["value"]), "]")
    joined = F.regexp_replace(joined, r"(\][\s{},]*)+$", "")
    return whole.unionByName(runs.select(lists_in(joined).alias("lists")))


def write_qrels(qrels: DataFrame, path: str, block_docs: int = 65_536) -> None:
    """Write ``(query_text, doc_id)`` as such lines.

    A query with many relevant documents takes several lines, one per range of ids, or of neighbours if the ids
    are strings.
    """
    if isinstance(qrels.schema["doc_id"].dataType, StringType):
        qrels = numbered(qrels.select("query_text", "doc_id"), "query_text", "doc_id")
        block = F.floor(F.col("place") / block_docs)
    else:
        block = F.floor(F.col("doc_id") / block_docs)
    lists = qrels.groupBy("query_text", block.alias("block")).agg(
        F.sort_array(F.collect_list("doc_id")).alias("ids")
    )
    lists.select(F.to_json(F.create_map("query_text", "ids"))).write.text(path)


def title_source(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``(doc_id, title)``: the whole first line of the text."""
    text = ["text"] if keep_text else []
    return docs.select("doc_id", *text, F.substring_index("text", "\n", 1).alias("title"))


def page_titles(pages: DataFrame) -> DataFrame:
    """``(page_id, url, title)`` from the ``<title>`` of each page."""
    title = F.regexp_extract("html", r"<title>([^<]*)</title>", 1)
    return spread_rows(pages).select("page_id", "url", title.alias("title"))


def anchor_source(pages: DataFrame) -> DataFrame:
    """``(target, anchor_text)``, one row per link in ``pages(html)``."""
    links = F.regexp_extract_all("html", F.lit(LINK_PATTERN), F.lit(0))
    parts = F.transform(
        links,
        lambda link: F.struct(
            F.regexp_extract(link, LINK_PATTERN, 1).alias("target"),
            F.regexp_extract(link, LINK_PATTERN, 2).alias("anchor_text"),
        ),
    )
    return spread_rows(pages).select(F.inline(parts).alias("target", "anchor_text"))

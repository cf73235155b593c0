"""The stored index: Parquet tables under one folder.

``documents``  doc_id, title, doc_len, terms        one folder per batch
``docs``       doc_id, title, doc_len, n_rows       one folder per batch and bucket of the id
``postings``   term, part, doc_id, tf, doc_len      one folder per batch, kind and bucket
``terms``      term, df, term_total, tf_bins        one folder per level and bucket
``stems``      the same for stems, and their terms  one folder per version and bucket, if asked for
``meta``       corpus size and parameters           one row per version

A term's bucket follows from the term, so looking up query terms opens only their
buckets (partition pruning).  Inside a bucket, files are sorted by term, and a term's postings by falling ``tf``.  A term in more
than ``part_rows`` documents is cut into parts, which land in different buckets: neither
a file nor a join key ever holds much more than ``part_rows`` entries.

Postings of a batch lie apart by whether their term is ``rare`` in the batch, in at most ``min_df`` of its
documents.  The others are in the vocabulary whatever comes, so reading the postings of an index
of one batch needs no look at its terms, and no shuffle.

Term statistics lie in levels, named by the version that wrote them.  An append writes a level with its own
batch's additions only; a term's statistics are the sums over the levels that ``meta`` lists.

The ``meta`` row is written last.  Readers take the batches up to the newest version, so
a build or an append that dies half-way stays invisible and can be repeated.
"""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.operators.postings import TF_EDGES, term_statistics
from termloom.sources.shared import BROADCAST_ROWS, broadcast_within, dealt_by

META_SCHEMA = (
    "n_docs bigint, n_postings bigint, max_df bigint, min_df int, pattern string, "
    "stopwords array<string>, buckets int, part_rows bigint, single_row boolean, "
    "id_type string, repeats boolean, fixed_sizes boolean, base int, last_batch string, "
    "doc_buckets int, stem boolean, levels array<struct<version: int, rows: bigint>>, version int"
)

TERM_SCHEMA = "term string, df bigint, term_total bigint, tf_bins array<bigint>"


def n_parts(df: Column, part_rows: int) -> Column:
    """Number of parts of a term found in ``df`` documents."""
    return F.ceil(df / part_rows).cast("int")


def doc_bucket_of(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def bucket_of(term: Column, part: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(term, part), F.lit(buckets)).cast("int")


@dataclass(frozen=True)
class Index:
    """One version of a stored index."""

    spark: SparkSession
    path: str
    version: int
    n_docs: int
    n_postings: int
    max_df: int
    min_df: int
    pattern: str
    stopwords: tuple[str, ...]
    buckets: int
    part_rows: int
    single_row: bool
    id_type: str
    repeats: bool = False  # whether a document may have several rows and entries
    fixed_sizes: bool = False  # whether the caller chose buckets and parts
    base: int = 0  # first batch that counts; earlier ones were rewritten by ``compact``
    last_batch: str = ""  # name of the stream batch that came last
    doc_buckets: int = 1
    stem: bool = False  # whether statistics by stem are stored
    levels: tuple[tuple[int, int], ...] = ()  # version and rows of the levels of term statistics
    by_stem: bool = False  # whether this is the view whose terms are stems

    @property
    def scattered(self) -> bool:
        """Whether a document may have several entries of one term."""
        return self.repeats or (not self.single_row and self.version > self.base)

    def _read(self, table: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{table}")

    def forward(self) -> DataFrame:
        """The tokenised input rows: ``doc_id, title, doc_len, terms, batch``."""
        schema = (
            f"doc_id {self.id_type}, title string, doc_len bigint, "
            "terms array<struct<term: string, tf: int>>, batch int"
        )
        rows = self._read("documents", schema)
        return rows.filter(F.col("batch").between(self.base, self.version))

    def doc_table(self) -> DataFrame:
        """``(bucket, doc_id, title, doc_len, n_rows)``, one row per document and batch."""
        schema = f"doc_id {self.id_type}, title string, doc_len bigint, n_rows bigint, batch int, bucket int"
        return self._read("docs", schema).filter(F.col("batch").between(self.base, self.version)).drop("batch")

    def docs(self) -> DataFrame:
        """``(doc_id, title, doc_len)``, one row per document."""
        rows = self.doc_table().select("doc_id", "title", "doc_len")
        return self._one_per_document(rows)

    def _one_per_document(self, rows: DataFrame) -> DataFrame:
        if self.version == self.base or not (self.repeats or not self.single_row):
            return rows
        return rows.groupBy("doc_id").agg(
            F.min("title").alias("title"), F.sum("doc_len").alias("doc_len")
        )

    def docs_of(self, ids: DataFrame, rows: int | None = None) -> DataFrame:
        """``docs`` of the given ``doc_id`` rows, opening only their buckets.

        ``rows`` bounds the number of ids; within the broadcast limit the documents stay where they are.
        """
        # Always true, but it marks the side as selective, so that the planner prunes the scan.
        bucket = doc_bucket_of(F.col("doc_id"), self.doc_buckets)
        wanted = ids.select("doc_id").distinct().withColumn("bucket", bucket).filter(F.col("bucket") >= 0)
        wanted = broadcast_within(wanted, BROADCAST_ROWS + 1 if rows is None else rows)
        found = self.doc_table().join(wanted, ["bucket", "doc_id"], "left_semi")
        return self._one_per_document(found.select("doc_id", "title", "doc_len"))

    def stemmed(self) -> "Index":
        """The same index with stems as its terms; their entries are those of all their words."""
        if not self.stem:
            raise ValueError("build the index with stem=True, or call add_stems")
        return replace(self, by_stem=True)

    def term_table(self) -> DataFrame:
        """Statistics of every term, with bucket, before the document-frequency filter.

        By stem there is a column ``variants`` more, the words of the stem with their own frequencies.
        """
        if not self.by_stem:
            rows = self.level_rows([version for version, _ in self.levels])
            if len(self.levels) == 1:
                return rows
            summed = term_statistics(rows, ["bucket", "term"], merge=True)
            return summed.select("term", "df", "term_total", "tf_bins", "bucket")
        schema = f"{TERM_SCHEMA}, variants array<struct<term: string, df: bigint>>, version int, bucket int"
        return self._read("stems", schema).filter(F.col("version") == self.version).drop("version")

    def level_rows(self, versions: list[int]) -> DataFrame:
        """The rows of some levels of term statistics, with bucket; a term may have one in each."""
        rows = self._read("terms", f"{TERM_SCHEMA}, version int, bucket int")
        return rows.filter(F.col("version").isin(versions)).drop("version")

    def vocabulary(self) -> DataFrame:
        """The rows of ``term_table`` that are found in more than ``min_df`` documents."""
        return self.term_table().filter(F.col("df") > self.min_df)

    def terms(self) -> DataFrame:
        """``(term, df, term_total)`` of the vocabulary."""
        return self.vocabulary().select("term", "df", "term_total")

    def posting_table(self, rare: bool | None = None) -> DataFrame:
        """All entries with part and bucket, before the document-frequency filter; or one kind of them."""
        schema = (
            f"term string, part int, doc_id {self.id_type}, tf int, doc_len bigint, "
            "batch int, rare boolean, bucket int"
        )
        rows = self._read("postings", schema)
        rows = rows.filter(F.col("batch").between(self.base, self.version))
        rows = rows if rare is None else rows.filter(F.col("rare") == rare)
        return rows.drop("batch", "rare")

    def vocabulary_postings(self) -> DataFrame:
        """The entries of the vocabulary's terms, with part and bucket.

        The vocabulary is looked at for terms that are rare in their batch only, and if there are several.
        """
        often = self.posting_table(rare=False)
        if self.version == self.base or self.min_df <= 0:
            return often
        grown = self.place(self.vocabulary().select("term", "df"))
        rare = self.posting_table(rare=True).join(grown, ["bucket", "term", "part"], "left_semi")
        return often.unionByName(rare)

    def postings(self, lengths: bool = False) -> DataFrame:
        """``(term, doc_id, tf)`` of the vocabulary, with ``doc_len`` if asked for.

        Repeated documents keep their repeated entries; a document spread over rows has
        one entry per term, and so has a stem.
        """
        if self.by_stem:
            rows = self._postings_by_stem()
        else:
            rows = self.vocabulary_postings()
            if not self.single_row and self.scattered:
                rows = rows.groupBy("term", "doc_id").agg(F.sum("tf").cast("int").alias("tf"))
        if not lengths:
            return rows.select("term", "doc_id", "tf")
        if self.single_row and not self.repeats and not self.by_stem:
            return rows.select("term", "doc_id", "tf", "doc_len")
        sizes = self.docs().select("doc_id", "doc_len")
        return rows.select("term", "doc_id", "tf").join(sizes, "doc_id")

    def _postings_by_stem(self) -> DataFrame:
        words = self.place(self.vocabulary().select("term", "df", "variants")).drop("df")
        entries = self.posting_table().withColumnRenamed("term", "variant")
        joined = entries.join(words, ["bucket", "variant", "part"])
        joined = dealt_by(joined.select("term", "doc_id", "tf"), "doc_id", self.n_postings)
        return joined.groupBy("term", "doc_id").agg(F.sum("tf").cast("int").alias("tf"))

    def place(self, terms: DataFrame) -> DataFrame:
        """Add ``part`` and ``bucket`` to rows with ``term`` and ``df``, a row per part.

        By stem there is a row for each part of each of its words, named ``variant``.
        """
        word, df = F.col("term"), F.col("df")
        if self.by_stem:
            others = [c for c in terms.columns if c != "variants"]
            terms = terms.select(*others, F.inline("variants").alias("variant", "variant_df"))
            word, df = F.col("variant"), F.col("variant_df")
        part = F.lit(0)
        if self.max_df > self.part_rows:
            part = F.explode(F.sequence(F.lit(0), n_parts(df, self.part_rows) - 1))
        placed = terms.withColumn("part", part)
        return placed.withColumn("bucket", bucket_of(word, F.col("part"), self.buckets)).drop("variant_df")

    def pieces(self):
        """The number of rows that ``place`` makes of a row, as a column."""
        if not self.by_stem:
            return n_parts(F.col("df"), self.part_rows)
        return F.aggregate(
            "variants", F.lit(0), lambda sum_, v: sum_ + n_parts(v["df"], self.part_rows)
        )

    def meta(self) -> DataFrame:
        """The parameters as a one-row table."""
        return self.spark.range(1).select(
            F.lit(self.n_docs).cast("bigint").alias("n_docs"),
            F.lit(self.min_df).alias("min_df"),
            F.lit(self.pattern).alias("pattern"),
        )


def write_documents(rows: DataFrame, path: str, batch: int) -> None:
    rows.write.mode("overwrite").parquet(f"{path}/documents/batch={batch}")


def write_docs(rows: DataFrame, path: str, batch: int, buckets: int, single_row: bool) -> None:
    """Write one row per document from ``(doc_id, title, doc_len)`` rows, by bucket and sorted by id.

    Rows of a document that are usually one are moved as they are, in one shuffle; many rows of a document
    are added up before.
    """
    sums = [F.min("title").alias("title"), F.sum("doc_len").alias("doc_len")]
    bucket = doc_bucket_of(F.col("doc_id"), buckets)
    if single_row:
        placed = rows.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket"))
        placed = placed.groupBy("bucket", "doc_id").agg(*sums, F.count("*").alias("n_rows"))
    else:
        added = rows.groupBy("doc_id").agg(*sums, F.count("*").alias("n_rows"))
        placed = added.withColumn("bucket", bucket).repartitionById(buckets, F.col("bucket"))
    ordered = placed.sortWithinPartitions("bucket", "doc_id")
    ordered.write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/docs/batch={batch}")


def write_terms(
    terms: DataFrame, path: str, version: int, buckets: int, table: str = "terms"
) -> None:
    """Write term statistics by bucket, each by a task of its own, sorted by term."""
    bucketed = terms.repartitionById(buckets, F.col("bucket"))
    ordered = bucketed.sortWithinPartitions("bucket", "term")
    target = f"{path}/{table}/version={version}"
    ordered.write.mode("overwrite").partitionBy("bucket").parquet(target)


def write_postings(
    entries: DataFrame, path: str, batch: int, buckets: int, slices: int, min_df: int = 0
) -> None:
    """Write ``(term, part, doc_id, tf[, doc_len])`` rows by kind and bucket, sorted by term, bin of ``tf`` and document.

    The entries with the largest ``tf`` come first.  So a file's pages, whose least and greatest values Parquet keeps
    apart from them, hold like entries, and a reader that asks for a term's heavy entries passes over the rest.

    Every task owns one slice of one bucket.  ``slices`` is a multiple of ``buckets``.  A term is counted where
    its rows are anyway, but for those that may have several parts, which come with ``hot_df``.
    """
    slice_id = F.pmod(F.xxhash64("term", "part"), F.lit(slices)).cast("int")
    sliced = entries.withColumn("slice", slice_id).repartitionById(slices, F.col("slice"))
    # What follows from a row is added after the shuffle.
    placed = sliced.withColumn("bucket", F.col("slice") % buckets)
    here = F.count("*").over(W.partitionBy("slice", "bucket", "term", "part"))
    size = F.coalesce("hot_df", here) if "hot_df" in entries.columns else here
    counted = placed.withColumn("rare", size <= min_df)
    weight_bin = reduce(Column.__add__, ((F.col("tf") >= edge).cast("int") for edge in TF_EDGES))
    order = ["rare", "bucket", "term", weight_bin.desc(), "doc_id"]
    ordered = counted.drop("slice", "hot_df").sortWithinPartitions(*order)
    target = f"{path}/postings/batch={batch}"
    ordered.write.mode("overwrite").partitionBy("rare", "bucket").parquet(target)


def write_meta(index: Index) -> None:
    row = index.spark.range(1).select(
        F.lit(index.n_docs).cast("bigint").alias("n_docs"),
        F.lit(index.n_postings).cast("bigint").alias("n_postings"),
        F.lit(index.max_df).cast("bigint").alias("max_df"),
        F.lit(index.min_df).alias("min_df"),
        F.lit(index.pattern).alias("pattern"),
        F.lit(list(index.stopwords)).cast("array<string>").alias("stopwords"),
        F.lit(index.buckets).alias("buckets"),
        F.lit(index.part_rows).cast("bigint").alias("part_rows"),
        F.lit(index.single_row).alias("single_row"),
        F.lit(index.id_type).alias("id_type"),
        F.lit(index.repeats).alias("repeats"),
        F.lit(index.fixed_sizes).alias("fixed_sizes"),
        F.lit(index.base).alias("base"),
        F.lit(index.last_batch).alias("last_batch"),
        F.lit(index.doc_buckets).alias("doc_buckets"),
        F.lit(index.stem).alias("stem"),
        F.array(
            *(
                F.struct(F.lit(version).alias("version"), F.lit(rows).cast("bigint").alias("rows"))
                for version, rows in index.levels
            )
        ).alias("levels"),
    )
    row.write.mode("overwrite").parquet(f"{index.path}/meta/version={index.version}")


def read_index(spark: SparkSession, path: str) -> Index:
    """Open the newest version of the index under ``path``."""
    path = path.rstrip("/")
    rows = spark.read.schema(META_SCHEMA).parquet(f"{path}/meta")
    newest = rows.orderBy(F.desc("version")).limit(1).collect()
    if not newest:
        raise FileNotFoundError(f"no index under {path}")
    fields = newest[0].asDict()
    fields["stopwords"] = tuple(fields["stopwords"])
    fields["levels"] = tuple((level["version"], level["rows"]) for level in fields["levels"])
    return Index(spark=spark, path=path, **fields)


def index_exists(spark: SparkSession, path: str) -> bool:
    """Whether a version under ``path`` is complete; asked of the file system alone."""
    files, pattern = _hadoop(spark, f"{path.rstrip('/')}/meta/version=*/_SUCCESS")
    return bool(files.globStatus(pattern))


def _hadoop(spark: SparkSession, path: str):
    """The file system of ``path``, and the path as it takes it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def delete_index(spark: SparkSession, path: str) -> bool:
    """Remove the index tables under ``path``; false if there were none."""
    files, root = _hadoop(spark, path)
    removed = False
    # meta goes first: from then on no reader takes the rest for an index.
    for table in ("meta", "stems", "terms", "postings", "docs", "documents"):
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, table)
        removed = files.delete(folder, True) or removed
    return removed


def drop_old_versions(index: Index) -> None:
    """Remove what only earlier versions than ``index`` read."""
    live = {version for version, _ in index.levels}
    for table, key, last in (
        ("meta", "version", index.version - 1),
        ("terms", "version", index.version - 1),
        ("stems", "version", index.version - 1),
        ("postings", "batch", index.base - 1),
        ("documents", "batch", index.base - 1),
        ("docs", "batch", index.base - 1),
    ):
        for number in range(last + 1):
            if table == "terms" and number in live:
                continue
            files, folder = _hadoop(index.spark, f"{index.path}/{table}/{key}={number}")
            files.delete(folder, True)


def id_type_of(docs: DataFrame) -> str:
    """SQL name of the document id type; ids are bigint or string."""
    return "string" if isinstance(docs.schema["doc_id"].dataType, T.StringType) else "bigint"

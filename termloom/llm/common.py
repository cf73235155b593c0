"""What several of these operators share: words, folds, bounded samples, document keys."""

import re
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]"
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """The runs of letters of a text, as ``\\p{L}+`` finds them in the JVM."""
    found = []
    for word in _LETTERS.findall(text):
        # The pattern also takes number signs such as \u00bd for letters.
        found += [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()
    return found


def text_of(column: str = "text") -> Column:
    """The whole text; a null one counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model may learn from; a null id is in no fold."""
    fold = F.crc32(F.col(doc_id).cast("string")) % FOLDS
    return F.coalesce(fold == 0, F.lit(False))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def text_keys(text: Column) -> tuple[Column, Column]:
    """Two 64-bit hashes that together name a text."""
    return F.xxhash64(text), F.xxhash64(F.lit(7), text)


def set_aside(df: DataFrame, names: list[str]) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with its columns of these names renamed, and the way back."""
    moved = {name: f"_own_{name}" for name in names if name in df.columns}
    return df.withColumnsRenamed(moved), {new: name for name, new in moved.items()}


@contextmanager
def small_batches(spark: SparkSession, rows: int = 500):
    """Arrow batches of few rows for the jobs run inside; texts and sets make rows large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def bounded_sample(df: DataFrame, key: str, rows: int, seed: str) -> DataFrame:
    """``rows`` rows by least hash of ``key`` (all, if fewer).

    The hash is uniform, so a cut at 1.5 times the share wanted leaves few rows to sort; only
    those meet in one task.
    """
    h = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 1)
    share = 1.5 * rows / max(1, df.count())
    near = df.withColumn("_hash", h).filter(F.col("_hash") / F.lit(float(2**63)) <= share)
    return near.orderBy("_hash", key).limit(rows).drop("_hash")


def sample_per_group(
    df: DataFrame, groups: list[str], order: list[Column], rows: int
) -> DataFrame:
    """The first ``rows`` rows of each group; partitions are cut before the shuffle."""
    rank = F.row_number().over(W.partitionBy(*groups).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= rows).drop("_rank")

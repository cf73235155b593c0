"""From raw documents to token ids: five stages, each written as Parquet before the next."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import bpe, dedup, mixing, quality, secrets
from termloom.llm.common import table
from termloom.llm.queries import digests
from termloom.sources.shared import new_path

# Four fifths of the tokens stay, with sources, languages and topics drawn closer together.
MIX = mixing.Mix(fraction=0.8, flatten=0.8)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays."""
    return dedup.keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; every document stays."""
    return secrets.redact(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are taken with the probabilities of the raked mixture."""
    return mixing.sample(docs, mix=MIX)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, with the digests of the ids and of the text decoded from them."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.encode(
        docs.select("doc_id", "text"), path, public_tokenizers.PATTERN, decoded="decoded"
    )
    return digests(coded, "ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# The last stage has no equal in SQL; tests compare it with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        made = stage(spark, docs, sf_dir)
        path = new_path(spark, f"pipeline-{name}")
        made.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

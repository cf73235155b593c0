"""The operators as registered queries over the given tables."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    alignment,
    bpe,
    dedup,
    language,
    mixing,
    neighbours,
    pages,
    quality,
    repeats,
    secrets,
    topk,
    toxicity,
    whitening,
)
from termloom.llm.common import held_out, table, text_of
from termloom.llm.sql import ORACLE_SQL  # noqa: F401  (read by the entry point)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = toxicity.fit(docs.filter(~held_out()), labels.filter(~held_out()))
    asked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return toxicity.predict(asked, model)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    found = secrets.scan(docs)
    per_kind = {
        f"n_{kind}": F.size(F.filter("base_spans", _of_kind(secrets.NUMBER[kind])))
        for kind in secrets.BASE
    }
    return found.select(
        "doc_id",
        *(size.cast("bigint").alias(name) for name, size in per_kind.items()),
        F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
        "n_live",
        "n_example",
    )


def _of_kind(number: int):
    return lambda span: span["kind"] == number


def op3_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup.classes(docs).select("doc_id", "class_id", "class_size", "kept")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = repeats.without_repeats(docs)
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return found.select("doc_id", "n_words", "n_removed", kept)


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return pages.extract(given, pages.fit(given))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.fit(docs.filter(~held_out()))
    asked = docs.select("doc_id", held_out().alias("held_out"), "text")
    return language.predict(asked, model)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digests(bpe.encode(docs, path, public_tokenizers.PATTERN, decoded="decoded"))


def digests(coded: DataFrame, *more: str) -> DataFrame:
    ids = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    return mixing.weigh(docs).select(
        "doc_id",
        "source",
        "lang",
        "topic",
        "n_tokens",
        F.round("weight", 6).alias("weight"),
        F.round("probability", 6).alias("probability"),
        "taken",
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.integers(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, vectors.filter(F.col("id") % 100 == 0))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "failed_rules",
    )


def op11_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.near_duplicates(table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, model = whitening.whiten(table(spark, sf_dir, "embeddings"))
    explained = model.explained if model else []
    per_component = found.select("id", "n", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    share = F.element_at(F.lit(explained).cast("array<double>"), F.col("place") + 1)
    return per_component.select(
        F.col("id").alias("vec_id"),
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "whitened",
        share.alias("explained"),
        F.lit(model.identity_error if model else None).cast("double").alias("identity_error"),
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    aligned = alignment.align(table(spark, sf_dir, "documents"), *paths)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    counted = alignment.with_counts(aligned.withColumn("groups_sha256", digest).drop("groups"))
    return counted.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_secrets": op2_secrets,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_html_text": op5_html_text,
    "op6_language_id": op6_language_id,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_mixing": op8_mixing,
    "op9_topk": op9_topk,
    "op10_quality_rules": op10_quality_rules,
    "op11_multi_index": op11_multi_index,
    "op12_whitening": op12_whitening,
    "op13_alignment": op13_alignment,
}

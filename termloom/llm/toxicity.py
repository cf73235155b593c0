"""Toxicity from confirmed toxic examples and unlabelled text (non-negative PU learning).

Only toxic examples are taken as labelled; everything else is unlabelled.  With the class prior
``p``, the risk of a scorer ``f`` is

    p E_toxic[l(f)]  +  max(0, E_unlabelled[l(-f)] - p E_toxic[l(-f)])

with the logistic loss.  Where the second part falls below zero, training takes a step that
raises it again, so that the scorer cannot gain by overfitting the toxic examples.  Three linear
numpy classifiers, each on its own draw of the sample, are averaged.

A document is the set of its lower-case words.  The fit uses at most ``max_toxic`` toxic and
``max_unlabelled`` unlabelled documents and the ``max_words`` words that tell them apart best, by at least ``least_z``
standard errors (documented bounds on what reaches the driver); scores are of whole texts.  The prior, unless
given, is the share of toxic rows among the labels.

Defined cases: null and empty texts get the score of a text without any known word.  A document
labelled repeatedly is toxic if any of its labels is; null labels do not count.  Without toxic
examples all scores are 0.  Repeated rows each get a row.  Other columns pass through;
``score`` and ``predicted`` are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import bounded_sample, letter_words
from termloom.sources.shared import materialize

JVM_LETTERS = r"\p{L}+"


@dataclass
class Model:
    words: dict[str, int]
    weights: np.ndarray  # a row per classifier: one weight per word, then the bias


def _sample(docs, toxic, max_toxic: int, max_unlabelled: int) -> DataFrame:
    """``(doc_id, toxic)``, a document once as an example and once as unlabelled text."""
    ids = docs.select("doc_id").distinct()
    parts = [
        bounded_sample(df, "doc_id", rows, "toxicity").withColumn("toxic", F.lit(kind))
        for kind, df, rows in ((1, ids.join(toxic, "doc_id"), max_toxic), (0, ids, max_unlabelled))
    ]
    return materialize(parts[0].unionByName(parts[1]), "toxicity-sample")


def fit(
    docs: DataFrame,
    labels: DataFrame,
    prior: float | None = None,
    max_toxic: int = 4_000,
    max_unlabelled: int = 8_000,
    max_words: int = 1_000,
    least_z: float = 4.0,
    seed: int = 7,
) -> Model:
    """``docs``: doc_id, text.  ``labels``: doc_id, toxic.  Pass only what may be learned from."""
    named = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    per_doc = named.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    if prior is None:
        prior = per_doc.agg(F.avg((F.col("toxic") >= 1).cast("double"))).first()[0]
    docs = docs.select("doc_id", "text").filter(F.col("doc_id").isNotNull())
    toxic = per_doc.filter(F.col("toxic") >= 1).select("doc_id")
    sample = _sample(docs, toxic, max_toxic, max_unlabelled)
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    if not prior or not sizes.get(1):
        return Model({}, np.zeros((0, 1)))

    # The sample is bounded by the two parameters above, so it may be broadcast.
    terms = F.array_distinct(
        F.regexp_extract_all(F.lower("text"), F.lit(JVM_LETTERS), F.lit(0))
    )
    found = (
        docs.join(F.broadcast(sample), "doc_id")
        .select("doc_id", "toxic", F.explode(terms).alias("word"))
        .distinct()
    )
    found = materialize(found, "toxicity-words")
    n1, n0 = sizes[1], sizes[0]
    r1, r0 = F.col("n1") / n1, F.col("n0") / n0
    pooled = (F.col("n1") + F.col("n0")) / (n1 + n0)
    spread = F.sqrt(pooled * (1 - pooled) * (1 / n1 + 1 / n0)) + 1e-9
    z = F.abs(r1 - r0) / spread
    words = (
        found.groupBy("word")
        .agg(F.count_if(F.col("toxic") == 1).alias("n1"), F.count_if(F.col("toxic") == 0).alias("n0"))
        .filter((F.col("n1") >= 3) & (z >= least_z))
        .orderBy(F.desc(z), "word")
        .limit(max_words)
    )
    place = {r["word"]: i for i, r in enumerate(words.select("word").collect())}
    chosen = docs.sparkSession.createDataFrame(list(place.items()), "word string, place int")
    rows = (
        found.join(F.broadcast(chosen), "word")
        .groupBy("doc_id", "toxic")
        .agg(F.collect_list("place").alias("places"))
        .toPandas()
        .sort_values(["toxic", "doc_id"])
    )
    return Model(place, _train(rows, sizes, len(place), float(prior), seed))


def _train(rows: pd.DataFrame, sizes: dict, n_words: int, prior: float, seed: int) -> np.ndarray:
    def matrix(kind: int) -> np.ndarray:
        x = np.zeros((sizes[kind], n_words + 1), dtype=np.float32)
        x[:, n_words] = 1
        for i, places in enumerate(rows.loc[rows["toxic"] == kind, "places"]):
            x[i, places] = 1
        return x

    toxic, other = matrix(1), matrix(0)
    random = np.random.default_rng(seed)
    models = []
    for _ in range(3):
        a = toxic[random.permutation(len(toxic))[: max(1, len(toxic) * 4 // 5)]]
        b = other[random.permutation(len(other))[: max(1, len(other) * 4 // 5)]]
        models.append(nonnegative_pu(a, b, prior))
    return np.array(models)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def nonnegative_pu(
    toxic: np.ndarray, other: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05
) -> np.ndarray:
    """Weights of a linear scorer by Adam on the corrected risk; the last column is the bias."""
    w = np.zeros(toxic.shape[1])
    w[-1] = np.log(prior / (1 - prior)) if prior < 1 else 0
    mean, square = np.zeros_like(w), np.zeros_like(w)
    shrink = np.full_like(w, 1e-4)
    shrink[-1] = 0
    for step in range(1, steps + 1):
        now = w.astype(np.float32)
        ft, fo = toxic @ now, other @ now
        negative = np.logaddexp(0, fo).mean() - prior * np.logaddexp(0, ft).mean()
        of_negative = other.T @ sigmoid(fo) / len(other) - prior * (toxic.T @ sigmoid(ft)) / len(toxic)
        if negative >= 0:
            of_positive = prior * (toxic.T @ (sigmoid(ft) - 1)) / len(toxic)
            gradient = of_positive + of_negative + shrink * w
        else:
            gradient = -of_negative
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.999 * square + 0.001 * gradient**2
        bent = mean / (1 - 0.9**step) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
        w -= rate * bent
    return w


def score_text(text, model: Model) -> float:
    if not len(model.weights):
        return 0.0
    words = set(letter_words(text.lower())) if isinstance(text, str) else ()
    known = [model.words[w] for w in words if w in model.words]
    return float(sigmoid(model.weights[:, known].sum(axis=1) + model.weights[:, -1]).mean())


def predict(df: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``df`` with ``score`` and ``predicted`` in place of the text."""
    made = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    gone = {text_column, "score", "predicted"}
    kept = [f for f in df.schema.fields if f.name not in gone]
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            scores = [score_text(t, model) for t in batch[text_column]]
            yield batch[[f.name for f in kept]].assign(
                score=scores, predicted=[int(s >= 0.5) for s in scores]
            )

    return df.mapInPandas(run, T.StructType([*kept, *made]))

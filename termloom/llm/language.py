"""Language identification: known words first, shorter and shorter n-grams for the rest.

The model has, per language, log frequencies of words and of character n-grams (4 down to
1, words marked by ``^`` and ``$``).  A known word scores by its log frequency in every
language.  An unknown one falls back to its known 4-grams, without any to its 3-grams, and
so on; the mean of their log frequencies stands for the word.  The sum over all words and
the languages' priors gives the posterior.

The fit uses at most ``max_docs`` labelled documents per language, ``max_words`` words and
``max_grams`` n-grams of each length per language (documented bounds: they keep the model at
some megabytes); predictions read whole texts.

Defined cases: null or letterless texts give ``und`` with score 0, and so does every text if
nothing could be learned.  Null labels teach nothing.  A text in letters never seen gets the most
frequent language.  Ties go to the first language by name.  Other columns pass through;
``lang_pred`` and ``score`` are replaced.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import letter_words, sample_per_group
from termloom.sources.shared import broadcast_within, materialize, rows_up_to_limit

JVM_LETTERS = r"\p{L}+"
LONGEST = 4
CACHE_WORDS = 400_000
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    words: dict[str, int]
    grams: dict[str, int]
    table: np.ndarray  # one row of log frequencies for each word and n-gram


def fit(
    docs: DataFrame,
    text_column: str = "text",
    label_column: str = "lang",
    id_column: str = "doc_id",
    max_docs: int = 2_000,
    max_words: int = 10_000,
    max_grams: int = 5_000,
    max_languages: int = 500,
) -> Model:
    """Counts the sampled documents' words and n-grams in Spark, and collects the best."""
    named = docs.filter(F.col(label_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).alias("id"),
        F.col(label_column).alias("lang"),
        F.xxhash64(id_column, label_column).alias("order"),
    )
    totals = named.groupBy("lang").count().orderBy("lang").limit(max_languages + 1).collect()
    if len(totals) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages")
    languages = [r["lang"] for r in totals]
    if not languages:
        return Model([], np.zeros(0), {}, {}, np.zeros((0, 0)))
    seen = np.array([r["count"] for r in totals], dtype=float)
    # The order is a uniform hash: a cut at 1.5 times the share wanted leaves few rows to rank.
    share = [min(1.0, 1.5 * max_docs / n) for n in seen.tolist()]
    near = F.create_map(
        *(F.lit(x) for pair in zip(languages, share, strict=True) for x in pair)
    )
    uniform = F.shiftrightunsigned("order", 1) / F.lit(float(2**63))
    chosen = sample_per_group(
        named.filter(uniform <= near[F.col("lang")]),
        ["lang"],
        [F.col("order"), F.col("id")],
        max_docs,
    )
    chosen = chosen.select(F.col("id").alias(id_column), F.col("lang").alias(label_column))
    chosen = materialize(chosen.distinct(), "language-sample")
    chosen = broadcast_within(chosen, rows_up_to_limit(chosen))
    texts = docs.join(chosen, [id_column, label_column]).select(
        F.col(label_column).alias("lang"), F.lower(text_column).alias("text")
    )
    words = F.explode(F.regexp_extract_all("text", F.lit(JVM_LETTERS), F.lit(0))).alias("term")
    counted = texts.select("lang", words).groupBy("lang", "term").agg(F.count("*").alias("n"))
    counted = materialize(counted.withColumn("size", F.lit(0)), "language-words")

    marked = F.concat(F.lit("^"), "term", F.lit("$"))
    sizes = F.explode(F.sequence(F.lit(1), F.lit(LONGEST))).alias("size")
    starts = F.sequence(F.lit(1), F.length("term") - F.col("size") + 1)
    pieces = F.transform(starts, lambda i: F.substring("term", i, F.col("size")))
    grams = (
        counted.select("lang", marked.alias("term"), "n", sizes)
        .filter(F.length("term") >= F.col("size"))
        .select("lang", "size", "n", F.explode(pieces).alias("term"))
        .groupBy("lang", "term", "size")
        .agg(F.sum("n").alias("n"))
    )
    order = [F.desc("n"), F.col("term")]
    best = sample_per_group(counted, ["lang"], order, max_words).unionByName(
        sample_per_group(grams, ["lang", "size"], order, max_grams)
    )
    return _model(languages, seen, best.toPandas())


def _model(languages: list[str], seen: np.ndarray, counts: pd.DataFrame) -> Model:
    place = {lang: i for i, lang in enumerate(languages)}
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    sizes: list[int] = []
    for size, term in counts[["size", "term"]].drop_duplicates().itertuples(index=False):
        (words if size == 0 else grams)[term] = len(sizes)
        sizes.append(size)
    table = np.full((len(sizes), len(languages)), 0.5)
    for lang, size, term, n in counts[["lang", "size", "term", "n"]].itertuples(index=False):
        table[(words if size == 0 else grams)[term], place[lang]] += n
    for size in set(sizes):
        rows = np.array(sizes) == size
        table[rows] = np.log(table[rows] / table[rows].sum(axis=0))
    return Model(languages, np.log(seen / seen.sum()), words, grams, table)


class Scorer:
    def __init__(self, model: Model):
        self.m, self.rows, self.made = model, {}, []
        self.none = np.zeros(len(model.languages))
        self.full = np.vstack([model.table, self.none[None, :]])

    def _row(self, word: str) -> np.ndarray:
        m = self.m
        if word in m.words:
            return m.table[m.words[word]]
        marked = f"^{word}$"
        for size in range(LONGEST, 0, -1):
            known = [
                g
                for i in range(len(marked) - size + 1)
                if (g := m.grams.get(marked[i : i + size])) is not None
            ]
            if known:
                return m.table[known].mean(axis=0)
        return self.none

    def predict(self, text) -> tuple[str, float]:
        words = letter_words(text.lower()) if isinstance(text, str) else []
        if not words or not self.m.languages:
            return UNKNOWN, 0.0
        rows, total = self.rows, self.m.prior.copy()
        try:
            at = [rows[w] for w in words]
        except KeyError:
            if len(rows) > CACHE_WORDS:
                rows.clear()
                self.made = []
            for w in words:
                if w not in rows:
                    rows[w] = len(self.made)
                    self.made.append(self._row(w))
            at = [rows[w] for w in words]
        made = self.made
        for i in at:
            total += made[i]
        best = int(np.argmax(total))
        return self.m.languages[best], float(1 / np.exp(total - total[best]).sum())


def predict(df: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` in place of the text."""
    kept = [f for f in df.schema.fields if f.name not in {text_column, "lang_pred", "score"}]
    schema = T.StructType(
        [*kept, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(t) for t in batch[text_column]]
            yield batch[[f.name for f in kept]].assign(
                lang_pred=[f[0] for f in found], score=[f[1] for f in found]
            )

    return df.mapInPandas(run, schema)

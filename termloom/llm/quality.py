"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules have fixed limits.  On top of them each document has four shares (symbols,
capitals, repeated lines, repeated words), and a document goes when one share lies above
the cutoff of its stratum.  A cutoff may be used only if labelled documents prove it:
with ``x`` of the stratum's ``n`` good documents above the cutoff, the exact binomial tail
P(X <= x | n, alpha / rules) must not exceed ``delta`` divided by the number of strata times
that of rules (Bonferroni).  A rule's cutoffs are tested in a fixed sequence, from the most lenient
on, up to the first that is not proven; so their number costs no confidence.  (``x`` only grows
on the way, and the tail with it: those before the first failure are just those that pass.)
With confidence ``1 - delta`` no stratum then loses more than ``alpha`` of its good documents to the rules.  Of the proven cutoffs of a rule the
one with the largest surplus of bad over good documents above it is taken, and none if
there is no surplus; on a tie, the most lenient.

Defined cases: a null text counts as empty (no words, base_failed).  A null stratum is a
stratum of its own.  A document labelled repeatedly counts once, with its worst label;
null labels and labels of unknown documents do not count.  Without labels only the base rules hold.
Repeated rows each get a row.  Other columns pass through; columns of the names in
``FEATURES`` and ``VERDICT`` are replaced.
"""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import SPACE, let, set_aside, text_of, words_of
from termloom.sources.shared import materialize

FEATURES = [
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_capitals",
]
VERDICT = ["base_failed", "kept", "failed_rules"]


@dataclass(frozen=True)
class Risk:
    """alpha: most of a stratum's good documents that may be lost; delta: the chance that
    any stratum loses more.  Grids: the cutoffs tried, strictest first."""

    alpha: float = 0.04
    delta: float = 0.05
    min_words: int = 50
    max_repeat_percent: int = 50
    grids: dict = field(
        default_factory=lambda: {
            "symbols": (0.02, 0.05, 0.1, 0.15, 0.2, 0.3),
            "capitals": (0.1, 0.2, 0.3, 0.4, 0.5, 0.6),
            "lines": (0.1, 0.2, 0.3, 0.4, 0.5),
            "repeats": (0.1, 0.2, 0.3, 0.4),
        }
    )


SHARES = {
    "symbols": ("n_symbols", "word_chars"),
    "capitals": ("n_capitals", "word_chars"),
    "lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
}


def _repeat_words(words):
    """Words in three-word windows that occur twice or more in the same text."""

    def windows(w):
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: F.struct(
                F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"),
                i.alias("p"),
            ),
        )

    def repeated(s):
        def twin(x, i):
            before = F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
            return before | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False))

        covered = F.transform(
            F.filter(s, twin), lambda x: F.array(x["p"], x["p"] + 1, x["p"] + 2)
        )
        return F.size(F.array_distinct(F.flatten(covered)))

    def count(t):
        unique = F.size(F.array_distinct(F.transform(t, lambda x: x["h"])))
        return F.when(unique == F.size(t), 0).otherwise(let(F.array_sort(t), repeated))

    return let(words, lambda w: F.when(F.size(w) < 4, 0).otherwise(let(windows(w), count)))


def with_features(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds ``FEATURES``, all bigint."""
    text = text_of(text_column)
    words = words_of(text)
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.regexp_replace(x, SPACE, "")) > 0)
    line_counts = let(lines, lambda x: F.struct(F.size(x), F.size(F.array_distinct(x))))
    # One struct per row, so that the word list is made once for both its uses.
    counts = let(words, lambda w: F.struct(F.size(w).alias("n"), _repeat_words(w).alias("r")))
    df = docs.drop(*FEATURES).withColumns({"_words": counts, "_lines": line_counts})
    made = {
        "n_words": F.col("_words.n"),
        "word_chars": F.length(text) - F.regexp_count(text, F.lit(SPACE)),
        "n_symbols": F.regexp_count(text, F.lit("[#*$%&|<>]")),
        "n_dup_lines": F.col("_lines.col1") - F.col("_lines.col2"),
        "n_repeat_words": F.col("_words.r"),
        "n_lines": F.col("_lines.col1"),
        "n_capitals": F.regexp_count(text, F.lit("[A-Z]")),
    }
    # Made by a generator: filters on the features are then not pushed below it, where they
    # would compute them a second time.
    once = F.inline(F.array(F.struct(*(v.cast("bigint").alias(k) for k, v in made.items()))))
    return df.select(*(c for c in df.columns if c not in ("_words", "_lines")), once)


def base_failed(risk: Risk):
    repeats = 100 * F.col("n_repeat_words") > risk.max_repeat_percent * F.col("n_words")
    return (F.col("n_words") < risk.min_words) | repeats


def _share(rule: str):
    above, of = SHARES[rule]
    return F.col(above) / F.greatest(F.col(of), F.lit(1))


def _lower_tail(x, n, p: float):
    """P(X <= x) for X binomial with n draws of chance p, term by term in logarithms."""
    step = F.log(F.lit(p / (1 - p)))

    def more(state, i):
        term = state["term"] + F.log((n - i + 1) / i) + step
        total = F.greatest(term, state["total"])
        total = total + F.log1p(F.exp(F.least(term, state["total"]) - total))
        return F.struct(term.alias("term"), total.alias("total"))

    first = n * F.log1p(F.lit(-p))
    start = F.struct(first.alias("term"), first.alias("total"))
    steps = F.when(x > 0, F.sequence(F.lit(1).cast("bigint"), x)).otherwise(
        F.array().cast("array<bigint>")
    )
    return F.exp(F.aggregate(steps, start, more, lambda state: state["total"]))


def fit(
    features: DataFrame,
    labels: DataFrame,
    risk: Risk | None = None,
    stratum: str = "lang",
    id_column: str = "doc_id",
    label_column: str = "quality",
) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, good_above, bad_above)``: the cutoffs in force.

    ``features`` are documents with ``FEATURES``; a label of 1 means good, 0 bad.  The
    labelled documents are counted per cutoff before anything but narrow rows is shuffled.
    """
    risk = risk or Risk()
    worst = (
        labels.filter(F.col(label_column).isNotNull())
        .groupBy(F.col(id_column).alias("_id"))
        .agg(F.min(label_column).alias("_label"))
    )
    tried = F.array(
        *(
            F.struct(
                F.lit(rule).alias("rule"),
                F.lit(float(cut)).alias("cutoff"),
                (_share(rule) > cut).alias("above"),
            )
            for rule, grid in risk.grids.items()
            for cut in grid
        )
    )
    known = features.filter(~base_failed(risk)).select(
        F.col(id_column).alias("_id"), F.col(stratum).alias("stratum"), tried.alias("tried")
    )
    counted = (
        known.join(worst, "_id")
        .select("stratum", "_label", F.inline("tried"))
        .groupBy("stratum", "rule", "cutoff")
        .agg(
            F.count_if(F.col("_label") >= 1).alias("n_good"),
            F.count_if((F.col("_label") >= 1) & F.col("above")).alias("good_above"),
            F.count_if((F.col("_label") < 1) & F.col("above")).alias("bad_above"),
        )
    )
    counted = materialize(counted, "quality-counts")
    n_sequences = counted.select("stratum", "rule").distinct().count()
    p = risk.alpha / len(risk.grids)
    # Where more than the allowed share is above the cutoff, the tail is far over delta.
    hopeful = counted.filter(F.col("good_above") <= p * F.col("n_good"))
    tail = _lower_tail(F.col("good_above"), F.col("n_good"), p)
    proven = (
        hopeful.filter(F.col("bad_above") > F.col("good_above"))
        .filter(tail <= risk.delta / max(n_sequences, 1))
    )
    best = F.max_by(
        F.struct("cutoff", "n_good", "good_above", "bad_above"),
        F.struct(F.col("bad_above") - F.col("good_above"), "cutoff"),
    )
    return proven.groupBy("stratum", "rule").agg(best.alias("b")).select("stratum", "rule", "b.*")


def apply(
    features: DataFrame,
    cutoffs: DataFrame,
    risk: Risk | None = None,
    stratum: str = "lang",
) -> DataFrame:
    """Adds ``VERDICT``: base_failed, kept and the names of the rules a document broke."""
    risk = risk or Risk()
    limits = cutoffs.groupBy(F.col("stratum").alias("_stratum")).agg(
        *(
            F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"_{rule}")
            for rule in risk.grids
        )
    )
    df = features.drop(*VERDICT)
    df = df.join(limits, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = [
        F.when(_share(rule) > F.col(f"_{rule}"), F.lit(rule)) for rule in risk.grids
    ]
    failed = reduce(lambda a, b: a | b, (F.coalesce(b.isNotNull(), F.lit(False)) for b in broken))
    return df.withColumns(
        {
            "base_failed": base_failed(risk),
            "kept": ~(base_failed(risk) | failed),
            "failed_rules": F.concat_ws(",", *broken),
        }
    ).drop("_stratum", *(f"_{rule}" for rule in risk.grids))


def judge(docs: DataFrame, labels: DataFrame, risk: Risk | None = None) -> DataFrame:
    """The verdict on every document: fitted on its labelled ones, without the texts."""
    keep = [c for c in docs.columns if c not in {"text", *FEATURES, *VERDICT}]
    features = materialize(with_features(docs).select(*keep, *FEATURES), "quality-features")
    return apply(features, fit(features, labels, risk), risk)


def keep_good(docs: DataFrame, labels: DataFrame, risk: Risk | None = None) -> DataFrame:
    """The documents that pass, with their own columns only.

    The features are computed twice, so that no text is shuffled or stored.
    """
    own, back = set_aside(docs, [*FEATURES, *VERDICT])
    cutoffs = materialize(
        fit(with_features(own).select("doc_id", "lang", *FEATURES), labels, risk),
        "quality-cutoffs",
    )
    good = apply(with_features(own), cutoffs, risk).filter("kept").select(own.columns)
    return good.withColumnsRenamed(back)

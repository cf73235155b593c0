"""Mixing sources to target weights by iterative proportional fitting, in DataFrame functions.

Documents are counted into cells (source, language, topic) before anything is shuffled; all later
work is on cells.  The cells' tokens are raked: each marginal in turn is scaled to its target
shares, ``sweeps`` times.  A document of a cell is then taken with probability
``min(1, c * raked / tokens)``, and ``c`` is calibrated so that the expected tokens are ``fraction`` of
all tokens.  Whether a document is taken depends on its id alone, so a rerun takes the same.

Without given targets each marginal's shares are its own to the power ``flatten``, made to
sum to 1 (0: equal weights, 1: as they are).

Defined cases: a null text has no tokens; nulls in a marginal are one value with the empty string.
Values without a target, and cells without tokens, get weight 0 and are not taken; targets of
values that do not occur are left out and the rest is scaled up.  No tokens at all: nothing is taken.
Repeated rows share their fate.  Other columns pass through; columns in ``MADE`` are replaced.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from termloom.llm.common import WORD, set_aside, text_of
from termloom.sources.shared import broadcast_within, materialize, rows_up_to_limit

MADE = ["topic", "n_tokens", "weight", "probability", "taken"]
MARGINALS = ["source", "lang", "topic"]
SWEEPS_PER_WRITE = 2


@dataclass(frozen=True)
class Mix:
    fraction: float = 0.5
    flatten: float = 0.5
    sweeps: int = 8
    seed: str = "mix"


def topic_of(text: Column) -> Column:
    """A topic by form, for tables that have none."""
    return (
        F.when(F.contains(text, F.lit(" | ")), "table")
        .when(F.contains(text, F.lit("###")), "symbols")
        .when(F.contains(text, F.lit("@")), "contact")
        .when(F.contains(text, F.lit("icense")), "legal")
        .when(F.length(text) < 1000, "short")
        .otherwise("long")
    )


def _value(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def cells_of(docs: DataFrame, marginals: list[str] = MARGINALS) -> DataFrame:
    """Tokens per cell; ``docs`` needs the marginals and ``n_tokens``."""
    return docs.groupBy(*(_value(m).alias(m) for m in marginals)).agg(
        F.sum("n_tokens").cast("double").alias("tokens")
    )


def own_targets(cells: DataFrame, marginal: str, flatten: float) -> DataFrame:
    """``(value, share)``: shares to the power ``flatten``; they need not sum to 1."""
    sums = cells.groupBy(F.col(marginal).alias("value")).agg(F.sum("tokens").alias("tokens"))
    return sums.filter(F.col("tokens") > 0).select(
        "value", F.pow("tokens", F.lit(flatten)).alias("share")
    )


def rake(
    cells: DataFrame,
    targets: dict[str, DataFrame] | None = None,
    marginals: list[str] = MARGINALS,
    mix: Mix | None = None,
) -> DataFrame:
    """``cells`` with ``weight``, whose marginals have the target shares.

    A marginal's sums are windows over the cells, so a sweep is three shuffles of cells and no join; every few
    sweeps are written out.
    """
    mix = mix or Mix()
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    raked = cells.withColumn("weight", F.col("tokens"))
    for i, m in enumerate(marginals):
        wanted = (targets or {}).get(m)
        wanted = own_targets(cells, m, mix.flatten) if wanted is None else wanted
        here = cells.filter(F.col("tokens") > 0).select(F.col(m).alias("value")).distinct()
        wanted = wanted.withColumn("value", _value("value")).groupBy("value").agg(F.sum("share").alias("share"))
        wanted = materialize(wanted.join(here, "value", "left_semi"), f"mix-{m}")
        whole = wanted.agg(F.sum("share")).first()[0] or 1.0
        goal = (F.col("share") / whole * total).alias(f"_goal{i}")
        raked = raked.join(wanted.select(F.col("value").alias(m), goal), m, "left")
    raked = raked.select(*cells.columns, "weight", *(F.coalesce(f"_goal{i}", F.lit(0.0)).alias(f"_goal{i}") for i in range(len(marginals))))
    for sweep in range(mix.sweeps):
        for i, m in enumerate(marginals):
            now = F.sum("weight").over(W.partitionBy(m))
            raked = raked.withColumn("_now", now).withColumn(
                "weight", F.when(F.col("_now") > 0, F.col("weight") * F.col(f"_goal{i}") / F.col("_now")).otherwise(0.0)
            )
        if sweep % SWEEPS_PER_WRITE == SWEEPS_PER_WRITE - 1 or sweep == mix.sweeps - 1:
            raked = materialize(raked.drop("_now"), "mix-sweep")
    return raked.select(*cells.columns, "weight")


def calibrate(raked: DataFrame, fraction: float) -> DataFrame:
    """Adds ``probability``: proportional to weight per token, at most 1, and worth ``fraction``
    of all tokens.

    Cells that would be taken more than wholly are fixed at 1 and the rest is scaled up, until no
    further cell is over; each step raises the factor, so a step per fixed cell is the most.
    """
    df = raked.withColumn(
        "_rate", F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    )
    factor, full = 0.0, -1
    budget = fraction * (df.agg(F.sum("tokens")).first()[0] or 0.0)
    while True:
        over = F.col("_rate") * factor >= 1
        now = df.agg(
            F.count_if(over),
            F.coalesce(F.sum(F.when(over, F.col("tokens"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)),
        ).first()
        if now[0] == full or now[2] <= 0:
            break
        full, factor = now[0], max(factor, (budget - now[1]) / now[2])
    return df.withColumn("probability", F.least(F.lit(1.0), F.col("_rate") * factor)).drop("_rate")


def chance_of(id_column: str, seed: str) -> Column:
    """A number in [0, 1) that depends on the id and the seed alone."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("bigint") / F.lit(float(1 << 32))


def with_measures(docs: DataFrame, topic: str | None = None) -> DataFrame:
    df = docs.drop(*MADE) if topic is None else docs.drop(*(c for c in MADE if c != topic))
    made = {"n_tokens": F.regexp_count(text_of(), F.lit(WORD)).cast("bigint")}
    made["topic"] = topic_of(text_of()) if topic is None else F.col(topic)
    return df.withColumns(made)


def attach(measured: DataFrame, cells: DataFrame, mix: Mix) -> DataFrame:
    """Each document with its cell's weight and probability, and whether it is taken."""
    small = cells.select(
        *(F.col(m).alias(f"_{m}") for m in MARGINALS),
        "probability",
        (F.col("weight") / F.when(F.col("tokens") > 0, F.col("tokens"))).alias("weight"),
    )
    small = broadcast_within(small, rows_up_to_limit(small))
    on = [_value(m) == F.col(f"_{m}") for m in MARGINALS]
    joined = measured.join(small, on, "left").drop(*(f"_{m}" for m in MARGINALS))
    taken = chance_of("doc_id", mix.seed) < F.coalesce("probability", F.lit(0.0))
    return joined.withColumns({"weight": F.coalesce("weight", F.lit(0.0)), "taken": taken})


def plan(measured: DataFrame, targets=None, mix: Mix | None = None) -> DataFrame:
    """The calibrated cells of ``measured`` documents."""
    mix = mix or Mix()
    cells = materialize(cells_of(measured), "mix-cells")
    return materialize(calibrate(rake(cells, targets, mix=mix), mix.fraction), "mix-plan")


def weigh(docs: DataFrame, targets=None, mix: Mix | None = None) -> DataFrame:
    """``docs`` without the text, with ``MADE``."""
    mix = mix or Mix()
    measured = materialize(with_measures(docs).drop("text"), "mix-measures")
    return attach(measured, plan(measured, targets, mix), mix)


def sample(docs: DataFrame, targets=None, mix: Mix | None = None) -> DataFrame:
    """The documents taken, with their own columns; no text is shuffled or stored."""
    mix = mix or Mix()
    own, back = set_aside(docs, MADE)
    measured = with_measures(own)
    cells = plan(measured.select(*MARGINALS, "n_tokens"), targets, mix)
    taken = attach(measured, cells, mix).filter("taken").select(own.columns)
    return taken.withColumnsRenamed(back)

"""Removal of repeated passages: seed on winnowed anchors, extend, keep the maximal repeats.

A window is ``WINDOW`` consecutive words of one text; a word goes if a window covers it whose words
also start anywhere else.

*Seeds.*  The least hash of the ``SEED``-word grams in a window is its anchor.  Equal windows have
equal anchors, so any repeat of a full window shares one.  Neighbouring windows share theirs too:
a *run* is a stretch of windows with one anchor, some fifteen on average.
*Join.*  Documents meet on anchors: an anchor of one text only is no seed.
*Extend.*  A run is extended both ways as far as its anchor reaches.  Runs of the same anchor that are
equal in whole repeat in whole.  Where an anchor has different runs, the single ones are compared
window by window with the others, one run of each kind standing for its equals.
*Maximal repeats.*  All repeated windows of a text, with those that repeat inside it, are
joined to the longest stretches.

No pairs of occurrences are made: groups are reduced to the least and the greatest text in them, which
says whether a second one exists, and are joined back; so a passage in a third of all texts is a
skewed key of a join that the planner can split, never a list.  Texts are named by 64-bit hashes,
runs and windows by two such hashes each (their anchor's and their own).

Defined cases: a null text has no words; a text shorter than a window loses nothing.  Repeated rows
and equal texts are copies: all their windows start elsewhere.  Other columns pass through;
columns of the names in ``MADE`` are replaced.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import text_of
from termloom.llm.hashing import RunHasher, WordHasher, mix
from termloom.sources.shared import materialize

WINDOW, SEED = 35, 8
MADE = ["n_words", "n_removed", "kept", "spans"]
# Texts remembered by a task, so that it names the runs of its copies once.
SEEN = 500_000
WHOLE = -1


class Reader:
    """Runs and windows of one text, by hashes."""

    def __init__(self):
        self.hashes = WordHasher()
        self.grams, self.windows = RunHasher(0x9FB21C651E98DF25), RunHasher(0xD6E8FEB86659FD93)

    def window_hashes(self, words: np.ndarray, sums: np.ndarray | None = None) -> np.ndarray:
        at = np.arange(len(words) - WINDOW + 1)
        return self.windows.runs(self.windows.sums(words) if sums is None else sums, at, at + WINDOW)

    def runs(self, words: np.ndarray):
        """(anchor, hash of the whole run, first window, number of windows) as arrays, equal runs
        once; and the stretches of windows that repeat inside the text as (first, number)."""
        at = np.arange(len(words) - SEED + 1)
        grams = self.grams.runs(self.grams.sums(words), at, at + SEED)
        views = sliding_window_view(grams, WINDOW - SEED + 1)
        first = views.argmin(axis=1) + np.arange(len(views))
        last = len(views[0]) - 1 - views[:, ::-1].argmin(axis=1) + np.arange(len(views))
        if (first != last).any():
            first = self._stay(grams, first, last)
        start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
        count = np.diff(np.r_[start, len(first)])
        sums = self.windows.sums(words)
        whole = self.windows.runs(sums, start, start + count - 1 + WINDOW)
        anchor = grams[first[start]]
        _, once = np.unique(mix(anchor) ^ whole, return_index=True)

        ordered = np.sort(windows := self.window_hashes(words, sums))
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        again = np.isin(windows, twice) if len(twice) else np.zeros(0, dtype=bool)
        turns = np.flatnonzero(np.diff(np.r_[0, again.astype(np.int8), 0]))
        own = (turns[::2], turns[1::2] - turns[::2])
        return (anchor[once], whole[once], start[once], count[once]), own

    @staticmethod
    def _stay(grams: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Among equal grams an anchor is kept until it leaves: periodic texts get long runs."""
        least, chosen = grams[first].tolist(), []
        values, last, now = grams.tolist(), last.tolist(), -1
        for i, value in enumerate(least):
            if now < i or values[now] != value:
                now = last[i]
            chosen.append(now)
        return np.array(chosen)


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def runs_of(texts: DataFrame) -> DataFrame:
    """``(anchor, run, key, start, count)`` from ``(key, text)``; equal runs of a text once.

    Rows without an anchor are stretches of windows that repeat inside the text.
    """
    schema = "anchor long, run long, key long, start int, count int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, seen = Reader(), set()
        for batch in batches:
            for part in _parts(batch):
                made, own = [], []
                for key, text in zip(part["key"].tolist(), part["text"], strict=True):
                    if key in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(key)
                    words = reader.hashes(text)
                    if len(words) >= WINDOW:
                        (anchor, whole, start, count), (first, number) = reader.runs(words)
                        made.append((anchor, whole, np.full(len(start), key), start, count))
                        own += [(key, a, n) for a, n in zip(first.tolist(), number.tolist(), strict=True)]
                if made:
                    a, r, k, s, c = (np.concatenate(x) for x in zip(*made, strict=True))
                    yield pd.DataFrame(
                        {"anchor": _signed(a), "run": _signed(r), "key": k, "start": s, "count": c}
                    )
                if own:
                    found = pd.DataFrame(own, columns=["key", "start", "count"])
                    found = found.assign(anchor=None, run=None)
                    yield found[["anchor", "run", "key", "start", "count"]]

    return texts.mapInPandas(run, schema)


def _parts(batch: pd.DataFrame, rows: int = 300) -> Iterator[pd.DataFrame]:
    for start in range(0, len(batch), rows):
        yield batch.iloc[start : start + rows]


def _windows_of(asked: DataFrame) -> DataFrame:
    """The windows of the runs ``asked`` of each text: ``(anchor, window, key, at, single)``."""
    schema = "anchor long, window long, key long, at int, single boolean"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, seen = Reader(), set()
        for batch in batches:
            for part in _parts(batch):
                made = []
                for key, text, runs in zip(part["key"].tolist(), part["text"], part["runs"], strict=True):
                    if key in seen:
                        continue
                    if len(seen) < SEEN:
                        seen.add(key)
                    hashes = reader.window_hashes(reader.hashes(text))
                    for r in runs:
                        at = np.arange(r["start"], r["start"] + r["count"])
                        n = len(at)
                        made.append(
                            (np.full(n, r["anchor"]), _signed(hashes[at]), np.full(n, key), at, np.full(n, r["single"]))
                        )
                if made:
                    a, w, k, s, one = (np.concatenate(x) for x in zip(*made, strict=True))
                    yield pd.DataFrame({"anchor": a, "window": w, "key": k, "at": s, "single": one})

    return asked.mapInPandas(run, schema)


def repeated(texts: DataFrame) -> DataFrame:
    """``(key, start, count)``: stretches of windows of a text that also start elsewhere.

    ``texts``: ``(key, text)`` and any other columns.  A count of ``WHOLE`` stands for all windows of a text.
    """
    every = materialize(runs_of(texts.select("key", "text")), "repeats-runs")
    runs = every.filter(F.col("anchor").isNotNull())
    per_anchor = runs.groupBy("anchor").agg(
        F.min("key").alias("low"),
        F.max("key").alias("high"),
        (F.min("run") != F.max("run")).alias("mixed"),
    )
    seeds = per_anchor.filter(F.col("low") != F.col("high")).select("anchor", "mixed")
    seeds = materialize(seeds, "repeats-seeds")
    met = materialize(runs.join(seeds, "anchor"), "repeats-met").distinct()

    per_run = (
        met.filter("mixed")
        .groupBy("anchor", "run")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
    )
    mixed = met.filter("mixed").join(per_run, ["anchor", "run"])
    mixed = materialize(mixed.withColumn("single", F.col("low") == F.col("high")), "repeats-mixed")
    equal = met.filter(~F.col("mixed")).unionByName(mixed.filter(~F.col("single")).drop("low", "high", "single"))

    # The single runs, and of each kind of equal ones the run of the least text.
    asked = mixed.filter(F.col("single") | (F.col("key") == F.col("low")))
    asked = asked.groupBy("key").agg(
        F.collect_set(F.struct("anchor", "start", "count", "single")).alias("runs")
    )
    # All columns of the texts are asked for, so that one shuffle of them serves this join and the
    # one that removes the repeats.
    windows = _windows_of(texts.join(asked, "key"))
    partners = (
        windows.groupBy("anchor", "window")
        .agg(F.min("key").alias("low"), F.max("key").alias("high"))
        .filter(F.col("low") != F.col("high"))
        .select("anchor", "window")
    )
    alone = windows.filter("single").join(partners, ["anchor", "window"])

    copies = texts.groupBy("key").count().filter(F.col("count") > 1)
    return (
        every.filter(F.col("anchor").isNull())
        .select("key", "start", "count")
        .unionByName(equal.select("key", "start", "count"))
        .unionByName(alone.select("key", F.col("at").alias("start"), F.lit(1).alias("count")))
        .unionByName(copies.select("key", F.lit(0).alias("start"), F.lit(WHOLE).alias("count")))
    )


def without_repeats(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """``docs`` with ``MADE`` in place of the text: the words kept, joined by one space, and the
    removed spans (first word, end) of the text."""
    others = [c for c in docs.columns if c not in {text_column, *MADE}]
    text = text_of(text_column)
    texts = docs.select(
        *(F.col(c).alias(f"_{c}") for c in others),
        F.xxhash64(text).alias("key"),
        text.alias("text"),
    )
    found = repeated(texts).groupBy("key").agg(
        F.collect_set(F.struct("start", "count")).alias("stretches")
    )
    joined = texts.join(found, "key", "left")
    names = {f"_{c}": c for c in others}
    kept = [T.StructField(c, docs.schema[c].dataType) for c in others]
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    made = [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
        T.StructField("spans", T.ArrayType(span)),
    ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in _parts(batch):
                rows = [_cut(t, s) for t, s in zip(part["text"], part["stretches"], strict=True)]
                yield part[list(names)].rename(columns=names).assign(
                    **{name: pd.Series([r[i] for r in rows], part.index, object if i > 1 else "int64")
                       for i, name in enumerate(MADE)}
                )

    return joined.mapInPandas(run, T.StructType([*kept, *made]))


def _cut(text: str, stretches) -> tuple[int, int, str, list]:
    words = text.encode().split()
    n = len(words)
    if stretches is None or not len(stretches):
        return n, 0, b" ".join(words).decode(), []
    edges = np.zeros(n + 1, dtype=np.int64)
    for s in stretches:
        whole = s["count"] == WHOLE
        if not whole or n >= WINDOW:
            edges[0 if whole else s["start"]] += 1
            edges[n if whole else s["start"] + s["count"] - 1 + WINDOW] -= 1
    covered = np.cumsum(edges[:n]) > 0
    kept = b" ".join([w for w, gone in zip(words, covered.tolist(), strict=True) if not gone])
    turns = np.flatnonzero(np.diff(np.r_[0, covered.astype(np.int8), 0])).tolist()
    spans = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2], strict=True)]
    return n, int(covered.sum()), kept.decode(), spans

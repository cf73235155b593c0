"""Near-duplicate documents: DartMinHash signatures, banded join, exact check, classes.

*Signatures.*  A document is a weighted set of shingles (five words; a shorter text is one
shingle).  Each element owns the region [0, weight) x [0, oo) of a plane; hashing throws darts
into it, the same ones in every document that has the element.  Of all darts below the height
``t / total weight`` each dart belongs to one of ``K`` coordinates, and the lowest of a coordinate is its
value: two documents agree there with the chance of their weighted Jaccard similarity.  The plane
is cut into cells, so that only some ``t = K ln K + 2 K`` darts are made for a document, whatever
its length; coordinates left empty get another go at twice the height.

*Candidates.*  ``BANDS`` bands of ``ROWS`` coordinates each name a bucket.  Within a bucket no
pairs are listed: every member is compared with two of them, the most central one and another.  Central is
who is in large buckets: near the middle of a group more members are within reach.
At similarity 0.8 a pair shares a bucket with a chance of 0.9998.
*Check.*  The Jaccard similarity of each compared pair is computed from its shingles.
*Classes.*  Connected components of all links.  Before they are known, nodes near one least node count as a class:
one member of each class of a bucket meets one of its largest class and one of another class.
*Rest.*  Buckets that then still hold several classes are settled exactly: of the members of such buckets
all pairs of different classes are compared, but for those that a prefix filter proves to be less
similar and those that are of one class after some have been compared.  Shingles are put in one order, rare ones first; two texts similar enough have their
first common shingle so early in both that enough shingles are left after it.

Copies are one text from the start: a group of copies is one node.  Texts are named by two 64-bit hashes.

Defined cases: texts without a word (null, empty, blank) are alone in a class.  The class id is
the least doc_id of the class; null ids are in classes like others, and a class of null ids has a null
class id.  Repeated rows are copies; one of them stays.  Other columns pass through, whatever their
names; those in ``MADE`` are replaced.
"""

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm.common import WORD, small_batches, text_keys, text_of
from termloom.llm.components import connected
from termloom.llm.hashing import U64, RunHasher, WordHasher, mix, unit
from termloom.sources.shared import broadcast_within, materialize, rows_up_to_limit

SHINGLE = 5
LEAST_SIMILARITY = 0.8
BANDS, ROWS = 16, 4
K = BANDS * ROWS
MADE = ["class_id", "class_size", "kept"]
# Of the shingles of two texts together, the share that similar enough ones have in common.
COMMON = LEAST_SIMILARITY / (1 + LEAST_SIMILARITY)
# Counters by which shingles are put in order; two in one counter only look more frequent.
COUNTERS = 1 << 20
# More pairs than this are compared in waves: one pair of so many, then of those left.
WAVE_PAIRS = 10_000
WAVES = (16, 4)
# A shingle that begins more texts than this meets its other join side in several pieces.
PIECE_ROWS = 1_000
# Heights of the cells below 1, lowest first; from 1 on every cell has height 1.
LOW = [0.0, *(2.0**-i for i in range(6, 0, -1))]
HEIGHTS = np.diff([*LOW, 1.0])
# Chances of at most 0, 1, ... darts in a cell of such an area.
POISSON = {
    area: np.cumsum([math.exp(-area) * area**i / math.factorial(i) for i in range(25)])
    for area in {*HEIGHTS.tolist(), 1.0}
}
# Elements handled at once, so that very long texts need no more memory than short ones.
ELEMENTS = 30_000
STEP = U64(0x9E3779B97F4A7C15)


def _cells(height: np.ndarray) -> np.ndarray:
    """How many cells begin below each height."""
    below = np.searchsorted(LOW, height, side="left")
    return np.where(height > 1, len(LOW) + np.ceil(height) - 1, below).astype(np.int64)


def _darts(elements: np.ndarray, weights: np.ndarray, heights: np.ndarray, owner: np.ndarray, k: int):
    """(owner, coordinate, height, name) of all darts in the elements' regions."""
    strips = np.ceil(weights).astype(np.int64)
    per = strips * _cells(heights)
    at = np.repeat(np.arange(len(elements)), per)
    order = np.arange(len(at)) - np.repeat(np.cumsum(per) - per, per)
    strip, cell = order % strips[at], order // strips[at]
    low = np.where(cell < len(LOW), np.take(LOW, np.minimum(cell, len(LOW) - 1)), cell - len(LOW) + 1.0)
    tall = np.where(cell < len(LOW), np.take(HEIGHTS, np.minimum(cell, len(LOW) - 1)), 1.0)
    h = mix(elements[at] + STEP * (cell.astype(U64) * U64(1 << 20) + strip.astype(U64) + U64(1)))
    chance, count = unit(h), np.zeros(len(at), dtype=np.int64)
    for area, sums in POISSON.items():
        same = tall == area
        count[same] = np.searchsorted(sums, chance[same], side="right")
    which = np.repeat(np.arange(len(at)), count)
    number = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
    name = mix(h[which] + STEP * (number.astype(U64) + U64(1)))
    height = low[which] + tall[which] * unit(mix(name ^ U64(0xA5A5A5A5A5A5A5A5)))
    width = strip[which] + unit(mix(name ^ U64(0x5A5A5A5A5A5A5A5A)))
    from_ = at[which]
    inside = (height < heights[from_]) & (width < weights[from_])
    name = name[inside]
    return owner[from_][inside], (name % U64(k)).astype(np.int64), height[inside], mix(name + STEP)


def signatures(sets: list[np.ndarray], weights: list[np.ndarray] | None = None, k: int = K) -> np.ndarray:
    """One row of ``k`` values per set of 64-bit elements; empty sets get zeros."""
    out = np.zeros((len(sets), k), dtype=U64)
    todo = [i for i, s in enumerate(sets) if len(s)]
    darts = k * math.log(k) + 2 * k
    while todo:
        left: list[int] = []
        start = 0
        while start < len(todo):
            stop, size = start, 0
            while stop < len(todo) and (stop == start or size + len(sets[todo[stop]]) <= ELEMENTS):
                size += len(sets[todo[stop]])
                stop += 1
            part = todo[start:stop]
            start = stop
            loads = [weights[i] if weights else np.ones(len(sets[i])) for i in part]
            height = np.array([darts / w.sum() for w in loads])
            sizes = [len(sets[i]) for i in part]
            owner, place, rank, name = _darts(
                np.concatenate([sets[i] for i in part]),
                np.concatenate(loads),
                np.repeat(height, sizes),
                np.repeat(np.arange(len(part)), sizes),
                k,
            )
            slot = owner * k + place
            first = np.lexsort((name, rank, slot))
            slots, where = np.unique(slot[first], return_index=True)
            rows, columns = np.array(part)[slots // k], slots % k
            out[rows, columns] = name[first][where]
            full = np.bincount(slots // k, minlength=len(part)) == k
            left += [i for i, done in zip(part, full, strict=True) if not done]
        todo, darts = left, darts * 2
    return out


class Shingler:
    def __init__(self):
        self.hashes, self.runs = WordHasher(), RunHasher(0x2545F4914F6CDD1D)

    def __call__(self, text) -> np.ndarray:
        """The distinct shingles of a text as sorted 64-bit hashes."""
        words = self.hashes(text)
        if not len(words):
            return words
        starts = np.arange(max(1, len(words) - SHINGLE + 1))
        sums = self.runs.sums(words)
        return np.unique(self.runs.runs(sums, starts, np.minimum(starts + SHINGLE, len(words))))


def sketch(df: DataFrame) -> DataFrame:
    """``(k1, k2, id, bands)`` from ``(k1, k2, id, text)``: the bucket of each band, for texts with words."""
    names = ["k1", "k2", "id"]
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        salts = mix(np.arange(1, BANDS + 1, dtype=U64) * STEP)
        powers = np.array([pow(0x9E3779B97F4A7C15, i, 1 << 64) for i in range(ROWS)], dtype=U64)
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start : start + 500]
                sets = [shingler(t) for t in part["text"]]
                values = signatures(sets).reshape(len(sets), BANDS, ROWS)
                keys = mix((values * powers).sum(axis=2, dtype=U64) + salts).view(np.int64)
                full = [len(s) > 0 for s in sets]
                bands = pd.Series([list(map(int, row)) for row in keys], part.index, dtype=object)
                yield part[names].assign(bands=bands)[full]

    return df.mapInPandas(run, schema)


def shingle_sets(df: DataFrame) -> DataFrame:
    """``(node, shingles)`` from ``(node, text)``; 32 bits of each hash, sorted, as bytes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingler = Shingler()
        for batch in batches:
            for start in range(0, len(batch), 500):
                part = batch.iloc[start : start + 500]
                sets = [np.unique((shingler(t) >> U64(32)).astype(np.uint32)).tobytes() for t in part["text"]]
                yield pd.DataFrame({"node": part["node"].to_numpy(), "shingles": pd.Series(sets, dtype=object)})

    return df.mapInPandas(run, "node long, shingles binary")


def _similar(pairs: DataFrame) -> DataFrame:
    """Of ``(a, b, sa, sb)`` the pairs whose similarity reaches the limit."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            good = []
            for sa, sb in zip(batch["sa"], batch["sb"], strict=True):
                a, b = np.frombuffer(sa, np.uint32), np.frombuffer(sb, np.uint32)
                if min(len(a), len(b)) < LEAST_SIMILARITY * max(len(a), len(b)):
                    good.append(False)
                    continue
                both = len(np.intersect1d(a, b, assume_unique=True))
                good.append(both >= LEAST_SIMILARITY * (len(a) + len(b) - both))
            yield batch.loc[good, ["a", "b"]]

    return pairs.mapInPandas(run, "a long, b long")


def _checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The links among distinct ``(a, b)``.  ``b`` is often the same: its side may be skewed."""
    with_a = pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
    both = with_a.join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
    return _similar(both.select("a", "b", "sa", "sb"))


def _own(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with ``k1``, ``k2``, ``id`` and ``text`` beside its own columns under names of no clash."""
    names = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    named = docs.withColumnsRenamed(names)
    text = text_of(names["text"])
    k1, k2 = text_keys(text)
    return named.withColumns({"k1": k1, "k2": k2, "id": F.col(names["doc_id"]), "text": text}), names


def _known(keyed: DataFrame) -> DataFrame:
    """``(k1, k2, n, root, class_id, class_size, least, twice)`` of every text with words.

    ``least`` is the name and id of the document of the class that stays, ``twice`` whether rows share both
    with another.
    """
    texts = keyed.select("k1", "k2", "id", "text")
    with small_batches(keyed.sparkSession):
        nodes = _nodes(texts)
        roots = materialize(roots_of(texts, nodes), "dedup-roots")
    rows = nodes.select("k1", "k2", "id", "n", "twice", "node").join(roots, "node", "left")
    rows = materialize(rows.withColumn("root", F.coalesce("root", "node")), "dedup-rows")
    first = F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2")
    # Written: a side that is a plain table lets the planner split a very large class.
    per_class = materialize(
        rows.groupBy("root").agg(
            F.min("id").alias("class_id"), F.sum("n").alias("class_size"), F.min(first).alias("least")
        ),
        "dedup-per-class",
    )
    known = rows.join(per_class, "root").drop("node", "id")
    return materialize(known, "dedup-known")


def classes(docs: DataFrame) -> DataFrame:
    """``docs`` without the text, with ``class_id``, ``class_size`` and ``kept``."""
    keyed, names = _own(docs)
    known = _known(keyed).select("k1", "k2", "class_id", "class_size", F.lit(True).alias("found"))
    rows = keyed.drop("text").join(known, ["k1", "k2"], "left")
    alone = F.col("found").isNull()
    class_id = F.when(alone, F.col("id")).otherwise(F.col("class_id"))
    passed = [F.col(new).alias(c) for c, new in names.items() if c not in ("text", *MADE)]
    return rows.select(
        *passed,
        class_id.alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("bigint").alias("class_size"),
        (alone | F.col("id").eqNullSafe(class_id)).alias("kept"),
    )


def _nodes(texts: DataFrame) -> DataFrame:
    """``(node, k1, k2, id, n, twice, bands)`` of each different text: its least id, how many rows have it, and
    whether several of them have the least id."""
    sketches = materialize(sketch(texts), "dedup-sketches")
    per_id = sketches.groupBy("k1", "k2", "id").agg(F.count("*").alias("n"), F.first("bands").alias("bands"))
    first = F.struct(F.col("id").isNull().alias("none"), "id")
    nodes = per_id.groupBy("k1", "k2").agg(
        F.min("id").alias("id"), F.sum("n").alias("n"),
        F.min_by(F.col("n") > 1, first).alias("twice"), F.first("bands").alias("bands"),
    )
    return materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "dedup-nodes")


def roots_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, root)`` of the nodes that are linked to others."""
    members = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = members.groupBy("bucket").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n")
    )
    shared = materialize(shared.filter(F.col("n") > 1), "dedup-buckets")
    members = materialize(members.join(shared, "bucket"), "dedup-shared-buckets")
    central = materialize(members.groupBy("node").agg(F.sum("n").alias("central")), "dedup-central")
    members = materialize(members.join(central, "node"), "dedup-members")

    # A copy stands for all: the row, or rows, of a node with its least id.
    wanted = materialize(
        nodes.join(members.select("node").distinct(), "node", "left_semi").select("k1", "k2", "id", "node"),
        "dedup-wanted",
    )
    same = (texts.k1 == wanted.k1) & (texts.k2 == wanted.k2) & texts.id.eqNullSafe(wanted.id)
    # By shuffle at every size, as ever larger inputs would need it.
    chosen = texts.join(wanted.hint("merge"), same).select("node", "text")
    sets = shingle_sets(chosen).groupBy("node").agg(F.first("shingles").alias("shingles"))
    sets = materialize(sets, "dedup-sets")

    hubs = members.groupBy("bucket", "low", "high").agg(F.max_by("node", F.struct("central", "node")).alias("hub"))
    ends = members.select("node", "bucket").join(hubs, "bucket")
    # In a bucket of three every pair meets, as there are two different ends.
    second = F.when(F.col("hub") == F.col("low"), F.col("high")).otherwise(F.col("low"))
    ends = ends.select("node", F.explode(F.array(F.col("hub"), second)).alias("b"))
    pairs = ends.filter(F.col("node") != F.col("b")).select(
        F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")
    )
    links = materialize(_checked(pairs.distinct(), sets), "dedup-links")
    roots = materialize(_provisional(links), "dedup-classes")
    members = members.select("node", "bucket")
    for find in (_between_classes, _rest):
        more = find(members, roots, sets)
        if more is None:
            break
        found, roots = _linked(roots, more, sets)
        links = links.unionByName(found)
    return connected(links)


def _linked(roots: DataFrame, pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The links among distinct written ``pairs``, but for pairs whose ends are of one class by then, and ``roots`` with them.

    Many pairs are compared in waves.  Two classes of many pairs are one after some of them, if they ever are.
    """
    waves = WAVES if rows_up_to_limit(pairs, WAVE_PAIRS) > WAVE_PAIRS else ()
    turn, links = F.xxhash64("a", "b"), []
    for share in waves:
        now = F.pmod(turn, F.lit(share)) == 0
        links.append(materialize(_checked(pairs.filter(now), sets), "dedup-links"))
        roots = _merged(roots, links[-1])
        apart = F.col("root_a") != F.col("root_b")
        pairs = materialize(_with_roots(pairs.filter(~now), roots).filter(apart).select("a", "b"), "dedup-left")
    links.append(materialize(_checked(pairs, sets), "dedup-links"))
    return reduce(DataFrame.unionByName, links), _merged(roots, links[-1])


def _with_roots(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """``(a, b, root_a, root_b)``; a node without links is its own root."""
    for end in ("a", "b"):
        of_end = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        pairs = pairs.join(of_end, end, "left").withColumn(f"root_{end}", F.coalesce(f"root_{end}", end))
    return pairs


def _merged(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots`` after further links: only the classes that these link are looked at again, whatever the number of links before."""
    ends = _with_roots(links, roots).filter(F.col("root_a") != F.col("root_b"))
    ends = ends.select(F.greatest("root_a", "root_b").alias("a"), F.least("root_a", "root_b").alias("b"))
    now = _provisional(materialize(ends.distinct(), "dedup-class-links"))
    now = materialize(now.select(F.col("node").alias("root"), F.col("root").alias("least")), "dedup-class-roots")
    moved = roots.join(now, "root", "left").select("node", F.coalesce("least", "root").alias("root"))
    added = now.select(F.col("root").alias("node"), F.col("least").alias("root")).join(roots, "node", "left_anti")
    return materialize(moved.unionByName(added), "dedup-classes")


def _provisional(links: DataFrame) -> DataFrame:
    """``(node, root)``: the least node within three links.

    Nodes of one root are of one class.  A class may still have several roots; pairs of these are compared
    for nothing.
    """
    back = links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    both = links.select("a", "b").unionByName(back)
    near = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    for _ in range(2):
        # Written, as it is read twice.
        near = materialize(near, "dedup-near")
        reach = both.join(near.withColumnRenamed("a", "b"), "b").select("a", "root")
        near = reach.unionByName(near).groupBy("a").agg(F.min("root").alias("root"))
    return near.withColumnRenamed("a", "node")


def _between_classes(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs across the classes of a bucket: one member of each class with one of the largest class and with
    one of another class; at most two pairs for each class of a bucket."""
    rows = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    pick = F.xxhash64("node", "bucket")
    per_class = rows.groupBy("bucket", "root").agg(F.min_by("node", pick).alias("node"), F.count("*").alias("size"))
    per_class = materialize(per_class, "dedup-picked")
    class_, turn = F.struct("root", "node"), F.xxhash64("root", "bucket")
    chosen = per_class.groupBy("bucket").agg(
        F.max_by(class_, F.struct("size", "root")).alias("largest"),
        F.max_by(class_, turn).alias("other"),
        F.count("*").alias("n"),
    )
    chosen = materialize(chosen.filter(F.col("n") > 1).select("bucket", F.array("largest", "other").alias("centers")), "dedup-centers")
    met = per_class.join(chosen, "bucket").select("root", "node", F.explode(F.array_distinct("centers")).alias("center"))
    pairs = met.filter(F.col("root") != F.col("center.root")).select(
        F.greatest("node", "center.node").alias("a"), F.least("node", "center.node").alias("b")
    )
    return materialize(pairs.distinct(), "dedup-pairs")


def _rest(members: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Pairs of different classes, of all nodes in buckets that still hold several classes: every
    pair that can reach the limit is among them."""
    rows = members.select("node", "bucket").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # In a bucket of three every pair has met already.
    held = rows.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")
    )
    held = held.filter((F.col("n") > 3) & (F.col("low") != F.col("high"))).select("bucket")
    nodes = materialize(rows.join(held, "bucket").select("node", "root").distinct(), "dedup-open")
    if nodes.isEmpty():
        return None
    left = materialize(sets.join(nodes, "node"), "dedup-open-sets")
    entries = materialize(_first_shingles(left, _frequencies(left)), "dedup-first")

    per_class = entries.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    shared = per_class.groupBy("shingle").agg(
        F.max_by("root", F.struct("n", "root")).alias("largest"),
        F.sum("n").alias("n"),
        F.count("*").alias("classes"),
    )
    pieces = F.ceil(F.col("n") / PIECE_ROWS).cast("int").alias("pieces")
    shared = materialize(shared.filter(F.col("classes") > 1).select("shingle", "largest", pieces), "dedup-shared")
    met = materialize(entries.join(shared, "shingle"), "dedup-met")
    # The largest class of a shingle meets the others there, but not itself.
    own = F.col("root") == F.col("largest")
    before = F.col("size") - F.col("at")
    a = met.filter(before + 1e-6 >= 2 * COMMON * F.col("size")).select(
        "shingle",
        F.pmod(F.xxhash64("node"), "pieces").cast("int").alias("piece"),
        F.explode(F.when(own, F.array(F.lit(False))).otherwise(F.array(F.lit(True), F.lit(False)))).alias("with_own"),
        F.col("node").alias("a"), F.col("root").alias("root_a"),
        F.col("size").alias("size_a"), before.alias("rest_a"),
    )
    b = met.select(
        "shingle",
        F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"),
        own.alias("with_own"),
        F.col("node").alias("b"), F.col("root").alias("root_b"),
        F.col("size").alias("size_b"), before.alias("rest_b"),
    )
    pairs = a.join(b, ["shingle", "piece", "with_own"]).filter(
        (F.col("root_a") != F.col("root_b"))
        & ((F.col("size_a") < F.col("size_b")) | ((F.col("size_a") == F.col("size_b")) & (F.col("a") < F.col("b"))))
        & (F.col("size_a") + 1e-6 >= LEAST_SIMILARITY * F.col("size_b"))
        & (F.least("rest_a", "rest_b") + 1e-6 >= COMMON * (F.col("size_a") + F.col("size_b")))
    )
    pairs = pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return materialize(pairs.distinct(), "dedup-pairs")


def _counter(shingles: np.ndarray) -> np.ndarray:
    return (shingles * np.uint32(0x9E3779B1)) >> np.uint32(32 - COUNTERS.bit_length() + 1)


def _frequencies(sets: DataFrame) -> np.ndarray:
    """In how many sets the shingles of each counter are."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(COUNTERS, dtype=np.int64)
        for batch in batches:
            for s in batch["shingles"]:
                np.add.at(total, _counter(np.frombuffer(s, np.uint32)), 1)
        used = np.flatnonzero(total)
        yield pd.DataFrame({"counter": used.astype(np.int32), "n": total[used]})

    per_task = sets.select("shingles").mapInPandas(run, "counter int, n long")
    # Counters not given are 1: the shingle is in one set.
    summed = per_task.groupBy("counter").agg(F.sum("n").alias("n")).filter(F.col("n") > 1).toArrow()
    out = np.ones(COUNTERS, dtype=np.int64)
    out[summed["counter"].to_numpy()] = summed["n"].to_numpy()
    return out


def _first_shingles(sets: DataFrame, frequencies: np.ndarray) -> DataFrame:
    """``(shingle, node, root, size, at)``: of each set the rarest shingles, as far as the first one
    in common with a similar set can be, but for those that no other set has."""
    schema = "shingle int, node long, root long, size int, at int"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for node, root, s in zip(batch["node"], batch["root"], batch["shingles"], strict=True):
                own = np.frombuffer(s, np.uint32)
                often = frequencies[_counter(own)]
                n = int(len(own) * (1 - LEAST_SIMILARITY) + 1e-6) + 1
                order = np.lexsort((own, often))[:n]
                at = np.flatnonzero(often[order] > 1)
                yield pd.DataFrame(
                    {
                        "shingle": own[order][at].view(np.int32), "node": node, "root": root,
                        "size": np.int32(len(own)), "at": at.astype(np.int32),
                    }
                )

    return sets.select("node", "root", "shingles").mapInPandas(run, schema)


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each class: the one with the least id.

    Only texts in classes of several rows are looked up; whole documents are moved where rows share id and text.
    """
    keyed, names = _own(docs)
    known = _known(keyed).filter(F.col("class_size") > 1)
    stays = (F.col("least.k1") == F.col("k1")) & (F.col("least.k2") == F.col("k2"))
    several = known.select("k1", "k2", "class_id", stays.alias("stays"), "twice")
    several = materialize(several, "dedup-several")
    small = broadcast_within(several, rows_up_to_limit(several))
    rows = keyed.drop("text").join(small, ["k1", "k2"], "left")
    left = rows.filter(F.col("stays").isNull() | (F.col("stays") & F.col("id").eqNullSafe(F.col("class_id"))))
    if not several.filter("stays AND twice").isEmpty():
        twice = F.coalesce("twice", F.lit(False))
        left = left.filter(~twice).unionByName(left.filter(twice).dropDuplicates(["k1", "k2"]))
    return left.select(*(F.col(new).alias(c) for c, new in names.items()))

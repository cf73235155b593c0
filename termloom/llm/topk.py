"""Exact top-k by Fagin's threshold algorithm.

Vectors are turned into integers.  A task holds blocks of vectors, each block with one sorted list
per dimension.  For a query, the lists are read in parallel from the end that helps it (from the
top where its component is positive, else from the bottom), first ``STRIDE`` entries deep; every vector
met is scored in full by random access.  The bound is the score of a fictitious vector made of
the values read last; no unseen vector can be better.  Reading stops when the bound is below the k-th best
score known to the task (equal scores could still win by their id).  Each block hands on its k best;
the best of all blocks are the result.

Queries are sent in groups of at most ``queries_per_pass`` (a bound on what is broadcast); every group
passes over all vectors.  Nothing is approximate and no vector is left out.

Defined cases: vectors that are null, or hold null or non-finite components, are neither queries
nor candidates.  Shorter vectors count as padded with zeros.  A query's own row is no candidate:
every row with its id counts as its own.  Scores must fit in 63 bits.  Repeated candidate rows are each
a candidate; a repeated query is answered once.  Null ids take no part.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.sources.shared import materialize

SCALE = 1024
STRIDE = 16
BLOCK = 8_192
FOUND = T.StructType(
    [T.StructField(n, T.LongType()) for n in ("query_id", "vec_id", "score")]
)


def integers(
    df: DataFrame, id_column: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``(id, v)`` with v = floor(1024 x) of every usable vector."""

    def usable(x):
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))

    made = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    good = F.col(vector).isNotNull() & F.col(id_column).isNotNull() & F.forall(vector, usable)
    return df.filter(good).select(F.col(id_column).cast("bigint").alias("id"), made.alias("v"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


class Block:
    """Vectors with the sorted list of each dimension, readable from either end."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        self.rising = np.argsort(x, axis=0, kind="stable")
        self.falling = self.rising[::-1]
        self.low = np.take_along_axis(x, self.rising, axis=0)
        self.high = self.low[::-1]

    def best(self, q: np.ndarray, own: int, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The (score, id) that may be among the k best; ``floor``: the task's k-th so far.

        The lists are read to depths that double, so that the bound is tested a few times only.
        """
        n, top = len(self.ids), q > 0
        used = q != 0
        seen = self.ids == own
        best: list[tuple[int, int]] = []
        depth, stop = 0, STRIDE
        while depth < n:
            stop = min(stop, n)
            met = np.zeros(n, dtype=bool)
            if used.any():
                rows = np.where(top, self.falling[depth:stop], self.rising[depth:stop])
                met[rows[:, used]] = True
            else:
                met[:] = True
            new = np.flatnonzero(met & ~seen)
            seen |= met
            scores = self.x[new] @ q
            if floor is not None:
                near = scores >= floor
                new, scores = new[near], scores[near]
            if len(new) > k:  # all that are no worse than the k-th stay, ties included
                near = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
                new, scores = new[near], scores[near]
            best += zip(map(int, scores), self.ids[new].tolist(), strict=True)
            best = sorted(best, key=lambda found: (-found[0], found[1]))[:k]
            bound = int(np.where(top, self.high[stop - 1], self.low[stop - 1]) @ q)
            known = [best[k - 1][0]] if len(best) == k else []
            known += [floor] if floor is not None else []
            if not used.any() or (known and bound < max(known)):
                break
            depth, stop = stop, 2 * stop
        return best


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, queries_per_pass: int = 4_096) -> DataFrame:
    """``(query_id, rank, vec_id, score)``; both inputs as ``integers`` makes them."""
    spark = vectors.sparkSession
    asked = queries.groupBy("id").agg(F.min("v").alias("v"))
    # Groups by hash, so that no total order is needed; at half the bound on average, the
    # largest group stays within it.
    groups = max(1, -(-asked.count() // (queries_per_pass // 2)))
    group_of = F.pmod(F.xxhash64("id"), F.lit(groups)).alias("group")
    asked = materialize(asked.select("id", "v", group_of), "topk-queries")
    parts = []
    for group in range(groups):
        rows = asked.filter(F.col("group") == group).orderBy("id").toPandas()
        if len(rows):
            shared = spark.sparkContext.broadcast((rows["id"].to_numpy(), list(rows["v"])))
            parts.append(vectors.mapInPandas(_searcher(shared, k), FOUND))
    if not parts:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _searcher(shared, k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, query_vectors = shared.value
        floors: dict[int, list[int]] = {}
        for batch in batches:
            for start in range(0, len(batch), BLOCK):
                part = batch.iloc[start : start + BLOCK]
                ids = part["id"].to_numpy(dtype=np.int64)
                width = max(max(map(len, part["v"])), max(map(len, query_vectors)), 1)
                x, q = _matrix(part["v"], width), _matrix(query_vectors, width)
                # Doubles are exact up to 2^53 and much faster to multiply.
                if int(np.abs(x).max()) * int(np.abs(q).max()) * width < 1 << 52:
                    x, q = x.astype(float), q.astype(float)
                block = Block(ids, x)
                out: list[tuple[int, int, int]] = []
                for i, query in enumerate(query_ids.tolist()):
                    kept = floors.setdefault(query, [])
                    floor = kept[k - 1] if len(kept) == k else None
                    best = block.best(q[i], query, k, floor)
                    if best:
                        floors[query] = sorted(kept + [s for s, _ in best], reverse=True)[:k]
                        out.extend((query, v, s) for s, v in best)
                yield pd.DataFrame(out, columns=["query_id", "vec_id", "score"], dtype="int64")

    return run

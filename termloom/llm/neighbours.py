"""Near-duplicate vectors by an inverted multi-index.

*Index.*  Equal vectors of a label are one node.  Two codebooks, learnt independently on the first and
the second half of the dimensions, make a grid of cells; every node lies in the cell of its nearest
codewords.  Each half is of the unit vector.
*Traversal.*  From a node the cells are visited in the order of the distance that a vector would at
least have to move to get into them (squared: the sum of both halves' distances to the bisecting
plane between the own and the other codeword), by the multi-sequence algorithm over the two
sorted lists.  It stops at a distance found on a sample, so that a vector of exactly the least
similarity, in a random direction, is met with a chance of ``target_recall``.  Nearer vectors are met more
often, and beyond the distance that the least similarity allows no cell can hold any.
*Verification.*  Only the own cell and cells with a larger number are visited, so each pair of cells meets
once.  Visitors and members of a cell meet in blocks of at most ``BLOCK_ROWS`` each; a block computes
its cosines in double precision and hands on, per node, the number of its links and one
neighbour-of-neighbours representative, never the pairs.
*Balls.*  The mean directions of large groups of close vectors of the sample lead balls of half the
angle of the least similarity.  Two members of a ball are linked without a comparison, and a ball with
all its members is one node of the graph.  A vector outside is linked with all members, or none, or is
compared with them, as its angle to the leader says.  A third of all rows may so be near copies of one vector.
*Components.*  Connected components of the representatives' links.

The models are fitted on ``sample_rows`` vectors at most, chosen by hash; all rows are indexed and searched.

Defined cases: vectors that are null, empty or zero, hold null or non-finite components, or whose label
or id is null link with nothing and are their own component (null for a null id).  Shorter vectors
count as padded with zeros.  Repeated rows are vectors of their own, linked with each other; a
repeated id is kept in each of its rows if it is the least of its component.  Other columns are left out.
"""

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.llm.common import bounded_sample, text_keys
from termloom.llm.components import connected
from termloom.sources.shared import broadcast_within, materialize

LEAST_COSINE = 0.98
TARGET_RECALL = 0.995
SAMPLE_ROWS = 20_000
# Rows of a label that a cell is meant to hold, and the most codewords of a half.
CELL_ROWS = 50
MOST_CODES = 1_024
STEPS = 8
# A ball holds at least this share of the sample; there are at most that many (the grid finds all other links).
BALL_SHARE = 0.002
MOST_BALLS = 400
BLOCK_ROWS = 2_048
# Angles closer than this to a bound are decided by the cosine itself.
SLACK = 1e-6


def unit_rows(x: np.ndarray) -> np.ndarray:
    """The rows at length 1, without overflow."""
    largest = np.abs(x).max(axis=1, keepdims=True, initial=0.0)
    x = x / np.where(largest > 0, largest, 1.0)
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1.0)


def _codewords(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's algorithm from distinct sample rows."""
    rows = np.unique(x, axis=0)
    words = rows[rng.permutation(len(rows))[:k]]
    for _ in range(STEPS):
        nearest = _squares(x, words).argmin(axis=1)
        sums = np.zeros_like(words)
        np.add.at(sums, nearest, x)
        count = np.bincount(nearest, minlength=len(words))[:, None]
        words = np.where(count > 0, sums / np.maximum(count, 1), words)
    return np.unique(words, axis=0)


def _squares(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    squares = (x * x).sum(axis=1)[:, None] - 2 * x @ words.T + (words * words).sum(axis=1)[None, :]
    return np.maximum(squares, 0.0)


def _to_planes(x: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest codeword of each row, and the squared distance to the plane before each other one."""
    squares = _squares(x, words)
    nearest = squares.argmin(axis=1)
    least = squares[np.arange(len(x)), nearest]
    apart = np.sqrt(_squares(words, words))
    np.fill_diagonal(apart, np.inf)
    planes = (squares - least[:, None]) / (2 * apart[nearest])
    planes[np.arange(len(x)), nearest] = 0.0
    return nearest, planes**2


def _within(first: np.ndarray, second: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Multi-sequence traversal: (i, j) by rising first[i] + second[j], as far as ``reach``."""
    a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
    heap, seen = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
    while heap and heap[0][0] <= reach:
        _, i, j = heapq.heappop(heap)
        yield int(a[i]), int(b[j])
        for p, q in ((i + 1, j), (i, j + 1)):
            if p < len(a) and q < len(b) and (p, q) not in seen:
                seen.add((p, q))
                heapq.heappush(heap, (first[a[p]] + second[b[q]], p, q))


@dataclass(frozen=True)
class Grid:
    """Codebooks of the two halves, how far to look, and the leaders of balls by label."""

    width: int
    words: tuple[np.ndarray, np.ndarray]
    reach: float
    leaders: dict[object, np.ndarray]  # per label: unit vectors
    numbers: dict[object, np.ndarray]  # per label: numbers of the balls
    least: float

    def halves(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return unit[:, : self.width // 2], unit[:, self.width // 2 :]

    def matrix(self, vectors) -> np.ndarray:
        out = np.zeros((len(vectors), self.width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        return out

    def cells(self, unit: np.ndarray) -> tuple[np.ndarray, list[list[int]]]:
        """The cell of each row, and the cells from there on that it visits, nearest first."""
        (near_a, a), (near_b, b) = (_to_planes(x, w) for x, w in zip(self.halves(unit), self.words, strict=True))
        across = len(self.words[1])
        home = near_a * across + near_b
        visits = []
        for i in range(len(unit)):
            met = (p * across + q for p, q in _within(a[i], b[i], self.reach))
            visits.append([cell for cell in met if cell >= home[i]])
        return home, visits

    def balls(self, label, unit: np.ndarray) -> tuple[np.ndarray, list[list[int]], list[list[int]]]:
        """Own ball (-1: none), balls linked as a whole, and balls to compare with.

        A member of a ball leaves the balls with smaller numbers to their members.
        """
        n = len(unit)
        own, whole, some = np.full(n, -1), [[] for _ in range(n)], [[] for _ in range(n)]
        if label not in self.leaders:
            return own, whole, some
        numbers = self.numbers[label]
        angle = _angles(unit, self.leaders[label])
        widest = np.arccos(self.least)
        inside = angle <= widest / 2 - SLACK
        has = inside.any(axis=1)
        own[has] = numbers[np.where(inside, angle, np.inf)[has].argmin(axis=1)]
        radius = widest / 2
        open_ = (own[:, None] < numbers[None, :]) & (angle <= widest + radius + SLACK)
        for i, j in zip(*np.nonzero(open_), strict=True):
            (whole if angle[i, j] + radius <= widest - SLACK else some)[i].append(int(numbers[j]))
        return own, whole, some


def _angles(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(a @ b.T, -1.0, 1.0))


def fit(
    nodes: DataFrame,
    n: int,
    least: float = LEAST_COSINE,
    target_recall: float = TARGET_RECALL,
    sample_rows: int = SAMPLE_ROWS,
    seed: int = 7,
) -> Grid:
    """Codebooks, reach and balls from a sample of ``nodes(node, label, v)``, of which there are ``n``."""
    width = max(2, nodes.agg(F.max(F.size("v"))).first()[0] or 0)
    sample = bounded_sample(nodes.select("node", "label", "v"), "node", sample_rows, "multi-index").toPandas()
    rng = np.random.default_rng(seed)
    empty = Grid(width, (np.zeros((1, width // 2)), np.zeros((1, width - width // 2))), 0.0, {}, {}, least)
    if not len(sample):
        return empty
    unit = unit_rows(empty.matrix(sample["v"]))
    labels = max(1, sample["label"].nunique())
    codes = int(np.clip(round((n / (CELL_ROWS * labels)) ** 0.5), 1, MOST_CODES))
    words = tuple(_codewords(half, codes, rng) for half in empty.halves(unit))
    grid = Grid(width, words, 0.0, {}, {}, least)
    reach = _reach(grid, unit[rng.permutation(len(unit))[:4_096]], target_recall, rng)
    leaders, numbers, number = {}, {}, 0
    for label, rows in sorted(sample.groupby("label").indices.items()):
        found = _leaders(unit[rows], len(sample), least)[: MOST_BALLS - number]
        if len(found):
            leaders[label], numbers[label] = found, np.arange(number, number + len(found))
            number += len(found)
    return Grid(width, words, reach, leaders, numbers, least)


def _reach(grid: Grid, unit: np.ndarray, recall: float, rng: np.random.Generator) -> float:
    """How far to look so that this share of neighbours at the least similarity is met."""
    side = rng.standard_normal(unit.shape)
    side = unit_rows(side - (side * unit).sum(axis=1, keepdims=True) * unit)
    moved = grid.least * unit + np.sqrt(1 - grid.least**2) * side
    far = np.zeros(len(unit))
    for x, y, words in zip(grid.halves(unit), grid.halves(moved), grid.words, strict=True):
        _, planes = _to_planes(x, words)
        far += planes[np.arange(len(x)), _squares(y, words).argmin(axis=1)]
    # No vector of the least similarity is farther away than this.
    return float(min(np.quantile(far, recall, method="higher"), 2 - 2 * grid.least)) + 1e-9


def _leaders(unit: np.ndarray, rows: int, least: float) -> np.ndarray:
    """Mean directions of groups of close vectors of a label, the largest groups first."""
    need = max(3, int(np.ceil(BALL_SHARE * rows)))
    half = np.cos(np.arccos(least) / 2 - SLACK)
    close = np.concatenate([(unit[i : i + 500] @ unit.T >= least).sum(axis=1) for i in range(0, len(unit), 500)])
    left, seeds, found = np.ones(len(unit), dtype=bool), close >= need, []
    for i in np.argsort(-close, kind="stable"):
        if not seeds[i]:
            continue
        group = unit @ unit[i] >= least
        seeds &= ~group
        center = unit_rows(unit[group & left].mean(axis=0, keepdims=True))[0] if left[group].any() else unit[i]
        inside = unit @ center >= half
        if left[inside].sum() >= need:
            found.append(center)
            left &= ~inside
    return np.array(found)


def place(nodes: DataFrame, grid: Grid) -> DataFrame:
    """``nodes`` with ``home``, ``visits``, ``ball``, ``whole`` and ``some``."""
    shared = nodes.sparkSession.sparkContext.broadcast(grid)
    made = "home int, visits array<int>, ball int, whole array<int>, some array<int>"
    label = nodes.schema["label"].dataType.simpleString()
    given = nodes.select("node", "label", "weight", "least_id", "v")
    types = f"node long, label {label}, weight long, least_id {nodes.schema['least_id'].dataType.simpleString()}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grid = shared.value
        for batch in batches:
            for name, part in batch.groupby("label", sort=False, dropna=False):
                unit = unit_rows(grid.matrix(part["v"]))
                home, visits = grid.cells(unit)
                own, whole, some = grid.balls(name, unit)
                lists = {"home": home, "visits": visits, "ball": own, "whole": whole, "some": some}
                # Members of balls meet the rest from there.
                lists["visits"] = [[] if ball >= 0 else v for ball, v in zip(own, visits, strict=True)]
                columns = {c: pd.Series(list(v), index=part.index) for c, v in lists.items()}
                yield part.assign(**columns)

    return given.mapInPandas(run, f"{types}, v array<double>, {made}")


def _verify(pairs: DataFrame, least: float, width: int) -> DataFrame:
    """``(graph, root, node, links)`` from ``(label, at, block, turn, visitor, own, graph, node, weight, v)``."""

    def run(group: pd.DataFrame) -> pd.DataFrame:
        visits = group["visitor"].to_numpy()
        q, y = group[visits], group[~visits]
        links = _cosines(q["v"], y["v"], width) >= least
        ids, others = q["node"].to_numpy(), y["node"].to_numpy()
        links &= ~(q["own"].to_numpy()[:, None] & (ids[:, None] >= others[None, :]))
        nodes = np.concatenate([ids, others])
        graph = np.concatenate([q["graph"].to_numpy(), y["graph"].to_numpy()])
        count = np.concatenate([links @ y["weight"].to_numpy(), links.T @ q["weight"].to_numpy()])
        roots = _roots(links, graph)
        some = count > 0
        return pd.DataFrame({"graph": graph[some], "root": roots[some], "node": nodes[some], "links": count[some]})

    keys = ["label", "at", "block", "turn"]
    return pairs.groupBy(*keys).applyInPandas(run, "graph long, root long, node long, links long")


def _cosines(a, b, width: int) -> np.ndarray:
    def matrix(vectors):
        out = np.zeros((len(vectors), width))
        for i, v in enumerate(vectors):
            out[i, : len(v)] = v
        largest = np.abs(out).max(axis=1, keepdims=True, initial=0.0)
        # Squares of such components would not be doubles any more.
        return np.where((largest > 1e140) | (largest < 1e-140), out / largest, out)

    x, y = matrix(a), matrix(b)
    lengths = np.sqrt((x * x).sum(axis=1))[:, None] * np.sqrt((y * y).sum(axis=1))[None, :]
    return (x @ y.T) / lengths


def _roots(links: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """For every visitor and member the least graph node it is connected with in this block."""
    rows, columns = links.shape
    root = graph.copy()
    free_rows, free_columns = links.any(axis=1), links.any(axis=0)
    while free_rows.any():
        found_rows, found_columns = np.zeros(rows, dtype=bool), np.zeros(columns, dtype=bool)
        new = np.zeros(rows, dtype=bool)
        new[free_rows.argmax()] = True
        while new.any():
            found_rows |= new
            met = links[new].any(axis=0) & ~found_columns
            found_columns |= met
            new = links[:, met].any(axis=1) & ~found_rows
        members = np.concatenate([found_rows, found_columns])
        root[members] = graph[members].min()
        free_rows &= ~found_rows
        free_columns &= ~found_columns
    return root


def _meetings(placed: DataFrame) -> DataFrame:
    """Visitors and members of every cell, and of every ball, dealt to blocks.

    A place with m members has m / BLOCK_ROWS blocks of them; its visitors come to each block in turns
    of as many.  Places of balls have the numbers below 0.
    """
    of_ball = -1 - F.col("ball")
    graph = F.when(F.col("ball") >= 0, of_ball.cast("bigint")).otherwise(F.col("node")).alias("graph")
    rows = placed.select(
        "label", "node", "weight", "v", graph,
        F.when(F.col("ball") >= 0, of_ball).otherwise(F.col("home")).alias("at"),
        F.concat("visits", F.transform("some", lambda b: -1 - b)).alias("to"),
    )
    deal = F.xxhash64("node", F.lit(11))
    visits = rows.select("label", "node", F.explode("to").alias("to"), "at")
    # Sizes first: blocks of a place follow from the numbers of its members and visitors.
    members = rows.groupBy("label", "at").agg(F.count("*").alias("members"))
    visitors = visits.groupBy("label", F.col("to").alias("at")).agg(F.count("*").alias("visitors"))
    sizes = members.join(visitors, ["label", "at"])
    of = {c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int").alias(f"n_{c}") for c in ("members", "visitors")}
    sizes = materialize(sizes.filter(F.col("members") * F.col("visitors") > 1).select("label", "at", *of.values()), "multi-sizes")
    member = rows.join(sizes, ["label", "at"]).select(
        "label", "at", F.pmod(deal, "n_members").cast("int").alias("block"),
        F.explode(F.sequence(F.lit(0), F.col("n_visitors") - 1)).alias("turn"),
        F.lit(False).alias("visitor"), F.lit(False).alias("own"), "graph", "node", "weight", "v",
    )
    coming = rows.select("label", F.col("at").alias("home"), "graph", "node", "weight", "v", F.explode("to").alias("at"))
    visitor = coming.join(sizes, ["label", "at"]).select(
        "label", "at", F.explode(F.sequence(F.lit(0), F.col("n_members") - 1)).alias("block"),
        F.pmod(deal, "n_visitors").cast("int").alias("turn"),
        F.lit(True).alias("visitor"), (F.col("home") == F.col("at")).alias("own"), "graph", "node", "weight", "v",
    )
    return member.unionByName(visitor)


def _usable(vector: str):
    def fine(c):
        c = c.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    return F.col(vector).isNotNull() & F.forall(vector, fine) & F.exists(vector, lambda c: c != 0)


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = LEAST_COSINE,
    target_recall: float = TARGET_RECALL,
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` of every row."""
    good = F.coalesce(_usable(vector) & F.col(label).isNotNull() & F.col(id_column).isNotNull(), F.lit(False))
    v = F.when(good, F.transform(vector, lambda c: c.cast("double") + F.lit(0.0)))
    rows = df.select(F.col(id_column).alias("id"), F.when(good, F.col(label)).alias("label"), v.alias("v"))
    k1, k2 = text_keys(F.col("v"))
    rows = materialize(rows.withColumns({"k1": k1, "k2": k2}), "multi-rows")
    copies = rows.filter(F.col("v").isNotNull()).groupBy("label", "k1", "k2")
    nodes = copies.agg(F.count("*").alias("weight"), F.min("id").alias("least_id"), F.first("v").alias("v"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "multi-nodes")

    n = nodes.count()
    grid = fit(nodes, n, least, target_recall)
    placed = materialize(place(nodes, grid), "multi-placed")
    found = materialize(_verify(_meetings(placed), least, grid.width), "multi-found")

    # Links with whole balls, counted on both sides; at most MOST_BALLS rows in each table here.
    member = placed.filter(F.col("ball") >= 0).groupBy("ball").agg(F.sum("weight").alias("size"))
    met = placed.select("node", "ball", "weight", F.explode("whole").alias("other"))
    come = met.groupBy(F.col("other").alias("ball")).agg(F.sum("weight").alias("come"))
    balls = F.broadcast(materialize(member.join(come, "ball", "left"), "multi-balls"))
    whole = met.join(balls.select(F.col("ball").alias("other"), "size"), "other")
    whole_links = whole.groupBy("node").agg(F.sum("size").alias("links"))
    per_node = found.select("node", "links").unionByName(whole_links).groupBy("node").agg(F.sum("links").alias("links"))

    graph = F.when(F.col("ball") >= 0, (-1 - F.col("ball")).cast("bigint")).otherwise(F.col("node"))
    links = found.select(F.col("graph").alias("a"), F.col("root").alias("b")).unionByName(
        whole.select(graph.alias("a"), (-1 - F.col("other")).cast("bigint").alias("b"))
    )
    roots = materialize(connected(links), "multi-roots")

    counted = placed.select("node", "least_id", "weight", "ball", graph.alias("graph"))
    counted = counted.join(per_node, "node", "left").join(balls, "ball", "left")
    counted = counted.join(roots.withColumnRenamed("node", "graph"), "graph", "left")
    in_ball = F.when(F.col("ball") >= 0, F.col("size") + F.coalesce("come", F.lit(0))).otherwise(F.col("weight"))
    counted = materialize(
        counted.select(
            "node", "least_id", F.coalesce("root", "graph").alias("root"),
            (F.coalesce("links", F.lit(0)) + in_ball - 1).alias("n_links"),
        ),
        "multi-counted",
    )
    least_ids = counted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    least_ids = materialize(least_ids, "multi-least")
    known = counted.join(least_ids, "root").select("node", "n_links", "component_id")
    keyed = nodes.select("node", "label", "k1", "k2")
    known = materialize(keyed.join(known, "node").drop("node"), "multi-known")
    component = F.coalesce("component_id", "id")
    return rows.drop("v").join(known, ["label", "k1", "k2"], "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )

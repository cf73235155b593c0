"""Near-duplicate vectors, whitening and token alignment against brute force, and on odd rows."""

from collections import Counter
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from termloom.llm import alignment, neighbours, whitening
from termloom.llm.queries import op11_multi_index, op12_whitening, op13_alignment

EMBEDDINGS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
    ]
)
A_PATH = public_tokenizers.path("byte_bpe_50k.json")
B_PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def folder_of(spark, tmp_path_factory):
    def make(name, rows, schema):
        folder = str(tmp_path_factory.mktemp("sf"))
        spark.createDataFrame(rows, schema).repartition(3).write.parquet(f"{folder}/{name}.parquet")
        return folder

    return make


# --- near-duplicate vectors


def planted(rng, label, centers=6, width=16):
    """Noise, groups of near copies of several widths, exact copies."""
    rows = [rng.standard_normal(width) for _ in range(120)]
    for spread in (0.01, 0.03, 0.04, 0.06, 0.09):
        for _ in range(centers):
            base = rng.standard_normal(width)
            rows += [base + spread * rng.standard_normal(width) for _ in range(6)]
    base = rng.standard_normal(width)
    rows += [base + 0.02 * rng.standard_normal(width) for _ in range(150)] + [base] * 20
    return [(v.tolist(), label) for v in rows]


def linked(rows):
    """(links, component) of each row by comparing all pairs."""
    n = len(rows)
    near = np.zeros((n, n), dtype=bool)
    for i in range(n):
        for j in range(i):
            if rows[i][2] == rows[j][2]:
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                near[i, j] = near[j, i] = a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= 0.98
    component = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for i in range(n):
            least = min([component[i], *(component[j] for j in np.flatnonzero(near[i]))])
            changed |= least < component[i]
            component[i] = least
    return near.sum(axis=1), component


def test_multi_index_equals_all_pairs_where_neighbours_are_random(spark, folder_of):
    rng = np.random.default_rng(3)
    made = planted(rng, 0) + planted(rng, 1)
    order = rng.permutation(len(made))
    rows = [(int(i), np.float32(v).tolist(), label) for i, (v, label) in zip(order, made, strict=True)]
    folder = folder_of("embeddings", rows, EMBEDDINGS)
    got = {r["vec_id"]: r for r in op11_multi_index(spark, folder).collect()}
    links, component = linked(rows)
    assert len(got) == len(rows)
    found = sum(got[r[0]]["n_links"] for r in rows)
    assert all(got[r[0]]["n_links"] <= n for r, n in zip(rows, links, strict=True))  # none below the limit
    assert found >= 0.98 * links.sum()
    same = sum(got[r[0]]["component_id"] == c for r, c in zip(rows, component, strict=True))
    assert same >= 0.98 * len(rows)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got.values())


def test_multi_index_with_many_cells(spark):
    """With many codewords the traversal is what finds the links: recall against all pairs."""
    rng = np.random.default_rng(5)
    base = neighbours.unit_rows(rng.standard_normal((1500, 32)))
    side = rng.standard_normal(base.shape)
    side = neighbours.unit_rows(side - (side * base).sum(axis=1, keepdims=True) * base)
    moved = 0.9801 * base + np.sqrt(1 - 0.9801**2) * side  # hardly above the limit
    words = tuple(neighbours._codewords(x, 24, rng) for x in (base[:, :16], base[:, 16:]))
    grid = neighbours.Grid(32, words, 0.0, {}, {}, 0.98)
    grid = neighbours.Grid(32, words, neighbours._reach(grid, base[:750], 0.99, rng), {}, {}, 0.98)
    home, visits = grid.cells(base)
    there, back = grid.cells(moved)
    met = [t in v if t >= h else h in w for h, v, t, w in zip(home, visits, there, back, strict=True)]
    assert np.mean(met) >= 0.95
    assert np.mean([len(v) for v in visits]) < 24 * 24 / 4


def test_multi_sequence_visits_by_distance():
    rng = np.random.default_rng(1)
    a, b = rng.random(9), rng.random(7)
    order = list(neighbours._within(a, b, 1.2))
    sums = [a[i] + b[j] for i, j in order]
    assert sums == sorted(sums)
    assert set(order) == {(i, j) for i in range(9) for j in range(7) if a[i] + b[j] <= 1.2}


def test_multi_index_blocks_and_balls_do_not_change_results(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, np.float32(v).tolist(), label) for i, (v, label) in enumerate(planted(rng, 4))]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    usual = sorted(map(tuple, neighbours.near_duplicates(df).collect()))
    monkeypatch.setattr(neighbours, "BLOCK_ROWS", 16)
    assert sorted(map(tuple, neighbours.near_duplicates(df).collect())) == usual
    monkeypatch.setattr(neighbours, "BALL_SHARE", 2.0)  # no balls
    assert sorted(map(tuple, neighbours.near_duplicates(df).collect())) == usual


def test_multi_index_on_odd_rows(spark):
    one = [1.0, 0.0, 0.0]
    rows = [
        (1, one, 0), (2, [2.0, 0.0, 0.0], 0), (3, one, 1), (4, one, None), (5, None, 0), (6, [0.0, 0.0, 0.0], 0),
        (7, [1.0, None, 0.0], 0), (8, [float("nan"), 0.0, 0.0], 0), (9, [float("inf"), 0.0, 0.0], 0), (10, [], 0),
        (11, one, 0), (11, one, 0), (None, one, 0), (12, [1.0], 0), (13, [1e38, 0.0, 0.0], 0), (14, [-1.0, 0.0, 0.0], 0),
    ]
    df = spark.createDataFrame(rows, EMBEDDINGS)
    clashing = df.withColumns({c: F.lit("mine") for c in ("node", "k1", "v", "weight", "n_links", "ball", "root")})
    got = sorted((r["id"] or 0, r["n_links"], r["component_id"], r["kept"]) for r in neighbours.near_duplicates(clashing).collect())
    group = {i: (i, 5, 1, i == 1) for i in (1, 2, 11, 12, 13)}
    alone = {i: (i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 14)}
    expected = [*group.values(), group[11], *alone.values(), (0, 0, None, False)]
    assert got == sorted(expected, key=lambda r: r[0])
    assert neighbours.near_duplicates(df.limit(0)).collect() == []


# --- whitening


def whitened_by_numpy(vectors):
    x = np.floor(256 * np.array(vectors, dtype=float)).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = fit - s / n
    values, parts = np.linalg.eigh(centred.T @ centred / n)
    values, parts = values[::-1], parts[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (x - s / n) @ parts / np.sqrt(values), values / values.sum()


@pytest.mark.parametrize("block_values", [16, 65_536])
def test_whitening_equals_numpy(spark, folder_of, monkeypatch, block_values):
    monkeypatch.setattr(whitening, "BLOCK_VALUES", block_values)
    monkeypatch.setattr(whitening, "SPLIT_BLOCKS", 3)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((70, 8)) * np.arange(1, 9)
    vectors = np.float32(np.concatenate([base, base[:20], base[:1].repeat(30, axis=0)])).tolist()
    rows = [(i, v, i % 3) for i, v in enumerate(vectors)]
    got = op12_whitening(spark, folder_of("embeddings", rows, EMBEDDINGS)).toPandas()
    n, deviation, white, explained = whitened_by_numpy(vectors)
    assert len(got) == 4 * len(rows) and set(got["n"]) == {n}
    table = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((table * white[:, :4]).sum(axis=0))
    assert np.abs(table - signs * white[:, :4]).max() < 1e-9
    first = got[got["component"] == 1].set_index("vec_id").sort_index()
    assert first["deviation"].tolist() == deviation.tolist()
    share = got.groupby("component")["explained"].first().to_numpy()
    assert np.allclose(share, explained[:4], rtol=1e-9)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-9


def test_whitening_on_odd_rows(spark):
    rows = [
        (1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0), (3, [-0.0, 5.0], 0), (4, [3.5], 0), (None, [2.0, 1.0], 0),
        (5, None, 0), (6, [1.0, None], 0), (7, [float("nan"), 1.0], 0), (8, [float("-inf"), 1.0], 0), (1, [7.0, -2.0], 0),
    ]
    df = spark.createDataFrame(rows, EMBEDDINGS).withColumns({c: F.lit("mine") for c in ("x", "i", "id", "k1", "n", "block")})
    found, model = whitening.whiten(df)
    got = found.toPandas()
    assert len(got) == 6 and model.n == 5 and sorted(got["id"].fillna(0)) == [0, 1, 1, 2, 3, 4]
    x = {(256, 512), (0, 1280), (896, 0), (512, 256), (1792, -512)}
    assert model.sums == tuple(np.array(sorted(x)).sum(axis=0))
    # One direction only, none at all, and nothing.
    line = spark.createDataFrame([(i, [float(i), 2.0 * i], 0) for i in range(5)], EMBEDDINGS)
    found, model = whitening.whiten(line)
    assert model.matrix.shape[1] == 1 and all(len(r["whitened"]) == 1 for r in found.collect())
    for few in (line.filter("vec_id = 1"), line.limit(0)):
        found, model = whitening.whiten(few)
        assert model is None and found.collect() == []
    large = spark.createDataFrame([(1, [3e14, 0.0], 0), (2, [-3e14, 1.0], 0)], "vec_id long, embedding array<double>, label int")
    exact = {r["id"]: int(r["deviation"]) for r in whitening.whiten(large)[0].collect()}
    xs = [[int(Fraction(c) * 256 // 1) for c in v] for v in ([3e14, 0.0], [-3e14, 1.0])]
    sums = [sum(c) for c in zip(*xs, strict=True)]
    assert exact == {i + 1: sum((2 * c - s) ** 2 for c, s in zip(x, sums, strict=True)) for i, x in enumerate(xs)}


# --- alignment

TEXTS = [
    "The quick brown fox, and the quick dog.", "the the the", "", None, " ", "  leading", "trailing  ", "a  b ", "\n\nx \t y\r\n",
    "<|endoftext|> is text, so is <s> and <0x41>", "don't we'll I'M it's", "naïve café über", "あい\U0001f600 été 中文 字",
    "½ ② x", "é a ́b", "ﬁ ﬂ", "　x  y", "▁x ▁ y", "\x00 nul", "한국 말", "x" + " " * 40 + "y",
    "1234567 89.5%", "word " * 400, "a" * 3000, "𐀀 z", "The quick brown fox, and the quick dog.",
]


def tokens_by_libraries(texts):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
    a.encode_special_tokens = True
    bytes_a = {i: bytes(alignment.byte_alphabet()[c] for c in t) for t, i in a.get_vocab().items() if i < 50_256}
    for text in texts:
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        pieces = [b.id_to_piece(i) for i in ids_b]
        in_a = [bytes_a[i] for i in ids_a]
        in_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(ids_b, pieces, strict=True)]
        same = text and b"".join(in_a) == b"".join(in_b) == f" {text}".encode()
        yield (list(zip(ids_a, in_a, strict=True)), list(zip(ids_b, in_b, strict=True))) if same else ([], [])


def aligned_by_hand(texts):
    rows = []
    for sides in tokens_by_libraries(texts):
        ends = []
        for side in sides:
            at, made = 0, []
            for i, token in side:
                at += len(token)
                made.append((at, i))
            ends.append(made)
        common = sorted({e for e, _ in ends[0]} & {e for e, _ in ends[1]})
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(i) for e, i in side if low < e <= high) for side in ends))
            low = high
        links = [(i, j) for e, i in ends[0] for f, j in ends[1] if e == f]
        rows.append((len(ends[0]), len(ends[1]), len(common), links, ";".join(groups)))
    counts = Counter(pair for row in rows for pair in row[3])
    best = {}
    for (_, j), n in counts.items():
        best[j] = max(best.get(j, 0), n)
    for n_a, n_b, n_groups, links, groups in rows:
        n_best = sum(counts[p] == best[p[1]] for p in links)
        yield n_a, n_b, n_groups, len(links), n_best, sum(counts[p] for p in links), groups


@pytest.mark.parametrize("shared_pairs", [0, 30, 200_000])
def test_alignment_equals_the_libraries_and_a_count_by_hand(spark, monkeypatch, shared_pairs):
    monkeypatch.setattr(alignment, "SHARED_PAIRS", shared_pairs)
    df = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").repartition(4)
    df = df.withColumns({c: F.lit("mine") for c in ("row", "rest", "a", "b", "count", "key")})
    columns = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    got = {r["doc_id"]: tuple(r[c] for c in columns) for r in alignment.with_counts(alignment.align(df, A_PATH, B_PATH)).collect()}
    for i, expected in enumerate(aligned_by_hand(TEXTS)):
        assert got[i] == expected, TEXTS[i]


def test_alignment_in_small_slices_and_without_memory(monkeypatch):
    import pyarrow as pa

    a, b = (f(open(p, "rb").read()) for f, p in ((alignment.byte_bpe, A_PATH), (alignment.sentence_piece, B_PATH)))
    texts = pa.array([t or "" for t in TEXTS])
    usual = alignment.align_texts(texts, alignment.Coder(a, b))
    monkeypatch.setattr(alignment, "CACHE_UNITS", 1)
    coder = alignment.Coder(a, b)
    for i in range(len(texts)):
        part = alignment.align_texts(texts[i : i + 1], coder)
        assert all(part[c][0] == usual[c][i] for c in usual)
    monkeypatch.setattr(alignment, "SLICE_BYTES", 50)
    bounds = list(alignment._slices(texts))
    assert bounds[0][0] == 0 and bounds[-1][1] == len(texts)
    assert all(x[1] == y[0] for x, y in zip(bounds, bounds[1:], strict=False))


def test_ranks_of_the_file_give_the_ids_of_its_merges():
    """Every token that is one piece of the pattern is met by merging, as the quick way takes for granted."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(A_PATH)
    vocabulary = alignment.byte_bpe(open(A_PATH, "rb").read())
    texts = [t.decode(errors="replace") for t in vocabulary.bytes.to_pylist()[:50_256]]
    plain = [(i, t) for i, t in enumerate(texts) if "�" not in t and len(t.strip()) > 0 and "'" not in t]
    got = tokenizer.encode_batch([t for _, t in plain])
    assert all(e.ids == [i] for (i, _), e in zip(plain, got, strict=True) if len(e.ids) == 1)
    assert sum(len(e.ids) == 1 for e in got) > 0.99 * len(plain)


def test_alignment_query_on_odd_rows(spark, folder_of, odd):
    folder = folder_of("documents", [tuple(r) for r in odd.collect()], odd.schema)
    rows = op13_alignment(spark, folder).collect()
    assert len(rows) == odd.count()
    for r in rows:
        assert (r["groups_sha256"] == "") == (r["n_a"] == 0) == (r["n_groups"] == 0)
    none = alignment.with_counts(alignment.align(odd.limit(0), A_PATH, B_PATH))
    assert none.collect() == []

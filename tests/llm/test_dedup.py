"""Near-duplicates and repeated passages, against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from termloom.llm import dedup, queries, repeats
from termloom.llm.components import connected

DATA = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def prose(pick, n):
    return [f"w{pick.randrange(5000)}" for _ in range(n)]


def brute_classes(texts):
    sets = {}
    for i, t in texts.items():
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in texts:
        for j in texts:
            if i < j and sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in texts}


def test_signature_agreement_is_weighted_similarity():
    pick = np.random.default_rng(3)
    names = pick.integers(0, 2**63, 200).astype(np.uint64)
    a = pick.random(200) * 4
    b = np.where(pick.random(200) < 0.4, a * 0.3, a)
    made = dedup.signatures([names, names, names], [a, b, a.copy()], k=2048)
    assert (made[0] == made[2]).all()
    wanted = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((made[0] == made[1]).mean() - wanted) < 0.05


def test_signatures_of_any_size():
    pick = np.random.default_rng(4)
    sets = [pick.integers(0, 2**63, n).astype(np.uint64) for n in (1, 2, 7, 400, 60_000)]
    made = dedup.signatures([*sets, sets[0][:0]])
    assert (made[:-1] != 0).all() and (made[-1] == 0).all()
    alone = dedup.signatures([sets[3]])
    assert (alone[0] == made[3]).all()


def test_components(spark):
    pick = random.Random(2)
    edges = [(pick.randrange(60), pick.randrange(60)) for _ in range(35)]
    edges += [(100, i) for i in range(101, 160)] + [(i, i + 1) for i in range(200, 230)]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    got = {r.node: r.root for r in found}
    wanted = {n: find(n) for e in edges if e[0] != e[1] for n in e}
    assert got == wanted


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_classes_equal_brute_force(docs_of):
    pick = random.Random(5)
    texts, n = {}, 0
    for _ in range(25):
        base = prose(pick, pick.choice([6, 40, 150, 400]))
        for _ in range(pick.choice([1, 2, 6])):
            copy = list(base)
            for _ in range(pick.choice([0, 0, 1, 2, 6])):
                copy[pick.randrange(len(copy))] = f"x{pick.randrange(10**6)}"
            texts[n] = " ".join(copy)
            n += 1
    rows = dedup.classes(docs_of(list(texts.items()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)
    sizes = Counter(r.class_id for r in rows)
    assert all(r.class_size == sizes[r.class_id] for r in rows)


def test_pairs_on_one_template(docs_of):
    """Many near-duplicate pairs in the same buckets, all on one passage; of different lengths too."""
    pick = random.Random(6)
    passage = prose(pick, 300)
    texts = {}
    for i in range(300):
        own = [f"o{pick.randrange(10**7)}" for _ in range(pick.choice([50, 51, 52]))]
        copy = list(own)
        for k in range(7):
            copy[4 + 6 * k] = f"x{pick.randrange(10**7)}"
        texts[2 * i], texts[2 * i + 1] = " ".join(passage + own), " ".join(passage + copy)
    rows = dedup.classes(docs_of(list(texts.items()))).collect()
    wanted = brute_classes(texts)
    assert len(set(wanted.values())) == 300
    assert {r.doc_id: r.class_id for r in rows} == wanted


def test_near_copies_are_linked_by_few_comparisons(docs_of, monkeypatch):
    """Copies of one text with changes of their own: most pairs are below the limit, all are of one class."""
    pick = random.Random(8)
    base, texts = prose(pick, 146), {}
    for i in range(600):
        copy = list(base)
        for k in pick.sample(range(146), pick.choice([1, 2, 2, 3])):
            copy[k] = f"x{pick.randrange(10**7)}"
        texts[i] = " ".join(copy)
    compared, check = [], dedup._checked

    def counted(pairs, sets):
        compared.append(pairs.count())
        return check(pairs, sets)

    monkeypatch.setattr(dedup, "_checked", counted)
    rows = dedup.classes(docs_of(list(texts.items()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)
    assert sum(compared) < 60 * len(texts)


def test_classes_are_merged_by_new_links_only(docs_of, monkeypatch):
    """All links are looked at once; after further ones, only what these link."""
    pick = random.Random(8)
    base, texts = prose(pick, 146), {}
    for i in range(300):
        copy = list(base)
        for k in pick.sample(range(146), pick.choice([1, 2, 2, 3])):
            copy[k] = f"x{pick.randrange(10**7)}"
        texts[i] = " ".join(copy)
    monkeypatch.setattr(dedup, "WAVE_PAIRS", 20)
    given, found, near, check = [], [], dedup._provisional, dedup._checked

    def counted(links):
        given.append(links.count())
        return near(links)

    def counted_links(pairs, sets):
        links = check(pairs, sets)
        found.append(links.count())
        return links

    monkeypatch.setattr(dedup, "_provisional", counted)
    monkeypatch.setattr(dedup, "_checked", counted_links)
    rows = dedup.classes(docs_of(list(texts.items()))).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)
    assert len(given) > 2
    assert all(n <= links for n, links in zip(given, found, strict=True))


def test_merged_classes(spark):
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5)], "node long, root long")
    links = spark.createDataFrame([(6, 2), (8, 7), (2, 1)], "a long, b long")
    merged = {r.node: r.root for r in dedup._merged(roots, links).collect()}
    assert merged == {1: 1, 2: 1, 5: 1, 6: 1, 7: 7, 8: 7}


def test_dedup_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = queries.op3_minhash_dedup(spark, DATA).collect()
    assert {r.doc_id: r.class_id for r in rows} == brute_classes(texts)


def test_odd_documents(odd):
    rows = dedup.classes(odd).collect()
    assert len(rows) == odd.count()
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[i].class_id == i and by_id[i].kept for i in (1, 2, 3, 5, 6, 7))
    assert by_id[4].class_size == 2 and by_id[None].class_size == 2 and by_id[None].class_id is None
    kept = dedup.keep_one(odd)
    assert kept.columns == odd.columns and kept.first().node == "mine"
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7]
    assert dedup.classes(odd.limit(0)).count() == 0 == dedup.keep_one(odd.limit(0)).count()


def brute_repeats(texts):
    lists = [words(t) for t in texts]
    starts = Counter(tuple(w[i : i + 35]) for w in lists for i in range(len(w) - 34))
    out = []
    for w in lists:
        gone = [False] * len(w)
        for i in range(len(w) - 34):
            if starts[tuple(w[i : i + 35])] > 1:
                gone[i : i + 35] = [True] * 35
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((len(w), sum(gone), kept))
    return out


def spiked(pick):
    passages = [prose(pick, n) for n in (34, 35, 36, 60, 120)]
    for _ in range(60):
        parts = prose(pick, pick.choice([0, 3, 30, 90]))
        for _ in range(pick.choice([0, 1, 2, 3])):
            p = pick.choice(passages)
            a = pick.randrange(0, max(1, len(p) - 36))
            parts += p[a : a + pick.choice([20, 34, 35, 40, 200])] + prose(pick, pick.choice([0, 1, 25]))
        yield pick.choice([" ", "\n", " \t "]).join(parts)
    line = prose(pick, 9)
    yield " ".join(line * 12)
    yield " ".join(line * 12 + prose(pick, 40) + line * 5)
    yield " ".join(["a"] * 34)
    yield " ".join(["a"] * 80)
    yield " ".join(["b", *["a"] * 40, "c"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repeats_equal_brute_force(docs_of, seed):
    texts = list(spiked(random.Random(seed)))
    rows = repeats.without_repeats(docs_of(list(enumerate(texts)))).collect()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in rows}
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)
    for r in rows:
        assert sum(s.end - s.start for s in r.spans) == r.n_removed
        assert all(s.end - s.start >= 35 for s in r.spans)


def test_repeats_over_partitions_and_without_broadcast(spark, docs_of):
    texts = list(spiked(random.Random(9))) * 2
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = docs_of(list(enumerate(texts))).repartition(7)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.without_repeats(df).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert [got[i] for i in range(len(texts))] == brute_repeats(texts)


def test_repeats_of_odd_documents(odd):
    found = repeats.without_repeats(odd)
    rows = found.collect()
    texts = [r.text for r in odd.collect()]
    wanted = Counter(brute_repeats(texts))
    assert Counter((r.n_words, r.n_removed, r.kept) for r in rows) == wanted
    assert rows[0].node == "mine"
    assert repeats.without_repeats(odd.limit(0)).count() == 0


def test_repeats_query(spark):
    rows = spark.read.parquet(f"{DATA}/documents.parquet").collect()
    wanted = brute_repeats([r.text for r in rows])
    got = {r.doc_id: r for r in queries.op4_substring_dedup(spark, DATA).collect()}
    for row, (n, gone, kept) in zip(rows, wanted):
        found = got[row.doc_id]
        assert (found.n_words, found.n_removed) == (n, gone)
        assert found.kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()

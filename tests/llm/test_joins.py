import random
import string

import pytest
from pyspark.sql import functions as F

from mosaiq.llm import jaccard_join as J
from mosaiq.llm.components import components

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def shingles(text):
    words = (text or "").translate(LOWER).encode().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()


def plain(rows):
    """n_shingles and component of each row, by all pairs."""
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (d, _), x in zip(rows, label, strict=True):
        if d is not None:
            least[x] = min(d, least.get(x, d))
    return [(len(s), least.get(x)) for s, x in zip(sets, label, strict=True)]


def corpus(seed, n=25):
    rng = random.Random(seed)
    words = [f"W{i}É" for i in range(200)]
    base = [[rng.choice(words) for _ in range(rng.choice([3, 6, 9, 30, 80, 300]))] for _ in range(n)]
    common = [rng.choice(words) for _ in range(25)]
    texts = []
    for b in base:
        b = b + common if rng.random() < 0.5 else b
        texts.append(b)
        for _ in range(rng.randrange(5)):
            c = list(b)
            for _ in range(rng.randrange(1, max(2, len(c) // 25))):
                c[rng.randrange(len(c))] = rng.choice(words)
            texts.append(c)
    out = [rng.choice([" ", "\n"]).join(t) if rng.random() < 0.8 else " ".join(t).lower().upper() for t in texts]
    return [None, "", " ", "one", "ONE", *out]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_are_those_of_all_pairs(spark, seed):
    rows = [(i * 2, t) for i, t in enumerate(corpus(seed))]
    docs = spark.createDataFrame([(d, t, 0) for d, t in rows], "doc_id long, text string, n int").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.join_documents(docs).collect()}
    assert [got[d] for d, _ in rows] == plain(rows)


def test_chains_beyond_the_leader_are_found(spark, monkeypatch):
    """Neighbours in a chain are linked, the ends are not; a round compares one member only."""
    monkeypatch.setattr(J, "GROUP", 1)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(words[i * 3 : i * 3 + 40])) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in J.join_documents(docs).collect()} == {d: c for (d, _), (_, c) in zip(rows, plain(rows), strict=True)}


def test_hot_slots_are_dealt_to_tasks(spark, monkeypatch):
    """Documents that share a passage, most of them unlinked: the keys of its slots are split, their members compared in parts."""
    for name, value in (("GROUP", 16), ("HOT_LEAST", 2), ("COMMON", 10**9)):
        monkeypatch.setattr(J, name, value)
    rng = random.Random(8)
    shared, texts = [f"s{i}" for i in range(7)], []
    for i in range(40):
        own = [f"d{i}x{j}" for j in range(rng.choice([6, 7, 20]))]
        texts.append(shared + own)
        if i % 4 == 0:
            texts.append(shared + own + ["more"])
    chain = [f"w{i}" for i in range(100)]
    texts += [shared + chain[i * 2 : i * 2 + 40] for i in range(12)]
    rng.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    share = spark.sparkContext.broadcast
    node_texts, none = docs.withColumnRenamed("doc_id", "node"), share(J.shingle_sets(J.W.bytes_of(J.pa.array([""])))[0])
    keys, parts = J._hot_keys(J._sample(node_texts, len(rows)), none)
    assert len(keys) and parts.max() > 10
    found = {}
    for r in J._groups(node_texts, none, share((keys, parts))).collect():
        found.setdefault(r.key, set()).add((r.leader, r.node))
    alone = {}
    for r in J._groups(node_texts, none, share((keys[:0], parts[:0]))).collect():
        alone.setdefault(r.key, set()).add((r.leader, r.node))
    wrong = {k: (found.get(k), alone.get(k)) for k in found.keys() | alone.keys() if found.get(k) != alone.get(k)}
    assert not wrong and max(map(len, found.values())) > 30
    got = {r.doc_id: r.component_id for r in J.join_documents(docs).collect()}
    assert got == {d: c for (d, _), (_, c) in zip(rows, plain(rows), strict=True)}


def test_settled_leaves_one_table(spark):
    import os

    from mosaiq.llm.common import cut, settled, shared_dir

    place = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(place))
    inner = lambda: settled(lambda: cut(spark.range(5)).where("id > 1"))
    table = settled(lambda: cut(inner()).unionByName(inner()))
    assert table.count() == 6 and len(set(os.listdir(place)) - before) == 1


def test_rows_without_own_ids(spark):
    t = " ".join(f"w{i}" for i in range(40))
    rows = [(5, t), (5, t), (None, t + " x"), (7, t + " y"), (None, None), (9, ""), (5, "other words than these")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.n_shingles, r.component_id if r.component_id is not None else -1) for r in J.join_documents(docs).collect()))
    assert got == [(0, -1), (0, 9), (1, 5), (36, 5), (36, 5), (37, 5), (37, 5)]
    kept = J.keep_one(docs.withColumn("key", F.lit(1)))
    assert kept.columns == ["doc_id", "text", "key"]
    assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == [(0, ""), (5, "other words than these"), (5, t), (9, "")]
    nulls = spark.createDataFrame([(5, t), (5, t), (7, t), (None, t), (None, t), (None, ""), (None, "z " * 40), (None, "z " * 40)], "doc_id long, text string")
    assert sorted((r.doc_id or 0, r.text) for r in J.keep_one(nulls).collect()) == [(0, ""), (0, "z " * 40), (5, t)]
    assert J.join_documents(docs.limit(0)).count() == 0 and J.keep_one(docs.limit(0)).count() == 0


def test_long_texts_are_linked(spark):
    long = [f"w{i * 7919 % 100_003}" for i in range(60_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:58_000])), (3, " ".join(long[::-1]))]
    got = {r.doc_id: r.component_id for r in J.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_slots_of_linked_sets_meet():
    import numpy as np

    rng = np.random.default_rng(3)
    none = np.zeros(0, np.uint64)
    for size in (1, 2, 3, 5, 12, 15, 16, 30, 63, 64, 100, 255, 256, 700):
        for _ in range(30):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            low = -(-3 * len(a) // 4)
            keep = rng.choice(a, rng.integers(low, len(a) + 1), replace=False)
            more = rng.integers(0, max(1, 4 * len(keep) // 3 - len(a) + 1))
            b = np.unique(np.append(keep, rng.integers(0, 2**63, more).astype(np.uint64)))
            common = np.sort(rng.choice(a, len(a) // 3, replace=False)) if rng.random() < 0.5 else none
            if J.linked(a, b):
                assert len(np.intersect1d(J.slot_keys(a, common), J.slot_keys(b, common)))


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 140)] + [(200, 200), (300, 301), (301, 300)]
    rng.shuffle(edges)
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 140)}, 300: 300, 301: 300}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0

import random
import re
from collections import Counter

import numpy as np
import pytest

from mosaiq.llm import quality_classifier as C
from mosaiq.llm import quality_rules as R
from mosaiq.llm.common import documents

WORD = r"[^\x20\x09-\x0D]+"


def counts(text):
    words = re.findall(WORD, text or "")
    n = len(words)
    grams = Counter(tuple(words[i : i + 5]) for i in range(n - 4))
    covered = {i + k for i in range(n - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in (text or "").split("\n") if re.search(WORD, x)]
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def texts():
    rng = random.Random(4)
    out = [None, "", " \n\t ", "a b c d e", "a b c d e a b c d e", "x " * 50, "a b c d", "l\nl\n l\nl\n\n", "é# $%\x1fq | <z>", "w" * 5000]
    for _ in range(60):
        out.append(" ".join(rng.choice(["a", "bé", "c#", "d\ne", "f\n", "g"]) for _ in range(rng.randrange(60))))
    return out


def test_counts_are_plain_counts(spark):
    rows = [(i, t, "en", "s", 0.5) for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, kept double")
    got = {r.doc_id: r for r in R.judge(docs).collect()}
    assert len(got) == len(rows)
    for i, t, *_ in rows:
        r, want = got[i], counts(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        failed = want[0] < 10 or 100 * want[4] > 20 * want[0]
        assert r.base_failed == failed and not (failed and r.kept)


def corpus(n=400):
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(300)]
    clean = [". ".join(" ".join(rng.choice(vocabulary) for _ in range(rng.randrange(5, 12))).capitalize() for _ in range(8)) for _ in range(n)]
    bad = ["### ".join(t.split(" ")) for t in clean[:5]] + [t.upper().replace(" ", "!! ") for t in clean[5:10]]
    return clean, bad


def test_outliers_go_and_others_stay(spark):
    clean, bad = corpus()
    rows = [(i, t, None if i % 4 == 0 else "en", f"s{i % 3}" if i % 5 else None) for i, t in enumerate(clean + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r.doc_id: r.kept for r in R.judge(docs).collect()}
    assert not any(got[i] for i in range(len(clean), len(rows))) and sum(got[i] for i in range(len(clean))) >= len(clean) - 2
    kept = R.keep_good(docs.withColumn("key", docs["source"]))
    assert kept.columns == [*docs.columns, "key"] and kept.count() == sum(got.values())
    assert R.judge(docs.limit(0)).count() == 0


def mcd(x):
    """Centre, scatter and squared distances of the rows of x, as the operator words it."""
    floor, p = np.array([R.FLOOR[a] for a in R.FEATURES]), x.shape[1]
    median = lambda v: np.sort(v, 0)[-(-len(v) // 2) - 1]
    centre = median(x)
    scale = np.sqrt((1.4826 * median(abs(x - centre))) ** 2 + floor**2)
    z = (x - centre) / scale
    shapes = {"scale": np.eye(p)}
    for k, u in (("sign", z / np.sqrt((z**2).sum(1, keepdims=True) + 1e-12)), ("tanh", np.tanh(z))):
        m = u.T @ u / len(u)
        size = np.sqrt(np.diag(m) + 1e-6)
        shapes[k] = np.where(np.eye(p) > 0, 1.0, 0.9 * m / np.outer(size, size))
    distance = lambda c, v: np.einsum("ij,jk,ik->i", x - c, np.linalg.inv(v), x - c)

    def step(c, v):
        d = distance(c, v)
        half = x[d <= median(d)]
        c = half.mean(0)
        return c, R.CONSISTENCY * (half - c).T @ (half - c) / len(half) + np.diag(floor**2)

    found = []
    for k in R.STARTS:
        c, v = centre, shapes[k] * np.outer(scale, scale)
        for _ in range(R.FIRST_STEPS):
            c, v = step(c, v)
        found.append((np.linalg.slogdet(v)[1], k, c, v))
    det, _, c, v = min(found, key=lambda f: f[:2])
    for _ in range(R.STEPS):
        c, v = step(c, v)
        det, before = np.linalg.slogdet(v)[1], det
        if abs(det - before) < R.STILL:
            break
    return distance(c, v)


def test_verdicts_are_those_of_a_plain_estimate(spark):
    clean, bad = corpus()
    rows = [(i, t, "en", f"s{i % 2}") for i, t in enumerate(clean + bad)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    stats = R.statistics(docs).withColumns({k: f() for k, f in R.FEATURES.items()}).collect()
    got = {r.doc_id: r for r in R.judge(docs).collect()}
    for source in ("s0", "s1"):
        own = [r for r in stats if r.source == source and not got[r.doc_id].base_failed]
        want = mcd(np.array([[r[a] for a in R.FEATURES] for r in own]))
        for r, d in zip(own, want, strict=True):
            assert got[r.doc_id].distance2 == pytest.approx(d, rel=0.02, abs=0.02) and (got[r.doc_id].kept == (d <= R.CUTOFF) or abs(d - R.CUTOFF) < 1)


def test_rows_that_share_an_id_are_judged_each(spark):
    clean, bad = corpus(60)
    docs = spark.createDataFrame([(7, t, "en", "s") for t in clean[:2]] * 2, "doc_id long, text string, lang string, source string")
    assert R.judge(docs).count() == 4
    rows = [(i, t, "en", "s") for i, t in enumerate(clean)] + [(None, clean[0], "en", "s"), (None, bad[0], "en", "s"), (None, None, None, None), (3, bad[1], "en", "s"), (3, clean[3], "en", "s")]
    kept = R.keep_good(spark.createDataFrame(rows, docs.schema)).collect()
    assert Counter((r.doc_id, r.text) for r in kept if r.doc_id in (None, 3)) == Counter({(None, clean[0]): 1, (3, clean[3]): 2})


def test_pairs_rank_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = documents(spark, sf), documents(spark, sf, "labels")
    model = C.learn(docs, labels)
    got = C.score_documents(docs, model).cache()
    held = got.where("held_out").join(labels, "doc_id").collect()
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    assert got.count() == docs.count() and min(len(good), len(bad)) >= 8
    assert np.mean([g > b for g in good for b in bad]) > 0.97 and np.mean([r.predicted == r.quality for r in held]) > 0.95
    assert all(r.predicted == (r.score >= C.THRESHOLD) and 0 <= r.score <= 1 for r in held)


def test_ties_and_long_texts_are_scored(spark):
    docs = spark.createDataFrame([(i, "the same words here") for i in range(3)] + [(9, "word " * 200_000)], "doc_id long, text string")
    model = C.fit(np.array([C.features("a b c")] * 2 + [C.features("# #")] * 2), np.array([1, 1, 0, 0]), pairs=50)
    got = {r.doc_id: r.score for r in C.score_documents(docs, model).collect()}
    assert got[0] == got[1] == got[2] and 0 <= got[9] <= 1


def test_held_out_rows_teach_nothing(spark):
    import zlib

    rows = [(i, "good words in a row " * 3 if i % 2 else "### $$$ ### " * 9) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    label = lambda flip: spark.createDataFrame([(i, i % 2 if zlib.crc32(str(i).encode()) % 5 or not flip else 1 - i % 2) for i, _ in rows], "doc_id long, quality int")
    a, b = C.learn(docs, label(False)), C.learn(docs, label(True))
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


@pytest.mark.parametrize("labels", [[], [1, 1], [0, 0]])
def test_missing_labels(labels):
    model = C.fit(np.array([C.features("a b")] * len(labels)).reshape(len(labels), len(C.FEATURES)), np.array(labels, dtype=int))
    assert 0 <= model.score(np.array([C.features("")]))[0] <= 1


def test_edge_rows(spark):
    docs = spark.createDataFrame([(None, None, 1.0), (1, "", 1.0), (1, "a", 1.0)], "doc_id long, text string, score double")
    model = C.fit(np.array([C.features("a b c")] * 2 + [C.features("# #")] * 2), np.array([1, 1, 0, 0]), pairs=50)
    got = C.score_documents(docs, model).collect()
    assert len(got) == 3 and got[0].held_out is False and got[0].score == got[1].score
    assert C.score_documents(docs.limit(0), model).count() == 0

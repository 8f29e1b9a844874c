import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mosaiq.llm import repeats
from mosaiq.llm import substring_dedup as S
from mosaiq.llm import suffix_dedup as X
from mosaiq.llm import windows as W


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}é" if i % 7 == 0 else f"w{i}" for i in range(40)]
    passage = lambda n: [rng.choice(words) for _ in range(n)]
    shared = [passage(35) for _ in range(4)]
    out = [None, "", "  \n", "one"]
    for i in range(40):
        text = passage(rng.randrange(5, 60))
        for _ in range(rng.randrange(3)):
            at = rng.randrange(len(text) + 1)
            lo = rng.randrange(10)
            text[at:at] = rng.choice(shared)[lo : lo + rng.randrange(18, 30)]
        out.append(rng.choice([" ", "\n", "\t ", "  "]).join(text))
        if i % 6 == 0:
            out.append(out[-1])
        if i % 9 == 0:
            out.append(out[-1] + " tail " + out[-1])
    return out


def plain_words(texts, window=20):
    seen, out = set(), []
    for t in texts:
        words = (t or "").encode().split()
        gone = [False] * len(words)
        for s in range(len(words) - window + 1):
            key = tuple(words[s : s + window])
            if key in seen:
                gone[s : s + window] = [True] * window
            seen.add(key)
        kept = b" ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


def plain_spans(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    return [[(r.start(), r.end()) for r in re.finditer("1+", "".join(map(str, covered(d, seen, window))))] for d in data]


def covered(d, seen, window):
    gone = np.zeros(len(d), int)
    for i in range(len(d) - window + 1):
        if seen[d[i : i + window]] > 1:
            gone[i : i + window] = 1
    return gone.tolist()


def plain_bytes(texts, window):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + window] for d in data for i in range(len(d) - window + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d), bool)
        for i in range(len(d) - window + 1):
            if seen[d[i : i + window]] > 1:
                gone[i : i + window] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((len(d), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(d, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


@pytest.mark.parametrize("seed,shard", [(1, 1 << 21), (2, 1 << 21), (3, 300)])  # a small shard sends anchors the way of single windows
def test_words_are_removed_as_brute_force_does(spark, seed, shard):
    texts = corpus(seed)
    docs = spark.createDataFrame([(i * 3, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int").repartition(5)
    got = {r.doc_id: (r.n_words, r.n_removed, hashlib.sha256(r.text.encode()).hexdigest()) for r in S.remove_repeats(docs, shard_bytes=shard, anchor_words=shard // 6).collect()}
    assert [got[i * 3] for i in range(len(texts))] == plain_words(texts)


@pytest.mark.parametrize("seed,shard,anchor", [(1, 1 << 20, 1 << 20), (2, 1, 1 << 20), (3, 200, 200)])
def test_bytes_are_removed_as_brute_force_does(spark, seed, shard, anchor):
    texts, window, passage = corpus(seed), 60, 37
    texts.append("ab" * 70 + "x" + "ba" * 60)  # stretches of one anchor that overlap
    texts.append("pq rs tu vw xy " + "".join(chr(200 + i) for i in range(9)) + " pq rs tu vw xy " + "k" * 9 + " pq rs tu vw xy")
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, kept int").repartition(5)
    rows = X.remove_repeats(docs, window=window, passage=passage, shard_bytes=shard, anchor_bytes=anchor).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows}
    assert [got[i] for i in range(len(texts))] == plain_bytes(texts, window)
    passages = {r.doc_id: [(x.start, x.end) for x in r.passages] for r in rows}
    assert [passages[i] for i in range(len(texts))] == plain_spans(texts, passage)


def test_default_window_and_long_text(spark, monkeypatch):
    monkeypatch.setattr(repeats, "HOT", 1)  # every class that repeats is hot
    rng = random.Random(9)
    long = " ".join(f"{rng.randrange(10**6)}" for _ in range(20000))
    texts = [long, "x " + long[5000:5450] + " y", "z" * 900, "short"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in X.digest(docs).collect()}
    assert got[1][1] >= 450 and got[0][1] == got[1][1] and got[2][1] == 900 and got[3][1] == 0
    assert [r.n_removed for r in S.digest(docs).orderBy("doc_id").collect()] == [r[1] for r in plain_words(texts)]


def test_rows_without_own_ids(spark):
    t = " ".join(f"w{i}" for i in range(30))
    u = t + " end"
    docs = spark.createDataFrame([(1, t), (1, t), (None, u), (2, t), (3, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in S.digest(docs).collect()))
    assert got == [(0, 31, 0), (1, 30, 30), (1, 30, 30), (2, 30, 30), (3, 0, 0)]
    b = X.remove_repeats(docs, window=50).collect()
    assert len(b) == 5 and all(r.n_removed >= 50 for r in b if r.n_bytes)
    assert S.digest(docs.limit(0)).count() == 0 and X.digest(docs.limit(0)).count() == 0


tokens = st.lists(st.sampled_from("abc"), max_size=30)


@settings(max_examples=200, deadline=None)
@given(st.lists(tokens, min_size=1, max_size=4), tokens)
def test_automaton_gives_matching_statistics(texts, query):
    automaton = S.SuffixAutomaton()
    for t in texts:
        automaton.add(t)
    subs = {tuple(t[i:j]) for t in texts for i in range(len(t)) for j in range(i, len(t) + 1)}
    want = [max(k for k in range(e + 2) if tuple(query[e + 1 - k : e + 1]) in subs or k == 0) for e in range(len(query))]
    assert automaton.statistics(query) == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab", max_size=40), min_size=1, max_size=4))
def test_run_length_index_measures_all_matches(parts):
    text = np.frombuffer("".join(p + "\x7f" for p in parts).encode(), np.uint8)
    data = text.tobytes()
    n = len(data)

    def match(i, j):
        k = 0
        while max(i, j) + k < n and data[i + k] == data[j + k]:
            k += 1
        return k

    index = X.RunLengthIndex(text)
    assert index.match.tolist() == [max((match(i, j) for j in range(n) if j != i), default=0) for i in range(n)]
    assert index.runs <= n


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), max_size=40), max_size=6), st.integers(3, 9))
def test_stretches_cover_each_window_once(texts, length):
    units = np.array([x for t in texts for x in t], np.uint64)
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    found = W.stretches(units, offsets, length, 2, 0x9E3779B97F4A7C15)
    covered = Counter((int(t), int(s) + k) for t, s, c in zip(found.text, found.start, found.windows, strict=True) for k in range(c))
    assert covered == Counter((d, i) for d, t in enumerate(texts) for i in range(len(t) - length + 1))
    anchors = {}
    for t, s, c, a in zip(found.text, found.start, found.windows, found.anchor, strict=True):
        for k in range(c):
            key = tuple(texts[t][s + k : s + k + length])
            assert anchors.setdefault(key, a) == a

import random
import textwrap
from collections import Counter
from fractions import Fraction

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from mosaiq.llm import decontamination as D
from mosaiq.llm import license_scan as L
from mosaiq.llm import mixing as M
from mosaiq.llm import registry
from mosaiq.llm import sharding as S
from mosaiq.llm.common import documents


# ---- Decontamination
def plain_distance(pattern, text):
    """The least word edits from the pattern to any stretch of text, by the full table."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(pattern, 1):
        new = [i]
        for j, y in enumerate(text, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=12), st.lists(st.sampled_from("abcd"), max_size=25))
def test_bit_parallel_distance_is_that_of_the_table(pattern, text):
    want = plain_distance(pattern, text)
    got = D.search(D.masks_of(pattern), len(pattern), text, len(pattern) - 1)
    assert (got[0] if got else len(pattern)) == want


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**6))
def test_no_item_within_the_budget_is_missed(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(12)]
    items = [D.Item(i, tuple(rng.choice(words) for _ in range(rng.randrange(8, 20))), 0) for i in range(3)]
    items = [x._replace(budget=int(0.2 * len(x.words))) for x in items]
    text = [rng.choice(words) for _ in range(40)]
    for x in items[:2]:
        copy = list(x.words)
        for _ in range(rng.randrange(x.budget + 2)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        at = rng.randrange(len(text))
        text[at:at] = copy
    found = {h.item_id for h in D.Matcher(items).find(" ".join(text).upper() + ".")}
    assert found == {x.item_id for x in items if plain_distance(x.words, text) <= x.budget}


def test_leaks_in_tables(spark):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today"
    near = item.replace("brown", "red").replace("old ", "").upper()
    rows = [(1, f"xx {item} yy"), (2, near), (3, "nothing of it"), (4, None), (1, f"xx {item} yy"), (5, "### ".join(item.split(" "))), (6, item[:30])]
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, item), (8, None), (9, "too short"), (10, item)], "item_id long, text string")
    got = {r.doc_id: r for r in D.leak_report(docs, bench).collect()}
    assert set(got) == {1, 2, 5} and got[1].item_ids == [7, 10] and got[1].least_distance == 0 and got[2].least_distance == 2
    assert got[1].spans.split(",")[0] == f"7:3:{3 + len(item)}:0"
    small = {r.doc_id for r in D.leak_report(docs, bench, block_chars=10).collect()}
    assert small == {1, 2, 5}
    assert sorted(r.doc_id for r in D.drop_leaked(docs, bench).collect()) == [3, 4, 6]
    assert D.leak_report(docs, bench.limit(0)).count() == 0 and D.leak_report(docs.limit(0), bench).count() == 0


def test_rows_that_share_an_id_leak_each(spark):
    item = "The quick brown fox jumps over the lazy dog near the old river bank today"
    rows = [(None, item), (None, "clean"), (None, None), (4, f"x {item}"), (4, "clean"), (4, "clean"), (4, f"y {item}"), (8, "word " * 100_000 + item)]
    docs, bench = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, item)], "item_id long, text string")
    assert sorted((r.doc_id or 0, r.text or "") for r in D.drop_leaked(docs, bench).collect()) == [(0, ""), (0, "clean"), (4, "clean"), (4, "clean")]
    assert sorted((r.doc_id or 0, r.n_leaks) for r in D.leak_report(docs, bench).collect()) == [(0, 1), (4, 1), (4, 1), (8, 1)]


def test_short_items_are_found_without_edits(spark):
    items = [(1, "What is two plus two?"), (2, "北京是中华人民共和国的首都"), (3, "..."), (4, None)]
    texts = ["He asked: what is TWO plus two - and left", "what is two plus three", "说。北京是中华人民共和国的首都。", "...", None, "北京是中华人民"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, *r.item_ids, r.least_distance) for r in D.leak_report(docs, bench).collect()} == {(0, 1, 0), (2, 2, 0)}
    assert sorted(r.doc_id for r in D.drop_leaked(docs, bench).collect()) == [1, 3, 4, 5]


# ---- Mixing
def plain_seats(seats, votes, most):
    given_ = [0] * len(votes)
    for _ in range(seats):
        best = max((i for i in range(len(votes)) if votes[i] > 0 and given_[i] < most[i]), key=lambda i: (Fraction(votes[i]) / (2 * given_[i] + 1), -i), default=None)
        if best is None:
            break
        given_[best] += 1
    return given_


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=7), st.integers(0, 60))
def test_seats_go_to_the_highest_quotients(votes, seats):
    most = [v // 7 + 1 for v in votes]
    assert M.sainte_lague(seats, votes) == plain_seats(seats, votes, [seats] * len(votes))
    assert M.sainte_lague(seats, votes, most) == plain_seats(seats, votes, most)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), max_size=8))
def test_targets_share_all_and_stop_at_the_bound(sizes):
    weights = [1 + i % 3 for i in range(len(sizes))]
    got = M.targets(sizes, weights)
    assert abs(sum(got) - sum(sizes)) < 1e-6 and all(t <= 3 * s + 1e-6 for t, s in zip(got, sizes, strict=True))
    free = [t / w for t, w, s in zip(got, weights, sizes, strict=True) if t < 3 * s - 1e-6]
    assert not free or max(free) - min(free) < 1e-6 and all(t / w <= free[0] + 1e-6 for t, w in zip(got, weights, strict=True))


def plain_mix(rows, block, seed=17, n_shards=16):
    """taken by (doc_id, source): every word of each source's stream asks its own block."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    docs = spark.createDataFrame(rows)
    placed = docs.select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"), M._place(docs, seed).alias("place")).collect()
    names = sorted({r.source for r in placed}, key=lambda s: (s is None, (s or "").encode()))
    streams = {s: [r for r in sorted((r for r in placed if r.source == s), key=lambda r: (r.place, r.doc_id or -1)) for _ in r.text.split()] for s in names}
    plan = M.plan_mix([len(streams[s]) for s in names], block, n_shards=n_shards)
    taken = {(r.doc_id, r.source): 0 for r in placed if r.doc_id is not None}
    for s, p in zip(names, plan, strict=True):
        assert sum(p["quotas"]) == -(-(p["words"] - p["rounds"] * p["source_size"]) // block)
        chosen = {k + n_shards * i for k, q in enumerate(p["quotas"]) for i in range(q)}
        for at, r in enumerate(streams[s]):
            j = at // block
            extra = j in chosen and (j != p["last"] or at % block < p["cut"])
            if r.doc_id is not None:
                taken[r.doc_id, s] += p["rounds"] + extra
    return taken


def test_rows_that_share_an_id_are_mixed_each(spark):
    rows = [(5, "a b c " * 9, "x"), (5, "d e f " * 9, "y"), (None, "g h i " * 9, "x"), (None, "g h i " * 9, "x"), (None, None, None), (6, "w " * 50_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got, mixed = M.mix_sources(docs).collect(), M.mixed_documents(docs).collect()
    assert len(got) == 6 and all(r.taken <= 3 * r.size for r in got)
    assert {(r.doc_id, r.source) for r in mixed} == {(r.doc_id, r.source) for r in got if r.taken}


def test_mix_of_tables(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randrange(200), rng.choice(["b", "a", "é", None, "a", "a"]), 1) for i in range(300)] + [(900, None, "a", 1), (901, "", "z", 1), (None, "x y", "a", 1), (None, "x y", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = M.mix_sources(docs, block_tokens=16).collect()
    assert len(got) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in got)
    by = {}
    for r in got:
        x = by.setdefault(r.source, [0, 0, r.target, r.source_size])
        x[0] += r.taken
        x[1] += r.size
    assert list(sorted(by, key=lambda s: (s is None, (s or "").encode()))) == ["a", "b", "z", "é", None]
    assert all(abs(t - goal) <= 16 and size == total for t, size, goal, total in by.values())
    assert sorted(map(str, M.mix_sources(docs.repartition(7), block_tokens=16).collect())) == sorted(map(str, got))
    assert {(r.doc_id, r.source): r.taken for r in got if r.doc_id is not None} == plain_mix(docs.collect(), 16)
    mixed = Counter(r.doc_id for r in M.mixed_documents(docs, block_tokens=16).collect() if r.doc_id is not None)
    assert all(mixed[r.doc_id] == -(-r.taken // r.size) for r in got if r.taken and r.doc_id is not None)
    assert M.mix_sources(docs.limit(0)).count() == 0


# ---- Sharding
def keyed(spark, n=2000):
    rng = random.Random(3)
    return spark.createDataFrame([(i, "é" * rng.randrange(60), i) for i in range(n)] + [(None, None, 0), (None, "x", 0), (7, "twice", 0), (7, "twice", 0)], "doc_id long, text string, shard int")


@pytest.mark.parametrize("law", ["rows", "bytes", "key"])
def test_shards_and_slots(spark, law):
    import zlib

    docs = keyed(spark)
    got = S.shard_documents(docs, law=law).collect()
    texts = docs.collect()
    assert len(got) == len(texts)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in texts)
    shards = {}
    for r in got:
        shards.setdefault(r.shard, []).append(r)
    assert set(shards) <= set(range(16)) and all(sorted(r.slot for r in x) == list(range(len(x))) for x in shards.values())
    counts, loads = [len(x) for x in shards.values()], [sum(r.size for r in x) for x in shards.values()]
    if law == "rows":
        assert max(counts) - min(counts) <= 1 and len(counts) == 16
    if law == "bytes":
        assert max(loads) <= 1.05 * sum(loads) / 16 and min(loads) >= 0.95 * sum(loads) / 16
    if law == "key":
        assert all(r.grown_shard in (r.shard, 16) for r in got) and any(r.grown_shard == 16 for r in got)
    else:
        assert all(r.grown_shard is None for r in got)
    assert S.shard_documents(docs.limit(0), law=law).count() == 0


def test_rows_go_where_a_walk_on_the_ring_leads(spark):
    """Key by key: own cells first, then clockwise to the next node with room."""
    n_shards, bits = 5, 8
    docs = spark.createDataFrame([(i, f"t{i}" * (i % 3)) for i in range(700)] + [(800, "word " * 100_000)], "doc_id long, text string")
    got = {r.doc_id: r.shard for r in S.shard_documents(docs, n_shards=n_shards, law="rows", virtual_nodes=4, cell_bits=bits).collect()}
    text = F.coalesce("text", F.lit(""))
    place = F.xxhash64("doc_id", (F.octet_length(text) + 1).cast("long"), F.crc32(F.encode(text, "UTF-8")))
    keys = sorted(((r.place & (1 << 64) - 1) >> 64 - bits, r.place, r.doc_id) for r in docs.select("doc_id", place.alias("place")).collect())
    owner, free, want, over = S.ring(n_shards, 4, bits), [141, 140, 140, 140, 140], {}, []
    for cell, _, doc in keys:
        if free[owner[cell]]:
            free[owner[cell]] -= 1
            want[doc] = owner[cell]
        else:
            over.append((cell, doc))
    for cell, doc in over:
        while not free[owner[cell]]:
            cell = (cell + 1) % (1 << bits)
        free[owner[cell]] -= 1
        want[doc] = owner[cell]
    assert got == want


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=8, max_size=8), st.integers(1, 4))
def test_overflow_walks_clockwise_and_nothing_is_lost(loads, n):
    owner = [i % n for i in range(8)]
    capacity = S.capacities(sum(loads), n, 0.0)
    got = S.walk(loads, owner, capacity)
    assert [sum(hi - lo for lo, hi, _ in p) for p in got] == loads
    assert [sum(hi - lo for p in got for lo, hi, s in p if s == k) for k in range(n)] == capacity


# ---- Licences
#: Sentences about a license that the model was never trained on.
UNSEEN = ("This program is made available under the {}", "All files here are covered by the {}", "The library, by Jo Blow, is under the {} since 2012", "We chose the {} as our license.", "Copyright 2020 The Authors, {}")
TALK = (
    "The members met and the general public was invited.", "He was given permission to drive the old car.", "A new version of the law was published in the city.", "Er geht mit dem Hund in die Stadt.", "They hold a license to fish in the lake.",
    "Use of the library is free for any person.", "The weather was good, and all of us went to the sea.", "Licensed under the Quux Public License v2", "Rights of the public and of the author", "the apache people lived in the west", "Copyright of the photographs is unclear.",
)


def scanned(spark, rows):
    by = {}
    for r in L.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS paragraph")).collect():
        by.setdefault(r.doc_id, []).append((r.paragraph, r.family, r.confirmed))
    return {k: sorted(v) for k, v in by.items()}


def test_unseen_sentences_name_the_family(spark):
    cases = [(family, f"Some words of a text.\n\n{said.format(name)}\n\nmore") for family, names in L.NAMES.items() for name in names for k, said in enumerate(UNSEEN) if (len(name) + k) % 2]
    got = scanned(spark, [*enumerate(t for _, t in cases), *((10_000 + i, t) for i, t in enumerate(TALK)), (20_000, None), (20_001, "--\n \n")])
    right = sum(any(f == family for _, f, _ in got.get(i, ())) for i, (family, _) in enumerate(cases))
    assert right >= 0.95 * len(cases)
    assert all(f == family for i, (family, _) in enumerate(cases) for _, f, sure in got.get(i, ()) if sure)
    assert not any(f != L.UNKNOWN for i in got if i >= 10_000 for _, f, _ in got[i])
    assert L.scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_gates_drop_nothing_that_could_be_named(spark):
    model = L.Model(spark)
    texts = [*TALK, *(s.format(n) for s in UNSEEN for ns in L.NAMES.values() for n in ns[:2]), "Кот и пёс", "the of and to", "mit", "MIT", ""]
    rows = spark.createDataFrame([*enumerate(texts)], "i long, text string").select("i", model.cued(F.col("text")).alias("cued"), model.bound(model.grams_of(F.col("text"))).alias("bound"), model.bounds(model.grams_of(F.col("text"))).alias("bounds")).collect()
    for r in rows:
        found = [g for g in L.grams_of(L.words_of(texts[r.i])) if g in model.weights]
        z = [b + sum(model.weights[g][c] for g in found) for c, b in enumerate(model.bias)]
        open_ = any(r.bounds[c] > model.bias[-1] - b - 1e-6 for c, b in enumerate(model.bias[:-1]))
        assert r.cued and r.bound > model.least and open_ or max(z[:-1]) < z[-1]
        assert all(r.bounds[c] >= v - z[-1] - (model.bias[c] - model.bias[-1]) - 1e-6 for c, v in enumerate(z[:-1])) and r.bound >= max(r.bounds) - 1e-6


def test_columns_score_as_the_model(spark):
    classes, weights, bias = L.train()
    lines = ["Released under the MIT License.", "All rights are reserved here, all rights", "cc by", "A GPL license. GNU!", "Released under the MIT License."]
    docs = spark.createDataFrame([*enumerate(lines)], "doc_id long, text string")
    got = L.scan_licenses(docs, 0.0).collect()
    for r in got:
        p = L.softmax([b + sum(weights[g][c] for g in L.grams_of(L.words_of(lines[r.doc_id])) if g in weights) for c, b in enumerate(bias)])
        assert r.probability == pytest.approx(max(p), abs=1e-6) and (r.family == classes[p.index(max(p))])
    assert {r.doc_id for r in got} >= {0, 3, 4}


GPL_HEADER = """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version."""


def test_wrapped_notices_are_seen_whole(spark):
    long = [(n, t) for n, ts in L.TEXTS.items() for t in ts if len(t.split()) > 14]
    rows = [(i, "Talk of the day.\n" + textwrap.fill(t, 40) + "\nmore talk") for i, (_, t) in enumerate(long)]
    two = "title\n\n" + GPL_HEADER + "\n \n* * *\n\n# Released under the\r\n# MIT License.\nLicensed under the Apache License, Version 2.0.\n"
    around = "\n".join(["He came to the house of the old man in the town"] * 400)
    rows += [(100, GPL_HEADER), (101, two), (101, two), (102, f"{around}\n{GPL_HEADER}\n{around}"), (None, GPL_HEADER), (103, "x " * 50_000 + "\nLicensed under the MIT License.")]
    by = scanned(spark, rows)
    assert all((n, True) in [x[1:] for x in by[i]] and {x[1] for x in by[i]} == {n} for i, (n, _) in enumerate(long))
    assert by[100] == by[None] == [(0, "gpl-3.0", True)] and by[102] == [(400, "gpl-3.0", True)] and by[103] == [(1, "mit", True)]
    assert [x for x in by[101] if x[2]] == [(2, "gpl-3.0", True), (10, "mit", True), (11, "apache-2.0", True)]


def test_known_notices(spark):
    notices = {
        "Released under the GPLv3.": "gpl-3.0", "Released under MIT.": "mit", "Code available under MIT.": "mit", "Distributed under the AGPLv3": "agpl-3.0", "Dedicated to the public domain.": "public-domain", "Licensing: GPLv2+": "gpl-2.0",
        "Lizenz: MIT": "mit", "Licensed under the Eclipse Public License 2.0": "epl-2.0", "Boost Software License": "bsl-1.0", "This is the Unlicense, see below.": "unlicense", "SPDX-License-Identifier: BSD-3-Clause": "bsd",
    }
    got = scanned(spark, [*enumerate(notices)])
    assert {i: [x[1] for x in got.get(i, ())] for i in range(len(notices))} == {i: [f] for i, f in enumerate(notices.values())}


# ---- The pipeline
def test_pipeline_against_its_operators(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf)
    rows = docs.collect()
    out = {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, sf)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out[name] = docs.collect()
    text = {r.doc_id: r.text for r in rows}
    assert all(len(r.text.split()) >= 10 for r in out["quality_rules"])
    from tests.llm.test_joins import plain

    kept = [(r.doc_id, r.text) for r in sorted(out["quality_rules"])]
    want = {d for (d, _), (_, c) in zip(kept, plain(kept), strict=True) if c == d}
    assert {r.doc_id for r in out["near_duplicates"]} == want
    items = [D.Item(r.item_id, tuple(m.group().lower() for m in D.tokens(r.text)), 0) for r in documents(spark, sf, "benchmark").collect()]
    items = [x._replace(budget=int(0.2 * len(x.words))) for x in items]
    leaked = {d for d in want if any(plain_distance(x.words, [m.group().lower() for m in D.tokens(text[d])]) <= x.budget for x in items)}
    assert {r.doc_id for r in out["decontamination"]} == want - leaked
    last = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert Counter(r.doc_id for r in last) == Counter(r.doc_id for r in out["mixing"])
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == {r.doc_id for r in last}


def test_empty_tables_pass_all_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = documents(spark, sf).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
        docs = spark.createDataFrame([], docs.schema)


def test_all_ten_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 11))

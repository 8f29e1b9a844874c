"""The small linkage set end to end, and each stage's rules."""

import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mosaiq.functions import similarity as S
from mosaiq.functions.similarity import FEATURES
from mosaiq.operators import blocking as B
from mosaiq.operators import decide as D
from mosaiq.operators import evaluate as E
from mosaiq.operators import model as M
from mosaiq.operators import pairs as P
from mosaiq.operators import validate as V
from mosaiq.plans import linkage_queries as L
from mosaiq.sources import tables as R
from mosaiq.streaming.incremental import match_arrivals

SF = "/root/testdata/sf0.001"
S1 = [("S1-1", "McDonalds", "123 Main St", "US"), ("S1-2", "Burger King", "456 Oak Ave", "US"), ("S1-3", "Wendys", "789 Pine Rd", "US"), ("S1-4", "Subway", "101 Elm St", "India"), ("S1-5", "KFC", "202 Maple Dr", "UK")]
S2 = [("S2-10", "Mc Donalds Inc", "123 Main Street", "US"), ("S2-20", "Burger King LLC", "456 Oak Avenue", "US"), ("S2-30", "Pizza Hut", "333 Walnut", "US")]
S3 = [("S3-100", "Wendys Restaurant", "789 Pine Road", "US"), ("S3-200", "SubWay Sandwiches", "101 Elm Street", "India")]
TRUTH = [("S1-1", "S2-10"), ("S1-2", "S2-20"), ("S1-3", "S3-100"), ("S1-4", "S3-200"), ("S1-5", None)]
CANDIDATES = [("S1-1", "S2-10,S2-20,S2-30"), ("S1-2", "S2-10,S2-20,S3-100"), ("S1-3", "S3-100,S3-200,S2-30"), ("S1-4", "S3-200,S2-10"), ("S1-5", "S2-30,S3-100")]


@pytest.fixture(scope="module")
def world(spark):
    records = lambda rows: spark.createDataFrame(rows, R.RECORD)
    return records(S1), R.catalog(records(S2), records(S3)).drop("source"), spark.createDataFrame(TRUTH, R.MATCHES)


def lists(spark, rows, name="ids_text"):
    return spark.createDataFrame(rows, f"s1_id string, {name} string")


def test_end_to_end(spark, world, tmp_path):
    s1, catalog, truth = world
    candidates = spark.createDataFrame(CANDIDATES, R.CANDIDATES)
    R.write_tsv(candidates, str(tmp_path / "c"), ["source1_entity_id"])
    read = R.read_id_lists(spark, str(tmp_path / "c"))
    links = P.explode_truth(truth)
    pairs = P.label_pairs(P.explode_candidates(read), links)
    made = P.featurize(P.attach_records(pairs, s1, catalog)).cache()
    row = {r.s1_id + r.cand_id: r for r in made.collect()}
    best = row["S1-1S2-10"]
    assert best.name_ratio == round(2 * 9 / (9 + 23), 4) and best.street_num_match == 1.0 and best.country_match == 1.0 and best.addr_token_sort == 1.0
    assert row["S1-5S2-30"].digits_match == 0.0 and row["S1-4S3-200"].source_origin == 0.0
    assert all(0 <= r[f] <= 1 for r in row.values() for f in FEATURES)
    scored = made.withColumn("p", (F.col("name_token_set") + F.col("addr_token_sort")) / 2)
    out = {r[0]: r[1] for r in D.match_rows(s1, D.decide(scored, 0.8, 0.8)).collect()}
    assert out["S1-2"] == "S2-20" and out["S1-3"] == "S3-100" and out["S1-5"] == "" and len(out) == 5
    R.write_pairs(made.select(*FEATURES, F.col("s1_id").alias("source1_entity_id"), F.col("cand_id").alias("candidate_entity_id"), "label"), str(tmp_path / "p"), "csv")
    back = R.read_pairs(spark, str(tmp_path / "p"), "csv")
    assert back.count() == made.count() and back.schema == R.PAIRS


def test_unknown_ids_have_empty_records(spark, world):
    s1, catalog, _ = world
    pairs = spark.createDataFrame([("S1-1", "S2-none", 1)], "s1_id string, cand_id string, rank int")
    r = P.featurize(P.attach_records(pairs, s1, catalog)).first()
    assert r.name_ratio == 0.0 and r.is_addr_missing == 1.0 and r.street_num_match == 0.5 and r.country_match == 0.0


def test_tfidf_finds_names_and_never_nothing(spark):
    catalog = spark.createDataFrame([(f"s2_{i}", f"Business Alpha {i}") for i in range(100)] + [(f"s3_{i}", f"Company Beta {i}") for i in range(50)], "entity_id string, text string")
    queries = spark.createDataFrame([(f"s1_{i}", "Business Alpha 5" if i < 50 else "Company Beta 10" if i < 100 else "Qqq") for i in range(150)], "entity_id string, text string")
    found = B.tfidf_candidates(queries, catalog, 5)
    rows = B.candidate_lists(found, queries).collect()
    assert len(rows) == 150 and all(len(r[1].split(",")) == 5 for r in rows if int(r[0][3:]) < 100) and all(r[1] == "" for r in rows if int(r[0][3:]) >= 100)
    first = {r.query_id: r.candidate_id for r in found.where("rank = 1").collect()}
    assert first["s1_0"] == "s2_5" and first["s1_60"] == "s3_10"


def test_dense_blocks_change_nothing(spark):
    df = spark.createDataFrame([(i, [float((i * 7) % 5), float((i * 3) % 4), 1.0]) for i in range(30)], "vec_id long, embedding array<float>")
    one = {tuple(r) for r in B.dense_candidates(df, df, 3, None).collect()}
    many = {tuple(r) for r in B.dense_candidates(df, df, 3, None, block=7).collect()}
    assert one == many and len(one) == 90


def test_sampling_keeps_matches_and_first_others(spark):
    pairs = spark.createDataFrame([("a", f"c{i:02}", i, 1 if i in (5, 20) else 0) for i in range(1, 31)] + [("b", f"c{i:02}", i, 0) for i in range(1, 31)], "s1_id string, cand_id string, rank int, label int")
    links = spark.createDataFrame([("a", "c05"), ("a", "c20")], "s1_id string, cand_id string")
    got = {(r.s1_id, r.label): r["count"] for r in P.sample_negatives(pairs, links).groupBy("s1_id", "label").count().collect()}
    assert got == {("a", 1): 2, ("a", 0): 12, ("b", 0): 8}
    assert P.truncate_candidates(pairs, 30).count() == 60


def test_f05_rules(spark):
    rows = spark.createDataFrame([(["A", "B", "C"], ["A", "C"]), ([], []), (["A"], []), ([], ["A"])], "p array<string>, t array<string>")
    assert [round(r[0], 3) for r in rows.select(E.f05_of_lists(F.col("p"), F.col("t"))).collect()] == [0.714, 1.0, 0.0, 0.0]


def test_scan_against_plain_counts(spark):
    scored = [("a", "x", 0.9, 1), ("a", "y", 0.6, 0), ("b", "x", 0.55, 0), ("c", "z", 0.7, 1), ("c", "w", 0.39, 0)]
    true = {"a": 1, "b": 0, "c": 2, "d": 0}
    df = spark.createDataFrame(scored, "s1_id string, cand_id string, p double, label int")
    entities = spark.createDataFrame([*true.items()], "s1_id string, n_true int")
    got = {r.threshold: (r.macro_f05, r.n_pred_entities, r.n_kept_singletons) for r in E.scan_thresholds(df, entities).collect()}

    def plain(t):
        total, said, kept = 0, 0, 0
        for s, n in true.items():
            hits = [x for x in scored if x[0] == s and x[2] >= t]
            tp = sum(x[3] for x in hits)
            said += bool(hits)
            kept += not hits and n == 0
            if not n:
                total += not hits
            elif tp:
                p, r = tp / len(hits), tp / n
                total += 1.25 * p * r / (0.25 * p + r)
        return round(total / len(true), 9), said, kept

    assert len(got) == 48 and all(got[t] == plain(t) for t in got)
    assert E.best_threshold(E.scan_thresholds(df, entities)).first().threshold == min(t for t in got if got[t][0] == max(x[0] for x in got.values()))


def test_recall_leaves_singletons_out(spark):
    truth = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "s1_id string, cand_id string")
    found = spark.createDataFrame([("a", "x"), ("b", "z"), ("c", "q")], "s1_id string, cand_id string")
    assert tuple(E.blocking_recall(truth, found).first()) == (3, 2, round(2 / 3, 9))


def test_choice_and_config():
    assert E.choose_model({"ensemble": 0.5, "lgbm": 0.5, "xgboost": 0.5}) == "ensemble" and E.choose_model({"ensemble": 0.4, "lgbm": 0.5, "xgboost": 0.5}) == "lgbm"
    assert D.singleton_cutoff(0.64) == 0.75 and D.singleton_cutoff(0.9) == 0.86
    assert R.read_config(None)["model_mode"] == "lgbm" and R.read_config("{}")["singleton_cutoff"] == 0.75
    assert R.read_config(R.write_config({"optimal_threshold": 0.9}))["singleton_cutoff"] == pytest.approx(0.85)


def test_validator(spark):
    got = lists(spark, [("S1-1", "S2-1,S2-1"), ("S1-1", "S2-2"), ("S1-2", "S1-9,X-1,S2-3,"), ("S1-3", None), ("S1-8", "S3-77")])
    need = spark.createDataFrame([("S1-1",), ("S1-2",), ("S1-3",), ("S1-4",)], "s1_id string")
    valid = spark.createDataFrame([("S2-1",), ("S2-2",), ("S2-3",)], "entity_id string")
    found = {r.rule: (r.n, r.examples) for r in V.numbered(V.check_lists(got, need, valid)).collect()}
    assert found == {"duplicate_row": (1, "S1-1"), "duplicate_id": (1, "S1-1"), "self_match": (1, "S1-9"), "wrong_prefix": (2, ",X-1"), "missing_s1": (1, "S1-4"), "unexpected_s1": (1, "S1-8"), "unknown_id": (1, "S3-77")}
    assert V.exit_code(V.check_lists(got, need)) == 1 and V.exit_code(V.check_lists(lists(spark, [("S1-1", "S2-1")]), spark.createDataFrame([("S1-1",)], "s1_id string"))) == 0
    warn = V.check_subset(got, lists(spark, [("S1-1", "S2-1,S2-2"), ("S1-2", "S1-9,X-1,S2-3,")])).collect()
    assert [(r.severity, r.rule, r.examples) for r in warn] == [("warning", "not_in_candidates", "S1-8")]
    lines = spark.createDataFrame([(1, "source1_entity_id,matched"), (2, "S1-1 no tab"), (3, "S1-2\tS2-1"), (4, "")], "n long, value string")
    assert {(r.rule, r.examples) for r in V.check_lines(lines, ("source1_entity_id", "matched_entity_ids")).collect()} == {("comma_header", "source1_entity_id,matched"), ("no_tab", "2")}
    assert tuple(V.list_counts(got).first()) == (5, 1, 4)


def test_split_is_exact_in_every_stratum(spark, tmp_path):
    truth = spark.createDataFrame([(f"S1-{i}", "S2-1" if i % 3 else None) for i in range(100)], R.MATCHES)
    s1 = spark.createDataFrame([(f"S1-{i}", "n", "a", "US" if i % 2 else None) for i in range(100)], R.RECORD)
    split = M.stratified_split(M.stratify(truth, s1))
    assert all(r.n_val == int(0.2 * r.n + 0.5) for r in M.split_counts(split).collect())
    assert {r.stratum for r in split.select("stratum").distinct().collect()} == {"US_True", "US_False", "nan_True", "nan_False"}
    R.write_splits(split, str(tmp_path / "t"), str(tmp_path / "v"))
    assert R.read_tsv(spark, str(tmp_path / "t"), R.MATCHES).count() + R.read_tsv(spark, str(tmp_path / "v"), R.MATCHES).count() == 100


def test_boosters_learn_and_come_back(spark, tmp_path):
    rows = [(f"s{i % 20}", f"c{i}", i % 2, float(i % 2) * 0.8 + (i % 7) / 50, (i * 13 % 10) / 10) for i in range(200)]
    df = spark.createDataFrame(rows, "s1_id string, cand_id string, label int, f0 double, f1 double")
    b = M.Boosters(rounds=3, depths=(2, 3), features=("f0", "f1")).fit(df)
    b.save(str(tmp_path / "m"))
    again = M.Boosters.load(str(tmp_path / "m"))
    again.features = b.features
    for mode in ("ensemble", "xgboost", "lgbm"):
        p = {r.cand_id: r.p for r in again.score(df, mode).collect()}
        assert all((p[c] > 0.5) == (y == 1) for _, c, y, *_ in rows)
    entities = df.groupBy("s1_id").agg(F.sum("label").cast("int").alias("n_true"))
    config = M.calibrate(again, df, entities)
    assert config["model_mode"] == "ensemble" and config["validation_macro_f05"] == 1.0


def test_arrivals_match_once(spark, world, tmp_path):
    s1, _, _ = world
    R.write_tsv(s1, str(tmp_path / "in"))
    q = match_arrivals(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"), lambda batch: batch.select("entity_id"))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


def test_files_are_validated(spark, tmp_path):
    need = spark.createDataFrame([("S1-1",), ("S1-2",)], "s1_id string")
    good = "source1_entity_id\tmatched_entity_ids\nS1-1\tS2-1\nS1-2\t\n"
    (tmp_path / "m.tsv").write_text(good)
    (tmp_path / "c.tsv").write_text("source1_entity_id\tcandidate_entity_ids\nS1-1\tS2-9\nS1-2\t\nno tab here\n")
    (tmp_path / "comma.tsv").write_text("source1_entity_id,matched_entity_ids\nS1-1,S2-1\n")
    (tmp_path / "empty.tsv").write_text("")
    rules = lambda m, c=None, ids=None: {r.rule for r in V.validate_files(spark, str(tmp_path / m), c and str(tmp_path / c), need, ids).collect()}
    ids = spark.createDataFrame([("S2-1",)], "entity_id string")
    assert rules("m.tsv", ids=ids) == set() and rules("m.tsv") == {"id_check_off"}
    assert rules("m.tsv", "c.tsv", ids) == {"no_tab", "unknown_id", "not_in_candidates"}
    assert rules("comma.tsv", ids=ids) == {"comma_header"} and rules("empty.tsv", ids=ids) == {"empty_file"}
    assert rules("none.tsv", "none.tsv", ids) == {"no_file", "no_candidates"}


def test_first_rows_are_those_of_the_first_splits(spark, tmp_path):
    """The file's second part is the larger, and each is read in several splits."""
    header = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
    for part, (a, b) in enumerate(((0, 300), (300, 2000))):
        (tmp_path / f"part-{part:05}.csv").write_text(header + "".join(f"S1-{i:05}\tname\taddress\tUS\n" for i in range(a, b)))
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    own.conf.set("spark.sql.files.openCostInBytes", "0")
    got = sorted(r[0] for r in R.read_tsv(own, str(tmp_path), R.RECORD, most=310).select("entity_id").collect())
    assert got == [f"S1-{i:05}" for i in range(310)]


def test_pairs_of_a_country_are_those_of_attached_records(spark):
    """Records move, pairs do not: no table of pairs is dealt out by its ids."""
    names = ["Acme Pvt. Ltd.", "acme private limited", "Warner Silver Blueport Inc", "WSBlueport", "", None, "x " * 50, "Kumar and Sons Kumar"]
    places = ["5 bis Rue Dignac, La Teste, 33260", "5 bis rue dignac; La Teste", "", None, "12 Elm St, Morganton", "12 elm str, morganton NC 28655", "Hill Lane, Garland", "G-3/571, COLONY"]
    rows = lambda p: spark.createDataFrame([(f"S{p}-{i}", names[i % 8], places[(i * 3 + i // 8) % 8], ("US", "FR", "", None)[i % 7 % 4]) for i in range(40)], R.RECORD)
    s1, catalog = rows(1), rows(2).unionByName(rows(3))
    pairs = s1.select(F.col("entity_id").alias("s1_id"), "country").join(catalog.select(F.col("entity_id").alias("cand_id"), "country"), "country").drop("country")
    plain = P.featurize(P.attach_records(pairs, s1, catalog)).select("s1_id", "cand_id", *FEATURES)
    made = P.featurize_by_country(s1, catalog)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, plain.collect()))
    attached = P.attach_by_country(s1, catalog)
    assert sorted(map(str, attached.collect())) == sorted(map(str, P.attach_records(pairs, s1, catalog).select(*attached.columns).collect()))
    for df in (made, attached):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(s1_id" not in plan and "hashpartitioning(cand_id" not in plan and "CartesianProduct" not in plan


def test_flags_of_a_country_are_those_of_attached_records(spark):
    """Hashes and sizes of strings are worked out for each record, not for each pair."""
    names = ["Acme Pvt. Ltd.", "acme private limited", "Warner Silver Blueport Inc", "Warner Silver Blueport Holding", "WSBlueport", "", None, "x " * 50, "wsblueport é"]
    places = ["5 bis Rue Dignac, La Teste, 33260", "5 bis rue dignac; La Teste", "", None, "12 Elm St, Morganton", "12 elm str, morganton NC 28655", "Hill Lane, Garland", "G-3/571, COLONY"]
    rows = lambda p: spark.createDataFrame([(f"S{p}-{i}", names[i % 9], places[(i * 3 + i // 8) % 8], ("US", "FR", "", None)[i % 7 % 4]) for i in range(60)], R.RECORD)
    s1, catalog = rows(1), rows(2).unionByName(rows(3))
    made = P.flags_by_country(s1, catalog)
    pairs = s1.select(F.col("entity_id").alias("s1_id"), "country").join(catalog.select(F.col("entity_id").alias("cand_id"), "country"), "country").drop("country")
    plain = P.featurize(P.attach_records(pairs, s1, catalog)).select(*made.columns)
    got = sorted(map(tuple, made.collect()))
    assert got == sorted(map(tuple, plain.collect())) and {0.0, 1.0} == {r[2] for r in got} == {r[3] for r in got}
    top = made._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "length(" not in top and "StartsWith" not in top and "_key" in top


def test_the_feature_file_is_packed(spark, tmp_path):
    row = ("S1-1", "S2-1", *[0.5] * 15, 0)
    df = spark.createDataFrame([row], "source1_entity_id string, candidate_entity_id string, " + ", ".join(f"{f} double" for f in FEATURES) + ", label int").withColumn("label", F.col("label").cast("byte"))
    R.write_pairs(df, str(tmp_path / "p"), "csv", rounded=True, packed="gzip")
    assert list((tmp_path / "p").glob("*.csv.gz")) and R.read_pairs(spark, str(tmp_path / "p"), "csv").first().source1_entity_id == "S1-1"


def test_packs_of_many_queries_score_as_blocks_do(spark):
    """Beyond a few queries no table of postings is joined: rows are made for the best only."""
    catalog = spark.createDataFrame([(f"c{i}", f"alpha {i * 7 % 50} beta {i % 13}") for i in range(3000)] + [("none", None)], "entity_id string, text string")
    queries = spark.createDataFrame([(i, f"alpha {i * 3 % 50} betta {i % 11}" if i % 9 else "QQ") for i in range(200)], "entity_id long, text string")
    few, many = B.tfidf_candidates(queries, catalog, 4), B.tfidf_candidates(queries, catalog, 4, block=16, passes=1)
    assert {tuple(r) for r in few.collect()} == {tuple(r) for r in many.collect()} and few.count() == 4 * 177
    plan = many._jdf.queryExecution().executedPlan().toString()
    assert "gram#" not in plan and "MapInArrow" in plan


def test_dense_is_as_by_plain_sums(spark):
    own = random.Random(2)
    rows = [(i, [own.uniform(-1, 1) / 3 for _ in range(24)]) for i in range(400)] + [(1000 + i, [0.25] * 24) for i in range(30)] + [(2000, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    queries, least = df.where("vec_id % 10 = 0"), 0.1
    got = {tuple(r) for r in B.dense_candidates(queries, df, 5, least).select("query_id", "candidate_id", "score", "rank").collect()}
    q, c = queries.toDF("query_id", "qv"), df.toDF("candidate_id", "cv")
    plain = B.top_k(q.crossJoin(c).where("query_id <> candidate_id").select("query_id", "candidate_id", F.round(B.dot(F.col("qv"), F.col("cv")), 9).alias("score")).where(F.col("score") >= least), 5)
    assert got == {tuple(r) for r in plain.collect()}
    assert "zip_with" not in B.dense_candidates(queries, df, 5, least)._jdf.queryExecution().optimizedPlan().toString()


def test_dense_topk_asks_for_every_row(spark, tmp_path):
    """Each vector is a query, ties and copies included; a task gives k rows of a query, however many copies there are."""
    rng = np.random.default_rng(5)
    v = np.round(rng.standard_normal((90, 4)), 1)
    v = np.concatenate([v, v[:30], np.repeat(v[:1], 200, 0)])
    v /= np.maximum(1e-9, np.sqrt((v * v).sum(1, keepdims=True)))
    df = spark.createDataFrame([(i * 7 % 1009, [*map(float, x)]) for i, x in enumerate(v)] + [(5000, None)], "vec_id long, embedding array<float>")
    df.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = entry.queries()["dense_topk"](spark, str(tmp_path)).collect()
    db = duckdb.connect()
    db.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    assert sorted(map(tuple, got)) == sorted(db.execute(entry.oracle_sql()["dense_topk"]).fetchall()) and len({r["query_id"] for r in got}) == 320
    x = pa.array(range(320))
    best = B._Nearest(x, v.astype(np.float32).astype(np.float64).tobytes(), 5, None)
    best.meet(x, v.astype(np.float32).astype(np.float64).tobytes())
    assert best.found.num_rows <= 320 * 15


def test_partial_and_contained_strings_of_packs_are_as_pair_by_pair():
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abc ") for _ in range(n))
    for n, m in ((9, 9), (9, 14), (14, 9), (64, 64), (64, 70), (1, 5)):
        xs, ys = [word(m) for _ in range(4)] + ["", "abcabc" * 3], [word(n) for _ in range(300)]
        want = [[int(S.grades(*S._partial_parts(x, y))) if x else 0 for y in ys] for x in xs]
        assert S.partial_table(xs, ys).tolist() == want
    xs = ["abcabc", "abc", "b\0cabca", "cabcab", ""] + [word(6) for _ in range(20)]
    ys = xs + [word(rng.randrange(30)) for _ in range(200)] + ["abcabcabc", "xb\0cabca"]
    assert S._within(xs, ys).tolist() == [[len(x) >= 6 and x in y for y in ys] for x in xs]
    assert S._same(xs, ys).tolist() == [[x != "" and x == y for y in ys] for x in xs]


def test_vocabulary_takes_texts_in_lots():
    lots = list(B._lots(pa.array(["a" * (B.LETTERS // 2), None, "b" * (B.LETTERS // 2), "c"])))
    assert [len(x) for x in lots] == [3, 1] and lots[0][1] == ""


def test_short_rows_of_one_row_group_go_to_all_cores(spark, tmp_path):
    """A file of one row group is read by one task, however many splits it has."""
    for name, cols in (("part", "id AS p_partkey, 'blue widget' AS p_name"), ("customer", "id AS c_custkey, 'n' AS c_name, 'BUILDING' AS c_mktsegment, 0L AS c_nationkey")):
        spark.range(2000).coalesce(1).selectExpr(*cols.split(", ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    spark.range(1).selectExpr("0L AS n_nationkey", "'X' AS n_name").write.parquet(str(tmp_path / "nation.parquet"))
    for query in ("hashed_vectors", "preprocess_records"):
        parts = entry.queries()[query](spark, str(tmp_path)).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(parts) >= spark.sparkContext.defaultParallelism and max(r["count"] for r in parts) < 1000


def test_hashed_vector_is_the_sum_of_signs(spark):
    texts = ["blue widget", "aaaaaa", "ab", ""]
    df = spark.createDataFrame([(t,) for t in texts], "s string").select(B.grams(F.col("s")).alias("g"), B.hashed_vector(F.col("s")).alias("v"))
    for r in df.select("v", F.transform("g", lambda g: F.xxhash64(g)).alias("h")).collect():
        counts = [sum(1.0 if (h >> 8) % 2 == 0 else -1.0 for h in r.h if h % 64 == i) for i in range(64)]
        size = sum(x * x for x in counts) ** 0.5
        assert r.v == pytest.approx([x / size if size else 0.0 for x in counts])


def test_texts_of_the_catalog_are_worked_out_once(spark):
    """For the vocabulary, its count of texts, and every block of queries."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    catalog = spark.createDataFrame([(i, f"alpha {i * 7 % 50} beta {i % 13}") for i in range(300)], "entity_id long, text string").mapInArrow(counted, "entity_id long, text string")
    queries = spark.createDataFrame([(i, f"alpha {i * 3 % 50}") for i in range(40)], "entity_id long, text string")
    found = B.tfidf_candidates(queries, catalog, 4, block=16)
    assert found.count() == 160 and found.where("rank = 1").count() == 40 and seen.value == 300


def test_an_empty_catalog_has_no_candidates(spark):
    none = spark.createDataFrame([], "entity_id long, text string")
    assert B.tfidf_candidates(spark.createDataFrame([(1, "alpha")], none.schema), none, 4).count() == 0


def test_the_truth_is_worked_out_once_and_only_where_it_is_asked_for(spark, monkeypatch):
    seen, plain = spark.sparkContext.accumulator(0), L.P.containing

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    monkeypatch.setattr(L.P, "containing", lambda *a, **b: (lambda df: df.select("s1_id", "cand_id").mapInArrow(counted, df.select("s1_id", "cand_id").schema))(plain(*a, **b)))
    n = L._truth(spark, SF).count()
    for name, times in (("threshold_scan", 1), ("threshold_scan_guarded", 1), ("best_threshold", 1), ("neg_sampling", 1), ("pair_counts", 1), ("blocking_recall", 1), ("macro_f05", 1), ("topk_val30", 0), ("match_output", 0), ("decision_counts", 0)):
        before = seen.value
        L.QUERIES[name](spark, SF).collect()
        assert n and seen.value - before == times * n, name


def test_runs_of_no_item_become_no_rows(spark, monkeypatch):
    """Texts hold items as before, whether the items' keys are few or not, and rows are made for runs of items only."""
    words = [f"w{i * i % 23}" for i in range(400)]
    docs = spark.createDataFrame([(i, " ".join(words[i : i + 60])) for i in range(300)] + [(900, None), (901, ""), (902, "w0 w1"), (903, "xw0\nw1  w4 w9 w16y")], "cand_id long, text string")
    items = spark.createDataFrame([(0, "w0 w1 w4 w9 w16 w2"), (1, "w0\nw1  w4 w9 w16"), (2, "w1 w4"), (3, "nowhere to be found at all"), (4, "w8 w3 w0 w22 w21 w0 w4")], "s1_id long, item string")
    plain = sorted((d.cand_id, i.s1_id) for d in docs.collect() for i in items.collect() if i.item in (d.text or ""))
    pairs = lambda: P.containing(docs, items, "text", "item").select("cand_id", "s1_id")
    found = pairs()
    assert sorted(map(tuple, found.collect())) == plain and {i for _, i in plain} == {0, 1, 2}
    assert "INSET" in found._jdf.queryExecution().optimizedPlan().toString() or " IN (" in found._jdf.queryExecution().optimizedPlan().toString()
    monkeypatch.setattr(P, "FEW_KEYS", 1)
    assert sorted(map(tuple, pairs().collect())) == plain

"""Registered queries over files and models: what is written is read again, and a linkage runs from records to matches.

They register in the tables of `linkage_queries`. What they write lies in the folder that the session shares, under a
name of its own for each run.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mosaiq.functions import text as T
from mosaiq.operators import blocking as B
from mosaiq.operators import decide as D
from mosaiq.operators import model as M
from mosaiq.operators import pairs as P
from mosaiq.operators import validate as V
from mosaiq.plans import linkage_queries as L
from mosaiq.plans.linkage_queries import query, table
from mosaiq.sources import tables as R
from mosaiq.streaming.incremental import match_arrivals


def _folder(spark: SparkSession) -> str:
    return f"{R.shared_folder(spark)}/mosaiq-files-{uuid.uuid4().hex}"


def _s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L._records(L._customers(spark, sf_dir), "S1-", "c_custkey")


def _s3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L._records(L._suppliers(spark, sf_dir), "S3-", "s_suppkey")


_RECORDS = f"SELECT 'S1-' || c_custkey AS entity_id, name AS business_name, address AS business_address, n_name AS country FROM ({L._CUSTOMERS})"
#: Orders of each customer as a list of matches: every seventh customer has none.
_MATCHES = "SELECT 'S1-' || c_custkey AS source1_entity_id, CASE WHEN c_custkey % 7 = 0 THEN '' ELSE coalesce(ids, '') END AS matched_entity_ids, c_custkey, c_mktsegment AS country FROM customer LEFT JOIN (SELECT o_custkey, string_agg('S2-' || o_orderkey, ',' ORDER BY o_orderkey) AS ids FROM orders GROUP BY o_custkey) ON c_custkey = o_custkey"


def _matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("o_orderkey")), lambda x: F.concat(F.lit("S2-"), x.cast("string"))), ",")
    orders = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(ids.alias("ids"))
    own = F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(F.coalesce("ids", F.lit("")))
    return table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(F.concat(F.lit("S1-"), F.col("c_custkey").cast("string")).alias("source1_entity_id"), own.alias("matched_entity_ids"), F.col("c_mktsegment").alias("country"))


@query("record_file", f"SELECT *, row_number() OVER (ORDER BY entity_id) AS pos FROM ({_RECORDS})")
def record_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records written in order and read with their positions."""
    path = _folder(spark)
    R.write_tsv(_s1(spark, sf_dir), path, ["entity_id"])
    return R.with_position(R.read_tsv(spark, path, R.RECORD))


@query("match_file", f"SELECT source1_entity_id AS s1_id, string_split(matched_entity_ids, ',')[1] AS cand_id, 1 AS rank FROM ({_MATCHES}) WHERE matched_entity_ids <> ''")
def match_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first id of each list of a match file; rows without a list stay in the file and give no pair."""
    path = _folder(spark)
    R.write_tsv(_matches(spark, sf_dir).select(*R.MATCHES.names), path, ["source1_entity_id"])
    return P.truncate_candidates(P.explode_candidates(R.read_id_lists(spark, path, R.MATCHES)), 1)


@query("truth_file", f"SELECT source1_entity_id AS s1_id, unnest(string_split(matched_entity_ids, ',')) AS cand_id FROM ({_MATCHES}) WHERE matched_entity_ids <> ''")
def truth_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _folder(spark)
    R.write_tsv(_matches(spark, sf_dir).select(*R.MATCHES.names), path)
    return P.explode_truth(R.read_tsv(spark, path, R.MATCHES, quoted=False))


@query("split_files", f"SELECT *, (n_val = CAST(round(0.2 * (n_val + n_train)) AS BIGINT)) AS exact FROM (SELECT stratum, CAST(round(0.2 * count(*)) AS BIGINT) AS n_val, count(*) - CAST(round(0.2 * count(*)) AS BIGINT) AS n_train FROM (SELECT country || CASE WHEN matched_entity_ids <> '' THEN '_True' ELSE '_False' END AS stratum FROM ({_MATCHES})) GROUP BY stratum)")
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both files of a stratified split, read again: their rows by stratum. Together they are the truth, each row once."""
    path, truth = _folder(spark), _matches(spark, sf_dir)
    s1 = truth.select(F.col("source1_entity_id").alias("entity_id"), "country")
    R.write_splits(M.stratified_split(M.stratify(truth.drop("country"), s1)), f"{path}/train", f"{path}/val")
    parts = [R.read_tsv(spark, f"{path}/{part}", R.MATCHES, quoted=False).withColumn("val", F.lit(part == "val")) for part in ("train", "val")]
    rows = M.stratify(parts[0].unionByName(parts[1]), s1)
    counts = rows.groupBy("stratum").agg(F.count_if("val").alias("n_val"), F.count_if(~F.col("val")).alias("n_train"))
    return counts.withColumn("exact", F.col("n_val") == F.round(0.2 * (F.col("n_val") + F.col("n_train"))))


@query("feature_file", L.ORACLES["pair_features"].replace("SELECT s1_id, cand_id, ", "SELECT s1_id AS source1_entity_id, cand_id AS candidate_entity_id, CAST(0 AS TINYINT) AS label, "))
def feature_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table, written as CSV and read with its types. It has a row for each pair, so it is packed."""
    path = _folder(spark)
    made = L.pair_features(spark, sf_dir).withColumnsRenamed({"s1_id": "source1_entity_id", "cand_id": "candidate_entity_id"})
    R.write_pairs(made.withColumn("label", F.lit(0).cast("byte")), path, "csv", rounded=True, packed="gzip")
    return R.read_pairs(spark, path, "csv")


@query("id_set", "SELECT 'S1-' || c_custkey AS entity_id FROM customer")
def id_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id of a file in which every record stands twice."""
    path, s1 = _folder(spark), _s1(spark, sf_dir)
    R.write_tsv(s1.unionByName(s1), path)
    return R.read_ids(spark, path)


@query("first_rows", f"SELECT entity_id FROM ({_RECORDS}) ORDER BY entity_id LIMIT 20")
def first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row limit of a scan: of a file in order, the first twenty, in however many parts and splits it lies."""
    path = _folder(spark)
    R.write_tsv(_s1(spark, sf_dir), path, ["entity_id"])
    return R.read_tsv(spark, path, R.RECORD, most=20).select("entity_id")


@query("vector_cache", "SELECT vec_id, len(embedding) AS n, round(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x)), 6) AS size FROM embeddings")
def vector_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors that were computed once: the second call reads what the first has written."""
    path = _folder(spark)
    R.cached(spark, path, lambda: table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    again = R.cached(spark, path, lambda: table(spark, sf_dir, "embeddings").limit(0))
    return R.read_vectors(spark, path).join(again.select("vec_id"), "vec_id").select("vec_id", F.size("embedding").alias("n"), F.round(B.dot(F.col("embedding"), F.col("embedding")), 6).alias("size"))


@query("catalog_build", "SELECT 'S2' AS source, count(*) AS n, true AS complete FROM customer UNION ALL SELECT 'S3', count(*), true FROM supplier")
def catalog_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog as a table, its counts by source, and whether the probe finds it complete; before, and with other counts, it does not."""
    path = _folder(spark)
    s2, s3 = L._records(L._customers(spark, sf_dir), "S2-", "c_custkey"), _s3(spark, sf_dir)
    expected = {"S2": s2.count(), "S3": s3.count()}
    before = R.is_complete(spark, path, expected)
    counts = R.save_catalog(s2, s3, path).groupBy("source").agg(F.count("*").alias("n"))
    complete = not before and R.is_complete(spark, path, expected) and not R.is_complete(spark, path, expected | {"S3": expected["S3"] + 1})
    return counts.select(F.col("source").cast("string").alias("source"), "n", F.lit(complete).alias("complete"))


@query("config_file", "SELECT 'ensemble' AS model_mode, 0.64::DOUBLE AS optimal_threshold, 0.75::DOUBLE AS singleton_cutoff, max(c_acctbal)::DOUBLE AS note FROM customer UNION ALL SELECT 'lgbm', 0.8, 0.76, NULL")
def config_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A config that was written, with a key of its own, and what stands for none."""
    path = _folder(spark)
    note = table(spark, sf_dir, "customer").agg(F.max("c_acctbal")).first()[0]
    text = R.write_config({"model_mode": "ensemble", "optimal_threshold": 0.64, "singleton_cutoff": D.singleton_cutoff(0.64), "note": note})
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(path)
    keys = ("model_mode", "optimal_threshold", "singleton_cutoff", "note")
    return spark.createDataFrame([tuple(c.get(k) for k in keys) for c in (R.read_config_file(spark, path), R.read_config(None))], "model_mode string, optimal_threshold double, singleton_cutoff double, note double")


_LINES = """lines AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) + 1 AS n,
  CASE o_orderkey % 29 WHEN 3 THEN 'S1-' || o_orderkey || ' S2-1' WHEN 5 THEN '' ELSE 'S1-' || o_orderkey || chr(9) || 'S2-' || (o_orderkey + 1) END AS value FROM orders)"""


@query("file_faults", f"WITH {_LINES}, good AS (SELECT * FROM lines WHERE contains(value, chr(9))), need AS (SELECT o_orderkey FROM orders) SELECT 'error' AS severity, 'no_tab' AS rule, count(*) AS n, array_to_string(list_sort(list(n::VARCHAR))[1:{V.EXAMPLES}], ',') AS examples FROM lines WHERE value <> '' AND NOT contains(value, chr(9)) UNION ALL SELECT 'error', 'missing_s1', count(*), array_to_string(list_sort(list('S1-' || o_orderkey))[1:{V.EXAMPLES}], ',') FROM need WHERE o_orderkey NOT IN (SELECT o_orderkey FROM good) UNION ALL SELECT 'warning', 'id_check_off', 1, '' UNION ALL SELECT 'warning', 'no_candidates', 1, 'no such file' UNION ALL SELECT 'warning', 'no_source', 1, 'no such source'")
def file_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings about a file: lines without a tab by their numbers, blank lines, what is missing."""
    path, orders = _folder(spark), table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    value = F.when(F.col("o_orderkey") % 29 == 3, F.concat(F.lit("S1-"), key, F.lit(" S2-1"))).when(F.col("o_orderkey") % 29 == 5, F.lit("")).otherwise(F.concat(F.lit("S1-"), key, F.lit("\tS2-"), (F.col("o_orderkey") + 1).cast("string")))
    header = spark.createDataFrame([(-1, "source1_entity_id\tmatched_entity_ids")], "o_orderkey long, value string")
    header.unionByName(orders.select("o_orderkey", value.alias("value"))).repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").select("value").write.text(path)
    need = orders.select(F.concat(F.lit("S1-"), key).alias("s1_id"))
    found = V.validate_files(spark, path, "no such file", need, None, ("no such source", path))
    return V.numbered(found).select("severity", "rule", "n", "examples")


@query("header_faults", "SELECT 'error' AS severity, 'comma_header' AS rule, 1::BIGINT AS n, 'source1_entity_id,matched_entity_ids' AS examples, 1 AS code UNION ALL SELECT 'error', 'bad_header', 1, 's1' || chr(9) || 'ids', 1 UNION ALL SELECT 'error', 'empty_file', 1, '', 1 UNION ALL SELECT 'error', 'no_file', 1, '', 1 UNION ALL SELECT 'error', 'not_utf8', count(*), '2', 1 FROM region WHERE r_regionkey = 0")
def header_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults that end the checks of a file, one file each, and bytes that are no UTF-8. Exit codes stand beside them."""
    need = table(spark, sf_dir, "region").limit(0).select(F.col("r_name").alias("s1_id"))
    ids = need.select(F.col("s1_id").alias("entity_id"))
    text = lambda lines: spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    base, out = _folder(spark), None
    text(["source1_entity_id,matched_entity_ids", "S1-1,S2-1"]).write.text(f"{base}/comma")
    text(["s1\tids", "S1-1\tS2-1"]).write.text(f"{base}/names")
    text([]).write.text(f"{base}/empty")
    spark.createDataFrame([(bytearray(b"source1_entity_id\tmatched_entity_ids\n\xff\xfe\t"),)], "value binary").coalesce(1).select(F.col("value").cast("string")).write.text(f"{base}/bytes")
    for name in ("comma", "names", "empty", "none", "bytes"):
        found = V.validate_files(spark, f"{base}/{name}", None, need, ids).where("rule <> 'unexpected_s1'")
        shown = F.when(F.col("rule").isin("no_file", "empty_file"), F.lit("")).otherwise(F.col("examples"))
        one = found.select("severity", "rule", "n", shown.alias("examples"), F.lit(V.exit_code(found)).alias("code"))
        out = one if out is None else out.unionByName(one)
    return out


@query("arrivals", f"SELECT entity_id, trim(business_name) AS name FROM ({_RECORDS})")
def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that arrive in two lots, handled batch by batch; the second start has nothing left to do."""
    path, s1 = _folder(spark), _s1(spark, sf_dir)
    match = lambda batch: batch.select("entity_id", F.trim("business_name").alias("name"))
    run = lambda: match_arrivals(spark, f"{path}/in/*", f"{path}/out", f"{path}/state", match).awaitTermination()
    for lot in (0, 1):
        R.write_tsv(s1.where(F.pmod(F.crc32("entity_id"), F.lit(2)) == lot), f"{path}/in/{lot}")
        run()
    run()
    return spark.read.parquet(f"{path}/out").select("entity_id", "name")


_INDIC = (("प्राइवेट लिमिटेड", "private limited"), ("लिमिटेड", "limited"), ("मार्केटिंग", "marketing"), ("इंटरनेशनल", "international"))


@query("indic_names", "SELECT n_nationkey, lower(n_name) || ' ' || CASE n_nationkey % 4 " + " ".join(f"WHEN {i} THEN '{plain}'" for i, (_, plain) in enumerate(_INDIC)) + " END AS norm FROM nation")
def indic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Legal and trade words in Devanagari, as their English forms."""
    word = F.element_at(F.array(*[F.lit(w) for w, _ in _INDIC]), F.col("n_nationkey") % 4 + 1)
    return table(spark, sf_dir, "nation").select("n_nationkey", T.normalize_text(F.concat("n_name", F.lit(" "), word)).alias("norm"))


@query("hashed_vectors", "SELECT p_partkey, 1.0::DOUBLE AS size, 64 AS n, true AS same FROM part")
def hashed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors that stand for an encoder's: unit length, and the same for the same text."""
    part = B.dealt(table(spark, sf_dir, "part").select("p_partkey", "p_name"))
    made = part.select("p_partkey", B.hashed_vector(F.col("p_name")).alias("a"), B.hashed_vector(F.concat("p_name", F.lit(""))).alias("b"))
    return made.select("p_partkey", F.round(B.dot(F.col("a"), F.col("a")), 6).alias("size"), F.size("a").alias("n"), (F.col("a") == F.col("b")).alias("same"))


# ---- From records to matches -----------------------------------------------------------------------------------------
def _noisy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S2: three of four customers, with a legal form and other spellings; the fourth has no match."""
    rows = L._customers(spark, sf_dir).where("c_custkey % 4 <> 0")
    name = F.concat(F.upper("name"), F.when(F.col("c_custkey") % 2 == 0, F.lit(" Pvt. Ltd.")).otherwise(F.lit(" S.A.")))
    return L._records(rows.withColumns({"name": name, "address": F.replace("address", F.lit(" ave.,"), F.lit(" avenue,"))}), "S2-", "c_custkey")


@query("linkage_run", "SELECT 'S1-' || c_custkey AS source1_entity_id, CASE WHEN c_custkey % 4 <> 0 THEN 'S2-' || c_custkey ELSE '' END AS matched_entity_ids FROM customer")
def linkage_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records to matches: candidates by TF-IDF, features, two boosters stopped and calibrated on a stratified split, guard, lists."""
    path = _folder(spark)
    s1, catalog = _s1(spark, sf_dir), R.catalog(_noisy(spark, sf_dir), _s3(spark, sf_dir)).drop("source")
    texts = lambda df: df.select("entity_id", F.concat_ws(" ", T.normalize_text(F.col("business_name")), T.decompose_address(F.col("business_address"))["clean_addr"]).alias("text"))
    found = R.cached(spark, f"{path}/candidates", lambda: B.tfidf_candidates(texts(s1), texts(catalog), 8))
    pairs = found.select(F.col("query_id").alias("s1_id"), F.col("candidate_id").alias("cand_id"), "rank")
    key = F.split_part("entity_id", F.lit("-"), F.lit(2)).cast("long")
    truth = s1.select(F.col("entity_id").alias("source1_entity_id"), F.when(key % 4 != 0, F.concat(F.lit("S2-"), key.cast("string"))).otherwise(F.lit("")).alias("matched_entity_ids"))
    split = M.stratified_split(M.stratify(truth, s1)).select(F.col("source1_entity_id").alias("s1_id"), "is_val", F.col("has_match").cast("int").alias("n_true"))
    made = lambda: P.featurize(P.attach_records(P.label_pairs(pairs, P.explode_truth(truth)).join(split.select("s1_id", "is_val"), "s1_id"), s1, catalog))
    features = R.cached(spark, f"{path}/features", made)
    boosters, config = M.linkage_model(features, split.where("is_val").select("s1_id", "n_true"), M.Boosters(rounds=12, least_leaf=4))
    boosters.save(f"{path}/model")
    scored = M.Boosters.load(f"{path}/model").score(features, config["model_mode"])
    return D.match_rows(s1, D.decide(scored, config["optimal_threshold"], config["singleton_cutoff"]))


@query("model_choice", "SELECT count(*) AS entities, true AS mode_known, true AS cutoff_follows, true AS guard_told, true AS perfect FROM (SELECT stratum, unnest(range(0, CAST(round(0.2 * count(*)) AS BIGINT))) FROM (SELECT n_name || CASE WHEN c_custkey % 4 <> 0 THEN '_True' ELSE '_False' END AS stratum FROM customer JOIN nation ON c_nationkey = n_nationkey) GROUP BY stratum)")
def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What calibration tells: one of the modes, a cutoff by its rule, the score with the guard, and that no entity is wrong here."""
    s1 = _s1(spark, sf_dir).withColumn("key", F.split_part("entity_id", F.lit("-"), F.lit(2)).cast("long"))
    truth = s1.select(F.col("entity_id").alias("source1_entity_id"), F.when(F.col("key") % 4 != 0, F.lit("x")).otherwise(F.lit("")).alias("matched_entity_ids"))
    split = M.stratified_split(M.stratify(truth, s1)).select(F.col("source1_entity_id").alias("s1_id"), "is_val", F.col("has_match").cast("int").alias("n_true"))
    rows = split.select("s1_id", "is_val", "n_true", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("rank"))
    label = ((F.col("rank") == 1) & (F.col("n_true") == 1)).cast("int")
    noise = F.pmod(F.crc32(F.concat("s1_id", F.col("rank").cast("string"))), F.lit(50)) / 100
    pairs = rows.select("s1_id", F.concat(F.lit("S2-"), F.col("rank").cast("string")).alias("cand_id"), "rank", "is_val", label.alias("label"), (label * 0.6 + noise * 0.5).alias("f0"), noise.alias("f1"))
    config = M.linkage_model(pairs, split.where("is_val").select("s1_id", "n_true"), M.Boosters(rounds=6, depths=(2, 3), features=("f0", "f1")))[1]
    n = split.where("is_val").count()
    facts = (n, config["model_mode"] in ("ensemble", "lgbm", "xgboost"), config["singleton_cutoff"] == D.singleton_cutoff(config["optimal_threshold"]), config["guarded_macro_f05"] <= 1.0, config["validation_macro_f05"] == 1.0)
    return spark.createDataFrame([facts], "entities long, mode_known boolean, cutoff_follows boolean, guard_told boolean, perfect boolean")

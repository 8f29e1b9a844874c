"""From candidate lists to labelled, sampled and described pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mosaiq.functions import text as T
from mosaiq.functions.similarity import FEATURES, FIELDS, block_features, flag_keys, keyed_flags, pair_features

VAL_CANDIDATES = 30
LEAST_NEGATIVES, NEGATIVES_PER_MATCH = 8, 6


def explode_candidates(lists: DataFrame) -> DataFrame:
    """s1_id, cand_id, rank from 1, from an array `ids`: each candidate once, at its first place. Empty lists give no row."""
    rows = lists.select(F.col("source1_entity_id").alias("s1_id"), F.posexplode("ids").alias("pos", "cand_id"))
    return rows.groupBy("s1_id", "cand_id").agg((F.min("pos") + 1).alias("rank"))


def explode_truth(truth: DataFrame) -> DataFrame:
    """s1_id and cand_id of each true link, from the comma lists of the truth file."""
    return truth.select(F.col("source1_entity_id").alias("s1_id"), F.explode(T.id_list(F.col("matched_entity_ids"))).alias("cand_id")).distinct()


#: Keys of items that every task can hold, to let go the runs of a text that are of no item before they are rows.
FEW_KEYS = 4096


def containing(docs: DataFrame, items: DataFrame, text_col: str, item_col: str, run: int = 3) -> DataFrame:
    """The rows of docs with those of items whose text they contain, as it stands.

    The words of an item but for its first and last are whole words of any text that holds it, so the first `run` of them
    are what both sides are joined by. Where there are few items, other runs of a text become no rows. Items with fewer
    words are few and short; they are compared with every text.
    """
    words = lambda c: F.split(F.col(c), r"\s+")
    runs = lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - run), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(run)]))
    long = F.size(words(item_col)) >= run + 2
    keyed = items.where(long).withColumn("__key", F.xxhash64(*[F.get(words(item_col), 1 + j) for j in range(run)]))
    keys = [r[0] for r in keyed.select("__key").distinct().limit(FEW_KEYS + 1).collect()]
    asked = (lambda hashes: F.filter(hashes, lambda h: h.isin(keys))) if len(keys) <= FEW_KEYS else lambda hashes: hashes
    every = T.let(words(text_col), lambda w: F.when(F.size(w) >= run, F.array_distinct(asked(runs(w)))))
    met = docs.withColumn("__key", F.explode(every)).join(keyed, "__key").drop("__key")
    found = met.where(F.col(text_col).contains(F.col(item_col)))
    short = items.where(~long)
    return found.unionByName(docs.join(short, F.col(text_col).contains(F.col(item_col)))) if short.limit(1).count() else found


def label_pairs(pairs: DataFrame, links: DataFrame) -> DataFrame:
    """With label 1 for the pairs that are true links, else 0."""
    marked = links.select("s1_id", "cand_id").distinct().withColumn("label", F.lit(1))
    return pairs.join(marked, ["s1_id", "cand_id"], "left").withColumn("label", F.coalesce("label", F.lit(0)).cast("byte"))


def flag_validation(pairs: DataFrame, val_ids: DataFrame) -> DataFrame:
    """With is_val for the pairs whose s1_id is a validation entity."""
    marked = val_ids.select("s1_id").distinct().withColumn("is_val", F.lit(True))
    return pairs.join(marked, "s1_id", "left").withColumn("is_val", F.coalesce("is_val", F.lit(False)))


def truncate_candidates(pairs: DataFrame, n: int = VAL_CANDIDATES) -> DataFrame:
    return pairs.where(F.col("rank") <= n)


def sample_negatives(pairs: DataFrame, links: DataFrame, least: int = LEAST_NEGATIVES, per_match: int = NEGATIVES_PER_MATCH) -> DataFrame:
    """All labelled matches, and of each entity's other candidates the first max(least, per_match * true links) in rank order."""
    n_true = links.groupBy("s1_id").agg(F.countDistinct("cand_id").alias("n_true"))
    place = F.row_number().over(Window.partitionBy("s1_id", "label").orderBy("rank", "cand_id"))
    most = F.greatest(F.lit(least), F.coalesce("n_true", F.lit(0)) * per_match)
    return pairs.withColumn("place", place).join(n_true, "s1_id", "left").where((F.col("label") == 1) | (F.col("place") <= most)).drop("place", "n_true")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """Matches and others among the labelled pairs, of validation entities and of the rest."""
    return pairs.groupBy("is_val").agg(F.count_if(F.col("label") == 1).alias("n_pos"), F.count_if(F.col("label") == 0).alias("n_neg"))


def normalized(records: DataFrame) -> DataFrame:
    """entity_id and rec: the comparable fields, worked out once for each record and not for each pair."""
    name = records.withColumn("norm_name", T.normalize_text(F.col("business_name"))).withColumn("addr", T.decompose_address(F.col("business_address")))
    # A missing address joins the digits as nothing.
    digits = T.digits(F.concat(F.col("norm_name"), F.lit(" "), F.coalesce("business_address", F.lit(""))))
    return name.select(
        "entity_id",
        F.struct(
            F.col("norm_name").alias("name"), T.compact_signature(F.col("norm_name")).alias("compact"), T.acronym(F.col("norm_name")).alias("acronym"), F.col("addr.clean_addr").alias("clean_addr"),
            F.col("addr.street_num").alias("street_num"), F.col("addr.street_name").alias("street_name"), F.col("addr.city_state").alias("city_state"), digits.alias("digits"), F.coalesce("country", F.lit("")).alias("country"),
        ).alias("rec"),
    )


def attach_records(pairs: DataFrame, s1: DataFrame, catalog: DataFrame) -> DataFrame:
    """With the normalised structs s1 and cand; an id that is not found has empty fields."""
    empty = F.struct(*[F.lit("").alias(n) for n in ("name", "compact", "acronym", "clean_addr", "street_num", "street_name", "city_state", "digits", "country")])
    a = normalized(s1).select(F.col("entity_id").alias("s1_id"), F.col("rec").alias("s1"))
    b = normalized(catalog).select(F.col("entity_id").alias("cand_id"), F.col("rec").alias("cand"))
    out = pairs.join(a, "s1_id", "left").join(b, "cand_id", "left")
    return out.withColumns({"s1": F.coalesce("s1", empty), "cand": F.coalesce("cand", empty)})


def featurize(attached: DataFrame) -> DataFrame:
    """The feature table of attached pairs, rounded as it is stored; label and other columns stay."""
    made = pair_features("s1", "cand", F.col("cand_id"))
    rest = [c for c in attached.columns if c not in ("s1", "cand")]
    return attached.withColumns(made).select(*rest, *[F.round(c, 4).alias(c) for c in FEATURES])


#: Parts that the records of one country are dealt into, and records of a pack on either side.
COUNTRY_PARTS, PACKS = 32, (64, 4096)


def _with_country(records: DataFrame) -> DataFrame:
    return normalized(records.where("country IS NOT NULL")).withColumn("country", F.col("rec.country"))


def _met(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """a and b joined by country. Each row of a goes to one part of its country, those of b, the smaller side, to every part:
    records move, pairs are made where they are used."""
    n = max(8 * a.sparkSession.sparkContext.defaultParallelism, 2 * COUNTRY_PARTS)
    left = a.withColumn("__part", F.pmod(F.xxhash64(key), F.lit(COUNTRY_PARTS)).cast("int")).repartition(n, "country", "__part")
    right = b.withColumn("__part", F.explode(F.sequence(F.lit(0), F.lit(COUNTRY_PARTS - 1)))).repartition(n, "country", "__part")
    return left.join(right.hint("shuffle_hash"), ["country", "__part"])


def attach_by_country(s1: DataFrame, catalog: DataFrame) -> DataFrame:
    """As attach_records of all pairs of one country."""
    a, b = ((lambda x, i, r: _with_country(x).select("country", F.col("entity_id").alias(i), F.col("rec").alias(r)))(*x) for x in ((s1, "s1_id", "s1"), (catalog, "cand_id", "cand")))
    return _met(a, b, "s1_id").select("s1_id", "cand_id", "s1", "cand")


def flags_by_country(s1: DataFrame, catalog: DataFrame) -> DataFrame:
    """The features without string ratios of all pairs of one country. What a side alone decides is told by its records."""

    def keyed(records: DataFrame, own: str, name: str) -> DataFrame:
        rows = _with_country(records).select("country", F.col("entity_id").alias(name), F.col("entity_id").startswith("S2-").alias("s2"), *flag_keys("rec"))
        return rows.withColumnsRenamed({c: f"{own}{c}" for c in rows.columns if c not in ("country", name)})

    made = keyed_flags("a_", "b_", F.col("b_s2"))
    return _met(keyed(s1, "a_", "s1_id"), keyed(catalog, "b_", "cand_id"), "s1_id").select("s1_id", "cand_id", *[c.alias(n) for n, c in made.items()])


def featurize_by_country(s1: DataFrame, catalog: DataFrame) -> DataFrame:
    """As featurize of all pairs of one country: packs of records meet, and a pack's pairs are described at once."""
    out = f"s1_id string, cand_id string, {', '.join(f'{f} double' for f in FEATURES)}"

    def packs(records: DataFrame, size: int, name: str) -> DataFrame:
        rows = _with_country(records)
        n = rows.groupBy("country").agg(F.ceil(F.count("*") / size).alias("__n"))
        dealt = rows.join(n, "country").withColumn("__pack", F.pmod(F.xxhash64("entity_id"), F.col("__n")))
        return dealt.groupBy("country", "__pack").agg(F.collect_list(F.struct("entity_id", *[F.col(f"rec.{f}").alias(f) for f in FIELDS])).alias(name))  # about `size` rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sides(column: pa.ListArray, i: int) -> dict[str, list[str]]:
            rows = column[i].values
            return {f: rows.field(f).to_pylist() for f in ("entity_id", *FIELDS)}

        for batch in batches:
            for i in range(batch.num_rows):
                a, b = sides(batch.column(0), i), sides(batch.column(1), i)
                made = block_features(a, b, b["entity_id"])
                rows = np.arange(len(a["entity_id"]) * len(b["entity_id"]))
                ids = [pa.array(a["entity_id"]).take(pa.array(rows // len(b["entity_id"]))), pa.array(b["entity_id"]).take(pa.array(rows % len(b["entity_id"])))]
                yield pa.RecordBatch.from_arrays([*ids, *[pa.array(made[f]) for f in FEATURES]], names=["s1_id", "cand_id", *FEATURES])

    a, b = packs(s1, PACKS[0], "a"), packs(catalog, PACKS[1], "b").drop("__pack")
    return _met(a, b, "__pack").select("a", "b").mapInArrow(run, out)

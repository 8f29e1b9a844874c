"""Reading and writing of the linkage files. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mosaiq.functions.similarity import FEATURES
from mosaiq.functions.text import id_list, missing

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
MATCHES = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
CANDIDATES = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "candidate_entity_ids")])
PAIRS = T.StructType([T.StructField(n, T.DoubleType()) for n in FEATURES] + [T.StructField("source1_entity_id", T.StringType()), T.StructField("candidate_entity_id", T.StringType()), T.StructField("label", T.ByteType())])
#: What a missing config, or a missing key of one, stands for.
NO_CONFIG = {"model_mode": "lgbm", "optimal_threshold": 0.80, "singleton_cutoff": 0.76}


def read_tsv(spark: SparkSession, path: str, schema: T.StructType, quoted: bool = True, most: int | None = None) -> DataFrame:
    """A TSV with a header. Id lists are read without quoting: a quote in them is a letter. Empty values are null. `most` limits the rows to the
    first of them by path and place: a plain limit takes those of whichever split is read first."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"' if quoted else "").option("enforceSchema", True).csv(path)
    return df if most is None else with_position(df, "__pos").where(F.col("__pos") <= most).drop("__pos")


def with_position(scan: DataFrame, name: str = "pos") -> DataFrame:
    """A scan of files with each row's position, from 1, by path and place in the file. It must be a scan as it was read.

    Rows are numbered within their split; where a split begins follows from the counts of those before, a row for each.
    """
    marked = scan.withColumns({"__file": F.input_file_name(), "__block": F.input_file_block_start(), "__at": F.monotonically_increasing_id()})
    splits = marked.groupBy("__file", "__block").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = Window.orderBy("__file", "__block").rowsBetween(Window.unboundedPreceding, -1)
    begin = splits.select("__file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__begin"))
    return marked.join(begin, ["__file", "__block"]).select(*scan.columns, (F.col("__begin") + F.col("__at") - F.col("__first") + 1).alias(name))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in any store that Spark writes to."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)


def is_complete(spark: SparkSession, path: str, expected: Mapping[str, int]) -> bool:
    """Whether a catalog is there and has as many rows of each source as are expected."""
    if not exists(spark, f"{path}/_SUCCESS"):
        return False
    found = {r["source"]: r["n"] for r in spark.read.parquet(path).groupBy("source").agg(F.count("*").alias("n")).collect()}  # a few sources
    return found == {k: n for k, n in expected.items() if n}


def save_catalog(s2: DataFrame, s3: DataFrame, path: str) -> DataFrame:
    """Both noisy sources as one Parquet table, a folder for each source, in order of ids so that lookups skip row groups."""
    catalog(s2, s3).repartitionByRange("source", "entity_id").sortWithinPartitions("source", "entity_id").write.mode("overwrite").partitionBy("source").parquet(path)
    return s2.sparkSession.read.parquet(path)


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame]) -> DataFrame:
    """What make gives, written once and read from then on: vectors, candidates, scores. A write that broke off is made again."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """Where the session lets tasks on all machines write: its checkpoint folder, else its warehouse."""
    return (spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")).rstrip("/")


def kept(df: DataFrame, path: str | None = None) -> DataFrame:
    """df, worked out now and read from the shared folder from then on: what a plan names twice is worked out once."""
    path = path or f"{shared_folder(df.sparkSession)}/mosaiq-kept-{uuid.uuid4().hex}"
    # Small row groups, so that a file of long texts is read by more than one task.
    df.write.option("compression", "zstd").option("parquet.block.size", 16 << 20).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def passing(df: DataFrame) -> Iterator[DataFrame]:
    """As kept, but deleted at the end: nothing that is still to run may read it then."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/mosaiq-passing-{uuid.uuid4().hex}"
    try:
        yield kept(df, path)
    finally:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Source records; what counts as missing is null."""
    df = read_tsv(spark, path, RECORD)
    return df.select(*[missing(F.col(c)).alias(c) for c in df.columns])


def read_id_lists(spark: SparkSession, path: str, schema: T.StructType = CANDIDATES) -> DataFrame:
    """source1_entity_id and ids, an array in the order of the file. Rows without ids stay, with an empty array."""
    df = read_tsv(spark, path, schema, quoted=False)
    return df.select("source1_entity_id", id_list(F.col(schema.names[1])).alias("ids"))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The distinct ids of the first column."""
    return read_tsv(spark, path, RECORD).select("entity_id").where("trim(entity_id) <> ''").distinct()


def read_pairs(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """The feature table, as Parquet or as CSV."""
    reader = spark.read.schema(PAIRS)
    return reader.option("header", True).csv(path) if form == "csv" else reader.parquet(path)


def read_vectors(spark: SparkSession, path: str, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Vectors with their ids, as they are stored: one Parquet table instead of numbered chunks and offsets."""
    return spark.read.parquet(path).select(id_col, F.col(vec_col).cast("array<float>").alias(vec_col))


def match_targets(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """The ids that may be matched: those of both noisy sources, each once."""
    return s2.select("entity_id").union(s3.select("entity_id")).distinct()


def catalog(s2: DataFrame, s3: DataFrame) -> DataFrame:
    """All rows of both noisy sources, with the source told by the id."""
    return s2.unionByName(s3).withColumn("source", F.split_part("entity_id", F.lit("-"), F.lit(1)))


def write_tsv(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """With a header, empty values written as nothing. An order sorts the whole output by ranges, not in one task."""
    out = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    out.write.mode("overwrite").option("sep", "\t").option("header", True).option("emptyValue", "").option("nullValue", "").option("quote", "").csv(path)


def write_pairs(df: DataFrame, path: str, form: str = "parquet", rounded: bool = False, packed: str | None = None) -> None:
    """The feature table, ratios rounded to four digits, unless they are; `packed` names how its files are compressed."""
    out = df.select(*[F.round(c, 4).alias(c) if c in FEATURES and not rounded else F.col(c) for c in PAIRS.names])
    writer = out.write.mode("overwrite").option("header", True)
    (writer.option("compression", packed) if packed else writer).format(form).save(path)


def write_splits(split: DataFrame, train_path: str, val_path: str) -> None:
    """Both parts of a stratified split, in the two columns of the truth file."""
    for path, part in ((train_path, ~F.col("is_val")), (val_path, F.col("is_val"))):
        write_tsv(split.where(part).select(*MATCHES.names), path)


def read_config(text: str | None) -> dict:
    """A threshold config from JSON text. Without one the single model and its thresholds; missing keys have defaults."""
    if text is None:
        return dict(NO_CONFIG)
    found = json.loads(text)
    threshold = float(found.get("optimal_threshold", 0.80))
    return {"model_mode": found.get("model_mode", "ensemble"), "optimal_threshold": threshold, "singleton_cutoff": float(found.get("singleton_cutoff", max(0.75, threshold - 0.05)))} | {k: v for k, v in found.items() if k not in NO_CONFIG}


def write_config(config: Mapping[str, object]) -> str:
    return json.dumps(dict(config), indent=2, sort_keys=True)


def read_config_file(spark: SparkSession, path: str) -> dict:
    """read_config of a file in any store that Spark reads; one row, whole."""
    rows = spark.read.text(path, wholetext=True).limit(1).collect()
    return read_config(rows[0]["value"] if rows else None)

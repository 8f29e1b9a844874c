"""Small helpers that the operators share."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words, as the inside of a character class: blank and U+0009 to U+000D.
SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as the session names it. One of our own is set only on a single machine."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        named = tempfile.mkdtemp(prefix="mosaiq-")
        spark.sparkContext.setCheckpointDir(named)
    return named


#: For each call of settled that is under way, the tables that were cut in it.
_under_way: list[list[DataFrame]] = []


def cut(df: DataFrame) -> DataFrame:
    """df, written to the shared folder as Parquet and read from there: its lineage ends, and a lost executor costs no rerun."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/mosaiq-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    # Spark drops shuffle files when the driver's garbage collector finds their owner gone. Ask for that now, so that a
    # long plan never holds the files of more than one part.
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    table = spark.read.schema(schema).parquet(path)
    table._written_to = path
    if _under_way:
        _under_way[-1].append(table)
    return table


def settled(make: Callable[[], DataFrame]) -> DataFrame:
    """What make gives, cut. The tables that were cut on the way to it are deleted: nothing reads them any more."""
    _under_way.append([])
    try:
        table = make()
        passed = _under_way[-1]
        _under_way[-1] = []
        table = cut(table)
    finally:
        _under_way.pop()
    discard(*passed)
    if _under_way:
        _under_way[-1].append(table)
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes what cut wrote, once nothing that is still to run reads it."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table._written_to)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def text_of(df: DataFrame) -> Column:
    """The text, a null as an empty one."""
    return F.coalesce(df["text"].cast("string"), F.lit(""))


def arrow_map(df: DataFrame, f: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | list], schema: str, max_bytes: int = 8 << 20) -> DataFrame:
    """f over slices of Arrow batches. A slice has at most max_bytes, or a single row, so that a batch of long texts never fills a worker."""

    def run(batches):
        for batch in batches:
            at, n = 0, batch.num_rows
            step = max(1, min(n, int(n * max_bytes / max(1, batch.nbytes))))
            while at < n:
                size = min(step, n - at)
                while size > 1 and batch.slice(at, size).nbytes > 2 * max_bytes:
                    size = size // 2
                yield from f(batch.slice(at, size))
                at += size

    return df.mapInArrow(run, schema)

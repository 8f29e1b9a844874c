"""Records that arrive in a folder, matched batch by batch with what a batch run would say."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from mosaiq.sources.tables import RECORD


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    return spark.readStream.schema(RECORD).option("sep", "\t").option("header", True).csv(folder)


def match_arrivals(spark: SparkSession, folder: str, out: str, checkpoint: str, match: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Runs match over each batch of arrived records and writes it under its batch number: a batch that is run again replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        match(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving(spark, folder).writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

"""Incremental ingest with Structured Streaming."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from parcelmill.sources.delimited import string_schema
from parcelmill.sources.store import upsert


def stream_lines_of(
    spark: SparkSession, folder: str, columns: list[str], sep: str, files_per_batch: int = 100
) -> DataFrame:
    """Arriving delimited files as a stream of text columns; the delimiter is given, not guessed."""
    return (
        spark.readStream.schema(string_schema(columns))
        .option("header", True)
        .option("sep", sep)
        .option("maxFilesPerTrigger", files_per_batch)
        .csv(folder)
    )


def ingest_files(
    source: DataFrame, clean: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> StreamingQuery:
    """Clean each micro-batch and append it to a Parquet folder; every file is taken once."""
    return (
        clean(source)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingest_upserts(
    source: DataFrame,
    to_records: Callable[[DataFrame], DataFrame],
    root: str,
    checkpoint: str,
    run_name: str,
    run_time: str,
    position: str,
) -> StreamingQuery:
    """Upsert each micro-batch into the store. The batch id carries the epoch, so a replayed
    micro-batch is recognised and not applied twice."""

    def apply(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        records = to_records(batch)
        if not records.isEmpty():
            upsert(spark, root, records, f"{run_name}-{epoch}", run_time, position)

    return (
        source.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

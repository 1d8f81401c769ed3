"""Append-only run log; the state of a run is its latest event."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_DDL = (
    "batch_id string, event_no int, status string, event_time timestamp, total_records bigint, "
    "saved_records bigint, error string, source_files array<string>"
)

# Run states and their order.
EVENT_NO = {"started": 0, "completed": 1, "failed": 1}


def log_event(
    spark: SparkSession,
    root: str,
    batch_id: str,
    status: str,
    event_time: str,
    total: int = 0,
    saved: int = 0,
    error: str | None = None,
    source_files: list[str] | None = None,
) -> None:
    """Append one event; `event_time` is a UTC timestamp text."""
    row = [(batch_id, EVENT_NO[status], status, total, saved, error, source_files or [])]
    frame = spark.createDataFrame(
        row,
        "batch_id string, event_no int, status string, total_records bigint, "
        "saved_records bigint, error string, source_files array<string>",
    )
    frame.withColumn("event_time", F.lit(event_time).cast("timestamp")).write.mode("append").parquet(
        f"{root}/runs"
    )


def events(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(EVENT_DDL).parquet(f"{root}/runs")


def current_runs(log: DataFrame) -> DataFrame:
    """Start time and latest status, counts and error of each run."""
    latest = F.max_by(
        F.struct("status", "saved_records", "error", "event_time"),
        F.struct("event_time", "event_no"),
    )
    return log.groupBy("batch_id").agg(
        F.min("event_time").alias("started_at"),
        F.max("total_records").alias("total_records"),
        latest.alias("last"),
    ).select("batch_id", "started_at", "total_records", "last.*")


def latest_run(log: DataFrame) -> DataFrame:
    """The run with the newest event."""
    return current_runs(log).orderBy(F.desc("event_time"), F.desc("batch_id")).limit(1)

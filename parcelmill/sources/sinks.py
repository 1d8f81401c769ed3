"""File sinks: plain writes, nested JSON export, flat CSV export and backup, each with a manifest."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill.operators.nesting import rows_of

FORMATS = ("parquet", "csv", "json")


def write_frame(df: DataFrame, path: str, fmt: str, mode: str = "errorifexists") -> None:
    """Write in one of the known formats; any other name is an error."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported format: {fmt}")
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer.option("header", True).option("escape", '"').csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


def with_iso_times(df: DataFrame) -> DataFrame:
    """Metadata times as ISO text."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"

    def iso(name: str) -> Column:
        return F.date_format(F.col(f"metadata.{name}"), pattern)

    meta = F.col("metadata")
    for name in ("created_at", "updated_at"):
        meta = meta.withField(name, iso(name))
    return df.withColumn("metadata", meta)


def export_manifest(df: DataFrame, label: str, created_at: str) -> DataFrame:
    """One row: what was exported, when, and how many records."""
    return df.agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(label).alias("county"), F.lit(created_at).alias("created_at"), "record_count"
    )


def export_records(df: DataFrame, path: str, label: str, created_at: str, children: dict[str, DataFrame] | None = None) -> None:
    """Records as JSON lines under `records`, pages of their children under `children/<family>`, a manifest under `manifest`.

    Children that stand in a record's own arrays go with it; `children` are those that do not, as pages
    (key, page, items), so that a record of any number of children can be written. The manifest counts what was
    written, so it agrees with the files.
    """
    write_frame(df, f"{path}/records", "json")
    for family, pages in (children or {}).items():
        write_frame(pages, f"{path}/children/{family}", "json")
    written = df.sparkSession.read.text(f"{path}/records")
    write_frame(export_manifest(written, label, created_at), f"{path}/manifest", "json")


def exported_children(spark: SparkSession, path: str, family: str, schema: StructType, key: str) -> DataFrame:
    """The children of an export as rows: key, position, child. `schema` is that of the pages."""
    return rows_of(spark.read.schema(schema).json(f"{path}/children/{family}"), key)


def backup(df: DataFrame, path: str, created_at: str, children: dict[str, DataFrame] | None = None) -> None:
    export_records(with_iso_times(df), path, "all", created_at, children)

"""Sample sources written as files in a given row order and read back with the places of their rows."""

from pyspark.sql import DataFrame

from parcelmill.session import scratch_path
from parcelmill.sources import delimited


def reread(
    rows: DataFrame, label: str, order: list[str], columns: list[str] | None = None, position: str = "source_pos"
) -> DataFrame:
    """`columns` of a tab-delimited copy whose files follow `order`, as text, with each row's place."""
    columns = columns or rows.columns
    path = scratch_path(rows.sparkSession, label)
    rows.orderBy(*order).select(*columns).write.options(header=True, sep="\t", escape='"').csv(path)
    return delimited.read_strings(rows.sparkSession, path, columns, "\t", position, escape='"')


def reread_lines(rows: DataFrame, label: str, order: list[str]) -> DataFrame:
    path = scratch_path(rows.sparkSession, label)
    rows.orderBy(*order).select("value").write.text(path)
    return delimited.read_lines(rows.sparkSession, path)

"""Helpers that the text operators share."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.session import scratch_path

#: A word is a maximal run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of `df`, stored in the shared folder: cuts the lineage and survives lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes of a text, of a null none. `bytes.split` and `bytes.lower` know ASCII only, as wanted."""
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).split()


def crc32_of(doc_id: str = "doc_id"):
    """CRC-32 of an id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))

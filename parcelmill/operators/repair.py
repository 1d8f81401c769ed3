"""Bulk repairs of unified records. Each adds `repaired`, true where the record was changed."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_COUNTY = "harris"


def _fill(df: DataFrame, section: str, target: str, source: str) -> DataFrame:
    """Copy one field of a section to another where that is missing and the source is set."""
    have, spare = F.col(f"{section}.{target}"), F.col(f"{section}.{source}")
    change = (F.col("county") == DEFAULT_COUNTY) & have.isNull() & spare.isNotNull()
    filled = F.col(section).withField(target, F.coalesce(have, F.when(change, spare)))
    return df.withColumn("repaired", F.coalesce(change, F.lit(False))).withColumn(section, filled)


def fill_county(df: DataFrame) -> DataFrame:
    missing = F.col("county").isNull()
    return df.withColumn("repaired", missing).withColumn(
        "county", F.coalesce("county", F.lit(DEFAULT_COUNTY))
    )


def fill_street_address(df: DataFrame) -> DataFrame:
    return _fill(df, "property_address", "street_address", "full_address")


def fill_market_value(df: DataFrame) -> DataFrame:
    return _fill(df, "valuation", "market_value", "total_market_value")


def repaired_count(df: DataFrame) -> Column:
    """Number of changed records, as a scalar."""
    return df.agg(F.count_if("repaired")).scalar()

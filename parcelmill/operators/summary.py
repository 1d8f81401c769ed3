"""Account, owner and store summaries."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.names import COMMON_OWNER_TYPES
from parcelmill.functions.values import effective_value, has_usable_value
from parcelmill.operators.joins import share_of
from parcelmill.operators.keyed import top_per_key
from parcelmill.operators.quantiles import median_low_high


def distinct_with_null(c: str) -> Column:
    """Distinct values, a null counting as one of them."""
    return F.count_distinct(c) + F.coalesce(F.max(F.col(c).isNull().cast("long")), F.lit(0))


def account_summary(accounts: DataFrame) -> DataFrame:
    """Rows, accounts, mean / median / max / min appraised value and the year range.

    `tot_appr_val` is decimal(18,2); the median is taken over whole cents.
    """
    cents = accounts.select((F.col("tot_appr_val") * 100).cast("bigint").alias("cents"))
    middle = median_low_high(cents, "cents").select(
        ((F.col("low") + F.col("high")) / F.lit(200.0)).alias("m")
    )
    return accounts.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct_with_null("acct").alias("unique_accounts"),
        F.avg("tot_appr_val").alias("avg_value"),
        F.max("tot_appr_val").alias("max_value"),
        F.min("tot_appr_val").alias("min_value"),
        F.min("yr_impr").alias("min_year"),
        F.max("yr_impr").alias("max_year"),
    ).withColumn("median_value", middle.scalar())


def missing_percent(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of null cells per column, in long form, from one pass."""
    rates = df.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in columns])
    return rates.unpivot([], columns, "field", "missing_pct")


def owner_summary(owners: DataFrame) -> DataFrame:
    share = F.col("pct_own")
    return owners.agg(
        F.count(F.lit(1)).alias("total_records"),
        distinct_with_null("acct").alias("unique_accounts"),
        distinct_with_null("name").alias("unique_owners"),
        F.avg(share).alias("avg_ownership_pct"),
        F.count_if(share >= 1.0).alias("full_ownership_count"),
        F.count_if(share < 1.0).alias("partial_ownership_count"),
    )


def accounts_with_many(owners: DataFrame, key: str) -> DataFrame:
    """Keys with more than one row, with their row count."""
    return owners.groupBy(key).agg(F.count(F.lit(1)).alias("owner_count")).filter("owner_count > 1")


def distribution(df: DataFrame, columns: list[str], *more: Column) -> DataFrame:
    """Rows and percent per group, with further aggregates where given.

    The total is the sum of the group counts, so the input is read once and the shuffle is reused.
    """
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("count"), *more)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("percent", share_of(F.col("count"), total))


def top_groups(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    """The `n` largest groups; equal counts are ordered by the group."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc(column)).limit(n)


def top_groups_per(df: DataFrame, per: str, column: str, n: int) -> DataFrame:
    counts = df.groupBy(per, column).agg(F.count(F.lit(1)).alias("count"))
    return top_per_key(counts, [per], [F.desc("count"), F.asc(column)], n)


def common_business_owners(owners: DataFrame, n: int = 10) -> DataFrame:
    return top_groups(owners.filter(F.col("name").rlike(COMMON_OWNER_TYPES)), "name", n)


def value_statistics(gold: DataFrame, market: str, total_market: str, assessed: str) -> DataFrame:
    """Average, range and count of the effective value over records with a usable value."""
    cols = [F.col(c) for c in (market, total_market, assessed)]
    usable = gold.filter(has_usable_value(*cols)).select(effective_value(*cols).alias("v"))
    return usable.agg(
        F.avg("v").alias("avg_value"),
        F.min("v").alias("min_value"),
        F.max("v").alias("max_value"),
        F.count(F.lit(1)).alias("count"),
    )


def view_statistics(gold: DataFrame, market: str, total: str) -> DataFrame:
    """Count, floor average, upper median and range of whole values above zero."""
    first_set = F.coalesce(F.when(F.col(market) != 0, F.col(market)), F.col(total))
    whole = gold.select(F.when(first_set > 0, first_set).cast("bigint").alias("v"))
    values = whole.filter(F.col("v").isNotNull())
    middle = median_low_high(values, "v").select("high")
    return values.agg(
        F.count("v").alias("with_value"),
        F.floor(F.sum(F.col("v").cast("decimal(38,0)")) / F.count("v")).cast("bigint").alias("average"),
        F.min("v").alias("lowest"),
        F.max("v").alias("highest"),
    ).withColumn("median", middle.scalar())


def spread(df: DataFrame, value: Column) -> DataFrame:
    """Average, minimum and maximum of an expression."""
    return df.select(value.alias("v")).agg(
        F.avg("v").alias("average"), F.min("v").alias("lowest"), F.max("v").alias("highest")
    )


def positive_spread(df: DataFrame, value: Column) -> DataFrame:
    return spread(df.filter(value > 0), value)

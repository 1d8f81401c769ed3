"""Filters and text search over unified records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.values import has_usable_value


def in_county(df: DataFrame, county: str) -> DataFrame:
    """`all` keeps every county; otherwise one partition of the store is read."""
    return df if county.lower() == "all" else df.filter(F.col("county") == county.lower())


def contains_any(df: DataFrame, term: str, columns: list[Column]) -> DataFrame:
    """Case-insensitive substring search over several columns; a blank term keeps all rows."""
    needle = term.strip().lower()
    if not needle:
        return df
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lit(needle))
    return df.filter(hit)


def equal_to_all(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Field-equality filter; keys may be dotted paths."""
    for path, value in wanted.items():
        df = df.filter(F.col(path) == F.lit(value))
    return df


def word_search(df: DataFrame, terms: list[str], columns: list[Column]) -> DataFrame:
    """Records with at least one of the words, with the number of words found (`score`)."""
    words = F.split(F.lower(F.concat_ws(" ", *columns)), r"[^a-z0-9]+")
    wanted = F.array(*[F.lit(t.lower()) for t in sorted(set(terms))])
    scored = df.withColumn("score", F.size(F.array_intersect(wanted, words)))
    return scored.filter(F.col("score") > 0)


def with_usable_value(df: DataFrame, market: str, total_market: str, assessed: str) -> DataFrame:
    return df.filter(has_usable_value(F.col(market), F.col(total_market), F.col(assessed)))

"""Join shapes used by the county builders.

No join here carries a broadcast hint: Spark broadcasts a side when its measured size is under the
session threshold and otherwise shuffles, and adaptive execution splits skewed partitions. Where the
size is only guessed, and as large as the parent, `join_parts` keeps it from the driver.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fan_out_left_join(parent: DataFrame, child: DataFrame, key: str) -> DataFrame:
    """Left join in which one key may own a large share of the child rows.

    Adaptive execution can split either side of an inner join but only the left side of a left join,
    so matched and unmatched parents are joined apart.
    """
    matched = parent.join(child, key)
    child_keys = child.select(key).distinct()
    unmatched = parent.join(child_keys, key, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)


def join_parts(parent: DataFrame, parts: DataFrame, key: str) -> DataFrame:
    """Left join of `parts`, which have one row per key and may be as many as the parent's rows.

    Before they are built, Spark guesses their size from a few columns of their files, which is far too low for texts and
    structs, and would send them all through the driver to every task.
    """
    return parent.join(parts.hint("merge"), key, "left")


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str) -> DataFrame:
    """Left join to a code table; both keys are compared as text."""
    codes = lookup.withColumn("_code", F.col(lookup_key).cast("string")).drop(lookup_key)
    return df.join(codes, F.col(key).cast("string") == F.col("_code"), "left").drop("_code")


def with_existence_flag(df: DataFrame, other: DataFrame, key: str, flag: str) -> DataFrame:
    present = other.select(key).distinct().withColumn(flag, F.lit(True))
    return df.join(present, key, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def with_child_count(df: DataFrame, child: DataFrame, key: str, name: str) -> DataFrame:
    """Number of child rows per key; null where there are none."""
    counts = child.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return df.join(counts, key, "left")


def keep_keys_of(child: DataFrame, selected: DataFrame, key: str) -> DataFrame:
    """Child rows of the selected keys only."""
    return child.join(selected.select(key), key, "left_semi")


def primary_owner(owners: DataFrame, key: str) -> DataFrame:
    """Name, alias and share of the first owner line, under their export names."""
    return owners.filter(F.col("ln_num") == 1).select(
        key,
        F.col("name").alias("primary_owner_name"),
        F.col("aka").alias("primary_owner_aka"),
        F.col("pct_own").alias("primary_ownership_pct"),
    )


def share_of(part: Column, whole: Column) -> Column:
    """Percent, null for an empty whole."""
    return F.try_divide(part * F.lit(100.0), whole)

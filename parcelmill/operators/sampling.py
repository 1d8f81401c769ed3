"""Heads, repeatable random samples and per-group samples.

A sample is the first n rows by a hash of the id. Rows are counted by the first digits of their hash; the digits at
which n is reached tell which rows belong to it: those with lower digits all, and of those with just these digits as
many as are missing. So only the rows of one such class are ever ordered, not a group.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hexadecimal digits by which rows are counted: 65,536 classes a group.
DIGITS = 4


def shuffle_key(id_column: str, seed: str) -> Column:
    """Pseudo-random order that is the same in every run and on every cluster."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.col(id_column)))


def head_by_position(df: DataFrame, position: str, n: int) -> DataFrame:
    return df.orderBy(position).limit(n)


def random_sample(df: DataFrame, id_column: str, n: int, seed: str) -> DataFrame:
    everything = df.withColumn("_all", F.lit(0))
    return random_sample_per(everything, "_all", id_column, n, seed).drop("_all")


def random_sample_per(df: DataFrame, group: str, id_column: str, n: int, seed: str) -> DataFrame:
    """`n` rows of each group (all, if it has fewer); rows without a group are one group."""
    keyed = df.withColumn("_order", shuffle_key(id_column, seed)).withColumn("_class", F.substring("_order", 1, DIGITS))
    sizes = keyed.groupBy(F.col(group).alias("_group"), "_class").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy("_group").orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)  # a row a class
    before = sizes.withColumn("_before", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    reached = before.filter((F.col("_before") < n) & (F.col("_before") + F.col("_size") >= n))
    limits = reached.select("_group", F.col("_class").alias("_limit"), (F.lit(n) - F.col("_before")).alias("_missing"))
    # a row for each group; a group with fewer than n rows has none, and stays whole
    met = keyed.join(limits, keyed[group].eqNullSafe(limits["_group"]), "left")
    low = met.filter(F.col("_limit").isNull() | (F.col("_class") < F.col("_limit")))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy("_order", id_column))
    edge = met.filter(F.col("_class") == F.col("_limit")).withColumn("_rank", rank).filter(F.col("_rank") <= F.col("_missing"))
    return low.select(*df.columns).unionByName(edge.select(*df.columns))

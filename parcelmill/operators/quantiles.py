"""Exact medians without holding the distinct values of a table in one task.

A global `median` keeps every distinct value in one aggregation buffer. Here the rank is narrowed in
three rounds of 21 bits; each round counts at most 2^21 digit groups, and only the counts are ordered.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

DIGIT_BITS = 21
_MASK = (1 << DIGIT_BITS) - 1


def values_at_ranks(df: DataFrame, value: str, ranks: DataFrame, names: list[str]) -> DataFrame:
    """The whole numbers at the 1-based ranks in `ranks` (`which`, `rank`): (`which`, `value`).

    `names` lists the values of `which`.
    """
    counted = df.filter(F.col(value).isNotNull()).groupBy(F.col(value).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    digits = [
        F.shiftright("_v", 2 * DIGIT_BITS),
        F.shiftright("_v", DIGIT_BITS).bitwiseAND(F.lit(_MASK)),
        F.col("_v").bitwiseAND(F.lit(_MASK)),
    ]
    cells = counted.withColumns({f"_d{i}": d for i, d in enumerate(digits)})
    found = ranks.select("which", F.col("rank").cast("long").alias("_rank"))
    prefix: list[str] = []
    for level in range(len(digits)):
        digit = f"_d{level}"
        # `found` has one row per wanted rank, so the narrowed counts stay small
        narrowed = cells.join(found, prefix) if prefix else cells
        if prefix:
            sizes = narrowed.groupBy("which", "_rank", *prefix, digit).agg(F.sum("_n").alias("_n"))
        else:
            # at most 2^21 counts, repeated once per wanted rank
            per_digit = cells.groupBy(digit).agg(F.sum("_n").alias("_n"))
            wanted = F.explode(F.array(*[F.lit(w) for w in names]))
            sizes = per_digit.withColumn("which", wanted).join(found, "which")
        order = Window.partitionBy("which").orderBy(digit)
        upto = F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, 0))
        placed = sizes.withColumn("_upto", upto).filter(
            (F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank"))
        )
        rest = (F.col("_rank") - (F.col("_upto") - F.col("_n"))).alias("_rank")
        found = placed.select("which", *prefix, digit, rest)
        prefix.append(digit)
    high, mid, low = (F.col(d).cast("long") for d in prefix)
    return found.select(
        "which",
        (
            F.shiftleft(high, 2 * DIGIT_BITS) + F.shiftleft(mid, DIGIT_BITS) + low
        ).alias("value"),
    )


def _rank_rows(df: DataFrame, value: str, ranks: dict) -> DataFrame:
    total = df.agg(F.count(value).alias("n"))
    pairs = [F.struct(F.lit(w).alias("which"), r.alias("rank")) for w, r in ranks.items()]
    return total.select(F.explode(F.array(*pairs)).alias("r")).select("r.which", "r.rank")


def median_low_high(df: DataFrame, value: str) -> DataFrame:
    """One row with the lower and upper median (`low`, `high`); both null for no values."""
    n = F.col("n")
    ranks = _rank_rows(
        df,
        value,
        {"low": F.floor((n + 1) / 2), "high": F.floor(n / 2) + 1},
    )
    at = values_at_ranks(df, value, ranks, ["low", "high"])
    return at.agg(
        F.max(F.when(F.col("which") == "low", F.col("value"))).alias("low"),
        F.max(F.when(F.col("which") == "high", F.col("value"))).alias("high"),
    )

"""Per-key row rules that stay balanced when one key holds a large share of the rows.

First, last and top-n per key use `row_number() <= n`, which Spark limits inside each map task
before the shuffle. Counting and carrying forward within a key first split the key into ordered
spans, summarise each span, and only then finish inside the spans.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.functions.ids import has_account_id

ROWS_PER_SPAN = 1_000_000


def _columns(names: list[str]) -> list[Column]:
    return [F.col(n) for n in names]


def split_by_id(df: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an account id, rejects). Kept apart, so that rows without one do not meet on one key."""
    usable = has_account_id(F.col(column))
    return df.filter(usable), df.filter(~usable)


def top_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """The first `n` rows of each key in the given order."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") <= n).drop("_rank")


def first_per_key(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(position).asc()])


def last_per_key(df: DataFrame, keys: list[str], position: str) -> DataFrame:
    return top_per_key(df, keys, [F.col(position).desc()])


def _null_safe_on(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    condition = F.lit(True)
    for n in names:
        condition = condition & left[n].eqNullSafe(right[f"_r_{n}"])
    return condition


def positions(
    df: DataFrame, keys: list[str], order: str, name: str, span: int = ROWS_PER_SPAN
) -> DataFrame:
    """1-based position of each row in its key, by the unique whole number `order`."""
    cut = df.withColumn("_span", F.floor(F.col(order) / span))
    sizes = cut.groupBy(*keys, "_span").agg(F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        *[F.col(k).alias(f"_r_{k}") for k in [*keys, "_span"]],
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"),
    )
    joined = cut.join(offsets, _null_safe_on(cut, offsets, [*keys, "_span"]))
    inside = Window.partitionBy(*keys, "_span").orderBy(order)
    return joined.withColumn(name, F.col("_before") + F.row_number().over(inside)).select(
        *df.columns, name
    )


def carry_forward(
    df: DataFrame, keys: list[str], order: str, value: str, name: str, span: int = ROWS_PER_SPAN
) -> DataFrame:
    """Last non-null `value` of strictly earlier rows of the key, in the order of a whole number."""
    cut = df.withColumn("_span", F.floor(F.col(order) / span))
    last_in_span = F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order)))
    tails = cut.groupBy(*keys, "_span").agg(last_in_span.alias("_tail"))
    earlier = Window.partitionBy(*keys).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    carried = tails.select(
        *[F.col(k).alias(f"_r_{k}") for k in [*keys, "_span"]],
        F.last("_tail", ignorenulls=True).over(earlier).alias("_carried"),
    )
    joined = cut.join(carried, _null_safe_on(cut, carried, [*keys, "_span"]))
    inside = (
        Window.partitionBy(*keys, "_span")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    seen = F.last(value, ignorenulls=True).over(inside)
    return joined.withColumn(name, F.coalesce(seen, F.col("_carried"))).select(*df.columns, name)

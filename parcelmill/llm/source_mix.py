"""Mixing sources to target weights, with DataFrame functions only.

Every row gets a hash-random key. Rows are dealt by source and the leading digits of the key, so a
source that holds a third of all rows is spread over `16 ** DIGITS` ordered ranges; sums per range give
the distributed prefix sums, and each range finishes its own rows. A source's budget is cut at its exact
word: whole epochs first, then the rows in key order up to the budget.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.llm.common import WORD

#: Leading hexadecimal digits of the key that name a range: 4,096 ranges for each source.
DIGITS = 3


def text_size(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """Per source (`label`, `source_size`) its target.

    All sources share `share` times the total size by weight; none gets more than `most` times its own
    size, and what that leaves over is shared again by weight. In the order of size over weight the
    stopped sources come first; with the first i - 1 stopped, the others get `level` per weight, and the
    level of the right i is the largest of all. The windows hold one row per source.
    """
    by_label, every = Window.orderBy("label"), Window.partitionBy()
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    place = (F.row_number().over(by_label) - 1) % len(weights) + 1
    ordered = Window.orderBy(F.col("source_size") / F.col("weight"), "label")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.lit(share) * F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    )
    return (
        sizes.withColumn("weight", F.element_at(cycle, place))
        .withColumn("level", level)
        .withColumn("level", F.max("level").over(every))
        .select("label", "source_size", F.least((most * F.col("source_size")).cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def mix(
    docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, most: int = 2,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Per row `doc_id, source, size, source_size, target, taken`, and `document`, the row itself.

    A null text has size 0; null sources form one source, after all others. Rows of equal id and text
    have equal keys: they stand side by side, so which of them the cut falls on makes no difference to the
    set of results. Rows of size 0 take nothing. No rows give no rows; other columns stay in `document`.
    """
    key = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.lit("|"), F.coalesce(F.col(text), F.lit("-"))))
    rows = docs.select(
        F.struct("*").alias("document"),
        F.col(doc_id).alias("doc_id"),
        F.col(source).alias("source"),
        # orders by code point, null last
        F.coalesce(F.concat(F.lit("s"), F.col(source)), F.lit("t")).alias("label"),
        text_size(F.col(text)).alias("size"),
        key.alias("key"),
    ).withColumn("range", F.substring("key", 1, DIGITS))
    ranges = rows.groupBy("label", "range").agg(F.sum("size").alias("range_size"))
    targets = source_targets(ranges.groupBy("label").agg(F.sum("range_size").alias("source_size")), weights, share, most)
    preceding = Window.partitionBy("label").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    budget, whole = F.round("target").cast("long"), F.when(F.col("source_size") > 0, F.expr("budget div source_size")).otherwise(0)
    plan = (
        ranges.withColumn("range_before", F.coalesce(F.sum("range_size").over(preceding), F.lit(0)))
        .join(targets, "label")
        .withColumn("budget", budget)
        .withColumn("epochs", whole)
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("source_size"))
        .select("label", "range", "range_before", "source_size", "target", "epochs", "rest")
    )
    inside = Window.partitionBy("label", "range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("range_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - before))
    return rows.join(plan, ["label", "range"]).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"), "document"
    )


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixed corpus: each row whole, as often as the mix takes it.

    The row on which a source's cut falls is not torn: its last part is rounded to a whole copy or none.
    """
    taken = mix(docs, **settings)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    return (
        taken.withColumn("copy", times)
        .filter("copy > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), "copy")))
        .select("document.*")
    )

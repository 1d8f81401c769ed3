"""Child rows of a parent record: as rows, as pages of bounded size, as arrays, or only counted.

Every key is treated alike: there is no count beforehand, no threshold and no cap. The rows of a family
(`rows`) are the child table, which Spark deals out like any other. `pages` cuts the ordered children of each key
into pages of about `PAGE_BYTES`, however many a key has: exports, the store and backups keep these beside the
records. `arrays` puts all children of a key into one row, which must then fit one.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.operators.joins import join_parts
from parcelmill.session import scratch_path

PAGE_BYTES = 1 << 20


@dataclass(frozen=True)
class Nested:
    """`rows` (key, item): one row per child, `item` holding its order and its value."""

    key: str
    rows: DataFrame

    @property
    def arrays(self) -> DataFrame:
        """(key, items, n): all children of each key in order, and their number.

        The number is counted beside the array: a reader of `n` makes no array. Each task collects its own children of a
        key before they meet, so they move once. No item is null, so `sort_array` orders as `array_sort` does, whose
        comparisons are an interpreted lambda.
        """
        whole = self.rows.groupBy(self.key).agg(F.collect_list("item").alias("all"), F.count(F.lit(1)).alias("n"))
        items = F.transform(F.sort_array("all"), lambda x: x["v"]).alias("items")
        return whole.select(self.key, items, "n")

    @property
    def counts(self) -> DataFrame:
        """(key, n), counted within each task first; no child is moved."""
        return self.rows.groupBy(self.key).agg(F.count(F.lit(1)).alias("n"))

    def pages(self, page_bytes: int = PAGE_BYTES) -> DataFrame:
        """(key, page, items): the children of each key in order, cut where their JSON reaches `page_bytes`.

        Equal children of a key are one row with their number until the last step, so however many there are, none of
        them meet. The distinct ones are dealt out as ranges of (key, child) and stored; a key's ranges are
        summed up, and each then finds the bytes before its children. A page holds the children that begin in it.
        """
        size = F.octet_length(F.to_json(F.struct("item"))).cast("bigint")
        distinct = self.rows.groupBy(self.key, "item").agg(F.count(F.lit(1)).alias("copies")).withColumn("size", size)
        path = scratch_path(self.rows.sparkSession, "ranges")
        distinct.repartitionByRange(self.key, "item").withColumn("part", F.spark_partition_id()).write.parquet(path)
        ranged = self.rows.sparkSession.read.parquet(path)  # file partitions are not ranges: `part` says which
        earlier = Window.partitionBy(self.key).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
        starts = ranged.groupBy(self.key, "part").agg(F.sum(F.col("size") * F.col("copies")).alias("bytes")).select(
            self.key, "part", F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("before")
        )
        inside = Window.partitionBy(self.key, "part").orderBy("item").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        taken = F.sum(F.col("size") * F.col("copies")).over(inside)
        placed = ranged.join(starts, [self.key, "part"]).withColumn("start", F.col("before") + taken - F.col("size") * F.col("copies"))
        last = F.col("start") + F.col("size") * (F.col("copies") - 1)
        cut = placed.withColumn("page", F.explode(F.sequence(F.floor(F.col("start") / page_bytes), F.floor(last / page_bytes))))

        def first_at(offset: Column) -> Column:
            """Number of copies that begin before the byte `offset`."""
            return F.least(F.greatest(F.ceil((offset - F.col("start")) / F.col("size")), F.lit(0)), F.col("copies"))

        here = first_at((F.col("page") + 1) * page_bytes) - first_at(F.col("page") * page_bytes)
        entry = F.struct("start", "item", here.cast("int").alias("here"))
        packed = cut.filter(here > 0).groupBy(self.key, "page").agg(F.sort_array(F.collect_list(entry)).alias("entries"))
        items = F.flatten(F.transform("entries", lambda e: F.array_repeat(e["item"]["v"], e["here"])))
        return packed.select(self.key, "page", items.alias("items"))

    def flat(self) -> DataFrame:
        """All children, one row each; a child field named like the key becomes `source_account`."""
        names = self.rows.schema["item"].dataType["v"].dataType.names
        fields = [
            F.col(f"item.v.{n}").alias("source_account" if n == self.key else n) for n in names
        ]
        return self.rows.select(self.key, *fields)


def nest_children(children: DataFrame, key: str, order: list[Column], value: Column) -> Nested:
    """The struct `value` of the children per key, sorted by `order`."""
    place = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)])
    return Nested(key, children.select(key, F.struct(place.alias("o"), value.alias("v")).alias("item")))


def attach(parent: DataFrame, nested: Nested, name: str, arrays: bool = True) -> DataFrame:
    """Left join the arrays (unless not wanted) and the child counts (`<name>_count`) to the parent.

    No children gives an empty array and the count 0.
    """
    if not arrays:
        counted = join_parts(parent, nested.counts, nested.key)
        return counted.withColumn(f"{name}_count", F.coalesce("n", F.lit(0).cast("bigint"))).drop("n")
    joined = join_parts(parent, nested.arrays.withColumnRenamed("items", name), nested.key)
    element = joined.schema[name].dataType
    filled = joined.withColumn(name, F.coalesce(F.col(name), F.array().cast(element)))
    return filled.withColumn(f"{name}_count", F.coalesce("n", F.lit(0).cast("bigint"))).drop("n")


def rows_of(pages: DataFrame, key: str) -> DataFrame:
    """The children of pages as rows: key, `position` (page and place in it), `child`."""
    return pages.select(key, "page", F.posexplode("items").alias("place", "child")).select(
        key, F.struct("page", "place").alias("position"), "child"
    )

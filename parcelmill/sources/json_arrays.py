"""Files that hold one JSON array each, read by many tasks.

A file is cut at every comma, which Spark does in parallel. Whether a comma separates elements depends on what stands
before it: on whether it is inside a string, and on how many brackets are open. Both add up over the pieces: a piece's
quotes say whether it changes from inside to outside, and with that known, its brackets say by how much the depth
changes. So each split sums up its pieces, the sums of the splits before it are added, and the commas outside
strings at depth one are the cuts. The pieces of an element then meet; nothing larger does.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

SPLIT = ["file", "split"]


def _opened(c: Column) -> Column:
    """Brackets that `c`, which holds no strings, opens more than it closes."""
    return F.length(F.translate(c, "]}", "")) - F.length(F.translate(c, "[{", ""))


def _running(value: str, by_split: DataFrame, pieces: DataFrame) -> DataFrame:
    """`pieces` with `before`: the sum of `value` over all earlier pieces of the file."""
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    starts = by_split.select(*SPLIT, F.coalesce(F.sum(value).over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(*SPLIT).orderBy("row").rowsBetween(Window.unboundedPreceding, -1)
    own = F.coalesce(F.sum(value).over(inside), F.lit(0))
    return pieces.join(starts, SPLIT).withColumn("before", F.col("_start") + own).drop("_start")


def array_elements(spark: SparkSession, path: str) -> DataFrame:
    """(file, element, value): the text of each element of each file's array, in order from 0.

    A file without an array gives its whole text as one element; an empty array gives none.
    """
    lines = spark.read.option("lineSep", ",").text(path)
    pieces = lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        "value",
    )
    escaped = F.col("value").contains("\\")
    bare = F.when(escaped, F.regexp_replace("value", r"(?s)\\.", "")).otherwise(F.col("value"))  # escapes stand in strings only
    quotes = F.length(bare) - F.length(F.replace(bare, F.lit('"'), F.lit("")))
    from_outside = _opened(F.regexp_replace(bare, r'"[^"]*("|$)', ""))
    from_inside = _opened(F.regexp_replace(F.regexp_replace(bare, r'^[^"]*("|$)', ""), r'"[^"]*("|$)', ""))
    small = pieces.select(*SPLIT, "row", (quotes % 2).alias("turns"), from_outside.alias("out"), from_inside.alias("in"))

    def summed(rows: DataFrame, value: str) -> DataFrame:
        return rows.groupBy(*SPLIT).agg(F.sum(value).alias(value))

    turned = _running("turns", summed(small, "turns"), small)
    inside = F.col("before") % 2 == 1
    depths = turned.select(
        *SPLIT, "row", F.when(inside, F.col("in")).otherwise(F.col("out")).alias("change"),
        ((F.col("before") + F.col("turns")) % 2 == 1).alias("ends_inside"),
    )
    deep = _running("change", summed(depths, "change"), depths)
    ends = deep.select(*SPLIT, "row", (~F.col("ends_inside") & (F.col("before") + F.col("change") == 1)).cast("long").alias("cut"))
    counted = _running("cut", summed(ends, "cut"), ends).select(*SPLIT, "row", F.col("before").alias("element"))
    parts = pieces.join(counted, [*SPLIT, "row"]).groupBy("file", "element").agg(
        F.sort_array(F.collect_list(F.struct("split", "row", "value"))).alias("parts")
    )
    whole = F.array_join(F.transform("parts", lambda p: p["value"]), ",")
    texts = parts.select("file", "element", whole.alias("value"))
    sizes = texts.groupBy("file").agg(F.max("element").alias("last"), F.bool_or((F.col("element") == 0) & F.col("value").rlike(r"^\s*\[")).alias("is_array"))
    # only the first and the last element of a file meet what is known of the file: all of them would be in one task
    edges = sizes.select("file", F.explode(F.array_distinct(F.array(F.lit(0).cast("bigint"), "last"))).alias("element"), "last", "is_array")
    opened = F.when(F.col("is_array") & (F.col("element") == 0), F.regexp_replace("value", r"^\s*\[", "")).otherwise(F.col("value"))
    closed = F.when(F.col("is_array") & (F.col("element") == F.col("last")), F.regexp_replace(opened, r"\]\s*$", "")).otherwise(opened)
    trimmed = F.trim(F.regexp_replace(closed, r"^\s+|\s+$", "")).alias("value")
    out = texts.join(edges, ["file", "element"], "left").select("file", "element", "last", trimmed)
    return out.filter((F.col("value") != "") | F.col("last").isNull() | (F.col("last") != 0)).drop("last")


def read_arrays(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(`records`, `corrupt`) of files that hold one array of records each; a broken element is corrupt by itself."""
    with_corrupt = StructType([*schema.fields, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = array_elements(spark, path).select(F.from_json("value", with_corrupt, options).alias("r"), "value")
    bad = F.col("r").isNull() | F.col("r._corrupt").isNotNull()
    records = parsed.filter(~bad).select(*[F.col(f"r.{f.name}") for f in schema])
    return records, parsed.filter(bad).select(F.col("value").alias("_corrupt"))

"""Coverage, completeness and integrity reports. Every report reads all rows, never a sample."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BooleanType,
    DataType,
    NumericType,
    StringType,
    StructType,
)

from parcelmill.functions.text import strip

# Record fields by report category.
CATEGORIES = {
    "core_fields": ["account_id", "county", "year"],
    "address_fields": ["property_address", "mailing_address"],
    "financial_fields": ["valuation"],
    "legal_fields": ["legal_status"],
    "entity_fields": ["tax_entities"],
    "detail_fields": ["improvements", "land_details", "property_details"],
}
COVERAGE_FIELDS = [f for fields in CATEGORIES.values() for f in fields]

# Fields whose absence is listed per record, reported sub-fields, load-time paths.
KEY_FIELDS = [
    "account_id", "county", "year", "property_address", "mailing_address", "valuation",
    "legal_status", "tax_entities", "improvements", "land_details",
]
SUB_FIELDS = [
    "property_address.street_address", "property_address.city", "property_address.state",
    "property_address.zip_code", "mailing_address.name", "mailing_address.address_line_1",
    "mailing_address.city", "mailing_address.state", "mailing_address.zip_code",
    "valuation.market_value", "valuation.assessed_value", "valuation.total_market_value",
]
LOAD_PATHS = [
    "property_address.street_address", "mailing_address.name", "valuation.market_value",
    "tax_entities", "improvements",
]

CRITICAL_RATE = 50.0
GAP_RATE = 30.0
LARGE_STORE = 10_000

# Integrity bands (percent) and averages that lead to a recommendation.
GRADES = [(98, "Excellent"), (90, "Good"), (75, "Fair")]
ADVICE = [(0.95, "proceed"), (0.85, "investigate")]


def _type_of(schema: StructType, path: str) -> DataType:
    kind: DataType = schema
    for part in path.split("."):
        kind = kind[part].dataType
    return kind


def _any_value(c: Column, kind: DataType) -> Column:
    """True where any leaf of a struct is set."""
    if isinstance(kind, StructType):
        hit = F.lit(False)
        for f in kind:
            hit = hit | _any_value(c.getField(f.name), f.dataType)
        return hit
    return c.isNotNull()


def is_filled(df: DataFrame, path: str) -> Column:
    """Holds data: a struct with any value, a non-empty array, text that is not blank, a number
    other than zero, or true."""
    c, kind = F.col(path), _type_of(df.schema, path)
    if isinstance(kind, StructType):
        filled = _any_value(c, kind)
    elif isinstance(kind, ArrayType):
        filled = F.size(c) > 0
    elif isinstance(kind, StringType):
        filled = strip(c) != ""
    elif isinstance(kind, NumericType):
        filled = c != 0
    elif isinstance(kind, BooleanType):
        filled = c
    else:
        filled = c.isNotNull()
    return F.coalesce(filled, F.lit(False))


def percent(part: Column, total: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), total), F.lit(0.0))


def field_coverage(df: DataFrame, paths: list[str], by: str = "county") -> DataFrame:
    """Present and filled counts and rates per group and field, in long form, from one pass."""
    # flags first: the wide aggregate then reads narrow booleans, not whole sections
    flags = df.select(
        F.col(by).alias("_by"),
        *[F.col(p).isNotNull().alias(f"p{i}") for i, p in enumerate(paths)],
        *[is_filled(df, p).alias(f"f{i}") for i, p in enumerate(paths)],
    )
    totals = flags.groupBy("_by").agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(f"p{i}").alias(f"p{i}") for i in range(len(paths))],
        *[F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(paths))],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(p).alias("field"),
                F.col(f"p{i}").alias("present"),
                F.col(f"f{i}").alias("non_empty"),
            )
            for i, p in enumerate(paths)
        ]
    )
    long = totals.select(F.col("_by").alias(by), "total", F.inline(rows))
    return long.withColumns(
        {
            "presence_rate": percent(F.col("present"), F.col("total")),
            "quality_rate": percent(F.col("non_empty"), F.col("total")),
        }
    )


def with_category(coverage: DataFrame) -> DataFrame:
    names = F.create_map(
        *[F.lit(x) for category, fields in CATEGORIES.items() for f in fields for x in (f, category)]
    )
    return coverage.withColumn("category", F.try_element_at(names, F.col("field")))


def category_quality(coverage: DataFrame) -> DataFrame:
    """Mean quality rate per county and category, per county, and over the counties."""
    tagged = with_category(coverage)
    by_category = tagged.groupBy("county", "category").agg(F.avg("quality_rate").alias("quality"))
    by_county = tagged.groupBy("county").agg(F.avg("quality_rate").alias("quality"))
    overall = by_county.agg(F.avg("quality").alias("quality"))
    return (
        by_category.unionByName(by_county.withColumn("category", F.lit("all")))
        .unionByName(overall.select(F.lit("all").alias("county"), F.lit("all").alias("category"), "quality"))
    )


def missing_key_fields(df: DataFrame, paths: list[str] = KEY_FIELDS) -> DataFrame:
    """Records that lack key fields, with the list of what is missing."""
    flags = df.select(
        F.col("county").alias("_county"),
        F.col("account_id").alias("_id"),
        *[is_filled(df, p).alias(f"f{i}") for i, p in enumerate(paths)],
    )
    complete = F.lit(True)
    for i in range(len(paths)):
        complete = complete & F.col(f"f{i}")
    missing = F.array_compact(
        F.array(*[F.when(~F.col(f"f{i}"), F.lit(p)) for i, p in enumerate(paths)])
    )
    return flags.filter(~complete).select(
        F.col("_county").alias("county"),
        F.col("_id").alias("account_id"),
        missing.alias("missing_fields"),
    )


def completeness_summary(coverage: DataFrame) -> DataFrame:
    """Fields with data in every record, and the mean rate, per county."""
    return coverage.groupBy("county").agg(
        F.max("total").alias("total_properties"),
        F.count_if(F.col("non_empty") == F.col("total")).alias("complete_fields"),
        F.avg("quality_rate").alias("average_completeness"),
    )


def critical_fields(coverage: DataFrame, n: int = 10) -> DataFrame:
    """Fields under 50 % quality, the worst first."""
    low = coverage.filter(F.col("quality_rate") < CRITICAL_RATE)
    return low.orderBy("quality_rate", "county", "field").limit(n)


def recommendations(coverage: DataFrame) -> DataFrame:
    """Rule-based advice: gaps under 30 % (high), several counties (medium), a large store (low)."""
    gap = coverage.filter(F.col("quality_rate") < GAP_RATE)
    label = F.format_string("%s (%.1f%%)", F.col("field"), F.col("quality_rate"))
    # one entry per report field, so the list is bounded by the schema
    gaps = gap.groupBy("county").agg(
        F.array_join(F.array_sort(F.collect_list(label)), ", ").alias("detail")
    ).select("county", F.lit("data_completeness").alias("type"), F.lit("high").alias("priority"), "detail")
    totals = coverage.groupBy("county").agg(F.max("total").alias("n")).agg(
        F.count(F.lit(1)).alias("counties"), F.sum("n").alias("n")
    )
    consistency = totals.filter("counties > 1").select(
        F.lit("all").alias("county"),
        F.lit("consistency").alias("type"),
        F.lit("medium").alias("priority"),
        F.col("counties").cast("string").alias("detail"),
    )
    size = totals.filter(F.col("n") > LARGE_STORE).select(
        F.lit("all").alias("county"),
        F.lit("performance").alias("type"),
        F.lit("low").alias("priority"),
        F.col("n").cast("string").alias("detail"),
    )
    return gaps.unionByName(consistency).unionByName(size)


@dataclass(frozen=True)
class Dimension:
    name: str
    value: Column


def county_distributions(df: DataFrame, dimensions: list[Dimension]) -> DataFrame:
    """Count and percent of each value per county and dimension."""
    cells = F.array(
        *[
            F.struct(F.lit(d.name).alias("dimension"), d.value.cast("string").alias("value"))
            for d in dimensions
        ]
    )
    counts = (
        df.select("county", F.inline(cells))
        .groupBy("county", "dimension", "value")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    totals = df.groupBy("county").agg(F.count(F.lit(1)).alias("total"))
    joined = counts.join(totals, "county")
    return joined.withColumn("percent", percent(F.col("count"), F.col("total"))).drop("total")


def feature_presence(df: DataFrame, arrays: list[str]) -> DataFrame:
    """Whether any record of the county has entries in each array."""
    return df.groupBy("county").agg(
        *[F.coalesce(F.bool_or(F.size(a) > 0), F.lit(False)).alias(f"has_{a}") for a in arrays]
    )


def row_integrity(df: DataFrame, name: str) -> DataFrame:
    """Empty and fragmented rows and the integrity score; an empty row counts in both."""
    n = len(df.columns)
    needed = max(3, n // 3)
    filled = F.lit(0)
    for c in df.columns:
        filled = filled + F.when(F.col(c).cast("string") != "", 1).otherwise(0)
    counted = df.select(filled.alias("filled")).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("filled") == 0).alias("empty_rows"),
        F.count_if(F.col("filled") < needed).alias("fragmented_rows"),
    )
    bad = F.col("empty_rows") + F.col("fragmented_rows")
    score = F.coalesce(F.lit(1.0) - F.try_divide(bad.cast("double"), F.col("total_rows")), F.lit(0.0))
    return counted.select(
        F.lit(name).alias("file"), F.lit(n).alias("columns"), "*", score.alias("integrity")
    )


def structure_issues(lines: DataFrame, header: list[str], sep: str = "\t") -> DataFrame:
    """Lines whose delimiter count differs from the header's, and their rate."""
    delimiters = F.length("value") - F.length(F.replace("value", F.lit(sep), F.lit("")))
    body = lines.filter(F.col("value") != sep.join(header))
    counted = body.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(delimiters != len(header) - 1).alias("issues_found"),
    )
    rate = F.coalesce(F.try_divide(F.col("issues_found").cast("double"), F.col("lines")), F.lit(0.0))
    return counted.select(
        F.lit(len(header) - 1).alias("expected_delimiters"), "*", rate.alias("problem_rate")
    )


def graded(integrity: DataFrame) -> DataFrame:
    """Status of each file by its integrity score."""
    percent = F.col("integrity") * 100
    status = F.when(percent >= GRADES[0][0], GRADES[0][1])
    for limit, label in GRADES[1:]:
        status = status.when(percent >= limit, label)
    return integrity.withColumn("status", status.otherwise("Poor"))


def overall_advice(integrity: DataFrame) -> DataFrame:
    average = integrity.agg(F.avg("integrity").alias("average_integrity"))
    a = F.col("average_integrity")
    advice = F.when(a >= ADVICE[0][0], ADVICE[0][1]).when(a >= ADVICE[1][0], ADVICE[1][1])
    return average.withColumn("advice", advice.otherwise("inspect"))


def profile(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Type, null count and distinct count (a null counts as one value) per column.

    The values of all columns become (column, value) pairs, which are counted within each task first; values are told
    apart by their text. With `approximate` the distinct counts are sketches, which need constant memory.
    """
    kinds = F.create_map(*[F.lit(x) for i, c in enumerate(df.columns) for x in (i, df.schema[c].dataType.simpleString())])
    names = F.array(*[F.lit(c) for c in df.columns])
    cells = F.array(*[F.struct(F.lit(i).alias("at"), F.col(c).cast("string").alias("value")) for i, c in enumerate(df.columns)])
    pairs = df.select(F.inline(cells))
    if approximate:
        distinct = F.approx_count_distinct("value") + F.coalesce(F.max(F.col("value").isNull().cast("long")), F.lit(0))
        counted = pairs.groupBy("at").agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("value").isNull()).alias("null_count"), distinct.alias("distinct_count")
        )
    else:
        values = pairs.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
        nulls = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0))
        counted = values.groupBy("at").agg(F.sum("n").alias("rows"), nulls.alias("null_count"), F.count(F.lit(1)).alias("distinct_count"))
    column, kind = F.get(names, F.col("at")), F.try_element_at(kinds, F.col("at"))
    return counted.select("rows", column.alias("column"), kind.alias("type"), "null_count", "distinct_count")


FIXED_WIDTH_GUESS = 200


def file_diagnostics(lines: DataFrame, file: Column) -> DataFrame:
    """Lines and line lengths per file, with a guess at fixed-width files."""
    size = F.length("value")
    by_file = lines.groupBy(file.alias("file")).agg(
        F.count(F.lit(1)).alias("lines"),
        F.min(size).alias("shortest"),
        F.max(size).alias("longest"),
        F.avg(size).alias("average"),
    )
    guess = F.when(F.col("longest") > FIXED_WIDTH_GUESS, "fixed_width").otherwise("unknown")
    return by_file.withColumn("format", guess)


def compare_coverage(coverage: DataFrame, left: str, right: str) -> DataFrame:
    """Per field: which of two counties fills it, both rates, and advice where they differ."""

    def rate(county: str) -> Column:
        return F.max(F.when(F.col("county") == county, F.col("quality_rate")))

    both = coverage.groupBy("field").agg(rate(left).alias("left_rate"), rate(right).alias("right_rate"))
    has_left = F.coalesce(F.col("left_rate"), F.lit(0.0)) > 0
    has_right = F.coalesce(F.col("right_rate"), F.lit(0.0)) > 0
    side = (
        F.when(has_left & has_right, "common")
        .when(has_left, f"only_{left}")
        .when(has_right, f"only_{right}")
        .otherwise("neither")
    )
    advice = F.when(side.startswith("only_"), F.concat(F.lit("extend the other county with "), "field"))
    return both.withColumns({"side": side, "advice": advice})


def filled_fields(coverage: DataFrame, county: str) -> DataFrame:
    """Names of the fields with any data in the county."""
    return coverage.filter((F.col("county") == county) & (F.col("non_empty") > 0)).select("field")

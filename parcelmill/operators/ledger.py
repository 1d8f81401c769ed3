"""Coverage as a ledger: what a batch adds to and takes from each count, so that reports never read records.

A ledger row says by how much a batch changes one count of one county: (county, kind, name, value, total, present,
filled). Of kind `field` it counts records, and those in which the field `name` is present and filled; of kind
`dimension` it counts records whose dimension `name` has that `value`. Gaps say which records lack key fields, with +1
where a batch brings such a record and -1 where it takes one away. Sums over the batches of a store give its state.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelmill.functions.values import county_property_type
from parcelmill.operators import quality

LEDGER_DDL = "county string, kind string, name string, value string, total bigint, present bigint, filled bigint"
GAPS_DDL = "county string, account_id string, missing string, change bigint"
PATHS = list(dict.fromkeys([*quality.COVERAGE_FIELDS, *quality.LOAD_PATHS, *quality.SUB_FIELDS]))


def record_dimensions() -> list[quality.Dimension]:
    """Property type, city, zip code and number of improvements of a unified record."""
    unknown = F.lit("Unknown")
    details = [F.col(f"property_details.{n}") for n in ("property_type", "division_code", "state_class")]
    return [
        quality.Dimension("property_type", county_property_type(F.col("county"), *details)),
        quality.Dimension("city", F.coalesce("property_address.city", unknown)),
        quality.Dimension("zip_code", F.coalesce("property_address.zip_code", unknown)),
        quality.Dimension("improvements", F.col("child_counts.improvements")),
    ]


def _has(schema: StructType, path: str) -> bool:
    kind = schema
    for part in path.split("."):
        if not isinstance(kind, StructType) or part not in kind.names:
            return False
        kind = kind[part].dataType
    return True


def _filled(df: DataFrame, path: str) -> Column:
    """Child families are filled by their count: their rows need not be in the record."""
    if _has(df.schema, f"child_counts.{path}"):
        return F.coalesce(F.col(f"child_counts.{path}") > 0, F.lit(False))
    return quality.is_filled(df, path)


def facts(df: DataFrame) -> DataFrame:
    """One narrow row per record: county, account_id, flags `p…` and `f…` of the fields it has, `missing`, `dims`."""
    paths = [p for p in PATHS if _has(df.schema, p)]
    unified = all(_has(df.schema, p) for p in ("property_details.state_class", "property_address.zip_code", "child_counts.improvements"))
    dims = [F.struct(F.lit(d.name).alias("name"), d.value.cast("string").alias("value")) for d in record_dimensions()] if unified else []
    absent = [F.when(~_filled(df, p), F.lit(p)) for p in quality.KEY_FIELDS] if unified else []
    return df.select(
        "county",
        "account_id",
        *[F.col(p).isNotNull().alias(f"p:{p}") for p in paths],
        *[_filled(df, p).alias(f"f:{p}") for p in paths],
        F.array_join(F.array_compact(F.array(*absent)), ",").alias("missing") if absent else F.lit("").alias("missing"),
        F.array(*dims).cast("array<struct<name: string, value: string>>").alias("dims"),
    )


def signed(added: DataFrame, removed: DataFrame | None) -> DataFrame:
    """`facts` of the records that a batch brings (+1) and takes away (-1)."""
    out = added.withColumn("sign", F.lit(1).cast("bigint"))
    if removed is None:
        return out
    gone = removed.withColumn("sign", F.lit(-1).cast("bigint"))
    return out.unionByName(gone, allowMissingColumns=True)


def entries(rows: DataFrame) -> DataFrame:
    """Ledger rows of signed facts."""
    paths = [c[2:] for c in rows.columns if c.startswith("p:")]
    counted = rows.groupBy("county").agg(
        F.sum("sign").alias("total"),
        *[F.coalesce(F.sum(F.when(F.col(f"`{k}:{p}`"), F.col("sign"))), F.lit(0)).alias(f"{k}{i}") for i, p in enumerate(paths) for k in "pf"],
    )
    lines = F.array(*[F.struct(F.lit(p).alias("name"), F.col(f"p{i}").alias("present"), F.col(f"f{i}").alias("filled")) for i, p in enumerate(paths)])
    fields = counted.select("county", F.lit("field").alias("kind"), "total", F.inline(lines))
    values = rows.select("county", "sign", F.inline("dims")).groupBy("county", "name", "value").agg(F.sum("sign").alias("total")).filter("total <> 0")
    none = F.lit(None).cast("bigint")
    values = values.select("county", F.lit("dimension").alias("kind"), "name", "value", "total", none.alias("present"), none.alias("filled"))
    columns = [c.split()[0] for c in LEDGER_DDL.split(", ")]
    return fields.withColumn("value", F.lit(None).cast("string")).select(*columns).unionByName(values.select(*columns))


def gaps(rows: DataFrame) -> DataFrame:
    """Records that lack key fields, with what they lack; only those whose state changes."""
    by_record = rows.filter("missing <> ''").groupBy("county", "account_id", "missing")
    return by_record.agg(F.sum("sign").alias("change")).filter("change <> 0")


def summed(ledger: DataFrame) -> DataFrame:
    """One row per count; those that have come to nothing are left out."""
    sums = ledger.groupBy("county", "kind", "name", "value").agg(*[F.sum(c).alias(c) for c in ("total", "present", "filled")])
    return sums.filter("total <> 0")


def coverage(ledger: DataFrame, paths: list[str]) -> DataFrame:
    """Present and filled counts and rates per county and field, as `quality.field_coverage` gives them from records."""
    counts = summed(ledger.filter((F.col("kind") == "field") & F.col("name").isin(paths)))
    return counts.select(
        "county", F.col("name").alias("field"), "total", "present", F.col("filled").alias("non_empty"),
        quality.percent(F.col("present"), F.col("total")).alias("presence_rate"),
        quality.percent(F.col("filled"), F.col("total")).alias("quality_rate"),
    )


def distributions(ledger: DataFrame) -> DataFrame:
    """Count and percent of each value per county and dimension."""
    counts = summed(ledger.filter("kind = 'dimension'"))
    # one row per county: every record has one value in each dimension
    totals = coverage(ledger, ["account_id"]).select("county", F.col("total").alias("_all"))
    joined = counts.alias("c").join(totals.alias("t"), F.col("c.county").eqNullSafe(F.col("t.county")))
    return joined.select(
        "c.county", F.col("name").alias("dimension"), "value", F.col("total").alias("count"),
        quality.percent(F.col("total"), F.col("_all")).alias("percent"),
    )


def feature_presence(ledger: DataFrame, families: list[str]) -> DataFrame:
    """Whether any record of the county has entries in each child family."""
    has = {f: F.coalesce(F.bool_or((F.col("field") == f) & (F.col("non_empty") > 0)), F.lit(False)) for f in families}
    return coverage(ledger, families).groupBy("county").agg(*[c.alias(f"has_{f}") for f, c in has.items()])


def missing_records(gap_rows: DataFrame) -> DataFrame:
    """Records that lack key fields now, and the list of what each lacks."""
    now = gap_rows.groupBy("county", "account_id", "missing").agg(F.sum("change").alias("now")).filter("now > 0")
    return now.select("county", "account_id", F.split("missing", ",").alias("missing_fields"))

"""Delimited, JSON and Parquet sources, and the repair of malformed text files.

Files are read as text lines where rows may be malformed, and every repair is a column expression, so
a scan is one pass over splittable input with nothing copied to local disk.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from parcelmill.functions import casts, text
from parcelmill.sources.json_arrays import read_arrays

# Candidate delimiters in order of preference, and the one for a file without any.
DELIMITERS = [",", "\t", "|", ";"]
DEFAULT_DELIMITER = "\t"

# Forms that are taken as a date, year first or day first. Month-first files name their form.
DATE_FORMS = ("yyyy-MM-dd", "yyyy/MM/dd", "dd-MM-yyyy", "dd/MM/yyyy")

# Parse-loss limits.
STOP_LOSS = 0.05
EXCELLENT_LOSS = 0.02
GOOD_LOSS = 0.10


def string_schema(columns: list[str]) -> StructType:
    return StructType([StructField(c, StringType()) for c in columns])


def file_position() -> Column:
    """Place of a row in the files that are scanned: file, start of its split, order in the split.

    A split is read by one task from its first row to its last, so places order as the file does. Places are
    compared, never computed with.
    """
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
    )


def _positioned(scan: DataFrame, position: str | None) -> DataFrame:
    return scan if position is None else scan.select("*", file_position().alias(position))


def read_lines(spark: SparkSession, path: str, position: str | None = "source_pos", **options: str) -> DataFrame:
    """Lines (`value`) of text files, with their place in the column `position` (None: without)."""
    return _positioned(spark.read.options(**options).text(path), position)


def read_strings(
    spark: SparkSession, path: str, columns: list[str], sep: str = ",", position: str | None = None, **options: str
) -> DataFrame:
    """All columns as text; nothing is inferred, so the file is read once. `position`: a column for each row's
    place, which first- and last-wins rules need."""
    reader = spark.read.schema(string_schema(columns)).option("header", True).option("sep", sep)
    for key, value in options.items():
        reader = reader.option(key, value)
    return _positioned(reader.csv(path), position)


def read_delimited(
    spark: SparkSession, path: str, types: dict[str, str], sep: str = "\t", position: str | None = None,
    date_forms: tuple[str, ...] = DATE_FORMS,
) -> DataFrame:
    """Text columns with null tokens removed and the declared types applied."""
    return apply_types(read_strings(spark, path, list(types), sep, position), types, date_forms)


def apply_types(df: DataFrame, types: dict[str, str], date_forms: tuple[str, ...] = DATE_FORMS) -> DataFrame:
    """Declared types over text columns; a cell that does not parse is null. Other columns stay."""

    def typed(name: str, sql_type: str) -> Column:
        cell = text.tokens_to_null(F.col(name))
        if sql_type == "string":
            return cell
        if sql_type == "date":
            return F.coalesce(*[F.try_to_date(cell, form) for form in date_forms])
        if sql_type == "timestamp":
            return F.try_to_timestamp(cell)
        return casts.number_or_null(cell, sql_type)

    others = [c for c in df.columns if c not in types]
    return df.select(*[typed(n, t).alias(n) for n, t in types.items()], *others)


def read_quote_blind(
    spark: SparkSession, path: str, columns: list[str], sep: str = "\t", position: str | None = None
) -> DataFrame:
    """Quotes are data: rows with stray quotes stay whole, malformed rows keep their raw text."""
    schema = string_schema([*columns, "_corrupt"])
    scan = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt")
        .csv(path)
    )
    return _positioned(scan, position)


def strip_description(c: Column) -> Column:
    return text.strip(F.btrim(c, F.lit(text.WHITE_SPACE + '"')))


def delimiter_counts(lines: DataFrame, group: Column) -> DataFrame:
    """Occurrences of each candidate delimiter per file."""
    counts = [
        F.sum(F.length("value") - F.length(F.replace("value", F.lit(d), F.lit("")))).alias(f"d{i}")
        for i, d in enumerate(DELIMITERS)
    ]
    return lines.groupBy(group.alias("file")).agg(*counts)


def detect_delimiters(lines: DataFrame, group: Column) -> DataFrame:
    """Most frequent delimiter per file; a file without any is taken as tab-delimited."""
    counts = delimiter_counts(lines, group)
    hits = [F.col(f"d{i}") for i in range(len(DELIMITERS))]
    best = F.greatest(*hits)
    choice = F.when(best == 0, F.lit(DEFAULT_DELIMITER))
    for delimiter, hit in zip(DELIMITERS, hits):
        choice = choice.when(hit == best, F.lit(delimiter))
    return counts.select("file", choice.alias("delimiter"), best.alias("hits"))


def non_blank_lines(lines: DataFrame) -> DataFrame:
    """Lines with content; the text source already splits on CRLF, CR and LF."""
    return lines.filter(text.strip(F.col("value")) != "")


def repaired_encoding(c: Column) -> Column:
    """Lines that are not valid UTF-8 are read as Latin-1; replacement characters become blanks."""
    decoded = F.when(F.is_valid_utf8(c), c).otherwise(F.decode(c.cast("binary"), "ISO-8859-1"))
    return F.replace(decoded, F.lit("�"), F.lit(" "))


def repair_ragged(
    lines: DataFrame, columns: list[str], sep: str = "\t", drop_empty_extra: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(`good`, `rejects`): exact rows, rows one field short, and rows with one empty extra field.

    The extra field is accepted only with `drop_empty_extra` (account files). Other columns of `lines` stay.
    """
    n = len(columns)
    others = [c for c in lines.columns if c != "value"]
    cells = lines.select("*", F.split("value", _quoted(sep), -1).alias("_cells"))
    size = F.size("_cells")
    extra = (size == n + 1) & (F.try_element_at("_cells", F.lit(n + 1)) == "")
    fits = (size == n) | (size == n - 1)
    if drop_empty_extra:
        fits = fits | extra
    good = cells.filter(fits).select(
        *[
            F.coalesce(F.get("_cells", F.lit(i)), F.lit("")).alias(c)
            for i, c in enumerate(columns)
        ],
        *others,
    )
    rejects = cells.filter(~fits).select("value", size.alias("fields"), *others)
    return good, rejects


def _quoted(sep: str) -> str:
    return {"\t": r"\t", "|": r"\|"}.get(sep, sep)


@dataclass(frozen=True)
class Strategy:
    name: str
    parses: Column


def tab_strategies(n: int) -> list[Strategy]:
    """Ways to read a tab-delimited line of `n` fields, from strict to tolerant."""
    tabs = F.size(F.split("value", r"\t", -1))
    even_quotes = F.pmod(F.length(F.regexp_replace("value", '[^"]', "")), F.lit(2)) == 0
    return [
        Strategy("quoted", (tabs == n) & even_quotes),
        Strategy("quote_blind", tabs == n),
        Strategy("one_short_allowed", tabs.isin(n, n - 1)),
    ]


def parse_quality(lines: DataFrame, strategies: list[Strategy]) -> DataFrame:
    """Rows and loss per strategy, the chosen one marked: the first under 5 % loss, else the best."""
    sums = [F.count_if(s.parses).alias(s.name) for s in strategies]
    totals = lines.agg(F.count(F.lit(1)).alias("expected"), *sums)
    long = totals.unpivot("expected", [s.name for s in strategies], "strategy", "parsed")
    rank = F.element_at(
        F.create_map(*[x for i, s in enumerate(strategies) for x in (F.lit(s.name), F.lit(i))]),
        F.col("strategy"),
    )
    loss = F.coalesce(
        F.try_divide((F.col("expected") - F.col("parsed")).cast("double"), F.col("expected")),
        F.lit(0.0),
    )
    scored = long.withColumns({"rank": rank, "loss": loss})
    # one row per strategy: the choice is a small aggregate over these rows
    order = F.when(F.col("loss") < STOP_LOSS, F.col("rank").cast("double")).otherwise(
        F.col("loss") + len(strategies)
    )
    chosen = scored.agg(F.min_by("strategy", F.struct(order, F.col("rank")))).scalar()
    grade = (
        F.when(F.col("loss") < EXCELLENT_LOSS, "Excellent")
        .when(F.col("loss") < GOOD_LOSS, "Good")
        .otherwise("Poor")
    )
    return scored.select(
        "strategy",
        "expected",
        "parsed",
        "loss",
        grade.alias("grade"),
        (F.col("strategy") == chosen).alias("chosen"),
    )


def read_json_records(
    spark: SparkSession, path: str, schema: StructType, array_file: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(`records`, `corrupt`) of a JSON-lines folder, or of files that hold one array each.

    An array file is cut into its elements by many tasks (see `json_arrays`).
    """
    if array_file:
        return read_arrays(spark, path, schema)
    with_corrupt = StructType([*schema.fields, StructField("_corrupt", StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = spark.read.text(path)
    parsed = lines.select(F.from_json("value", with_corrupt, options).alias("r"))
    bad = F.col("r._corrupt").isNotNull()
    records = parsed.filter(~bad).select(*[F.col(f"r.{f.name}") for f in schema])
    return records, parsed.filter(bad).select("r._corrupt")


def sniff_format(path: str) -> str:
    """Reader name by file extension: parquet, json, csv (comma) or text-like (tab)."""
    name = path.rstrip("/").lower()
    for suffix, kind in ((".parquet", "parquet"), (".json", "json"), (".csv", "csv")):
        if name.endswith(suffix):
            return kind
    return "tab"


def first_rows(spark: SparkSession, path: str, columns: list[str], n: int | None) -> DataFrame:
    """First `n` rows (None: all) by the sniffed format, every column as text where the file has no types."""
    kind = sniff_format(path)
    if kind == "parquet":
        rows = _positioned(spark.read.parquet(path).select(*columns, "_metadata"), "_place")
    elif kind == "json":
        rows = _positioned(spark.read.schema(string_schema(columns)).json(path), "_place")
    else:
        rows = read_strings(spark, path, columns, "," if kind == "csv" else "\t", position="_place")
    # Spark reads large files first: the first rows are those that stand first
    return (rows if n is None else rows.orderBy("_place").limit(n)).select(*columns)

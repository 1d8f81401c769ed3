"""Fixed-width record layouts and their typed projection.

Lines come from `spark.read.text` and are cut with `substring`, so the scan stays in generated code.
Lines are never stripped before cutting; a field that ends beyond the line is null.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.dates import date_text
from parcelmill.functions.text import strip

SHORTEST_LINE = 100
BILLIONTHS = 1_000_000_000


@dataclass(frozen=True)
class Field:
    name: str
    start: int
    end: int
    kind: str = "text"  # text | whole | money | rate | hundredths | date


@dataclass(frozen=True)
class Layout:
    name: str
    key: str
    fields: tuple[Field, ...]


# Name, start, end (0-based, end exclusive) and kind of every field.
PROP = Layout(
    "prop",
    "account_id",
    (
        Field("account_id", 0, 12),
        Field("property_type", 12, 13),
        Field("tax_year", 17, 22),
        Field("geo_id", 550, 570),
        Field("owner_id", 580, 592),
        Field("owner_name", 608, 660),
        Field("owner_address", 693, 743),
        Field("owner_address2", 743, 793),
        Field("owner_city", 873, 923),
        Field("owner_state", 923, 926),
        Field("owner_zip", 978, 988),
        Field("property_street_name", 1049, 1080),
        Field("property_street_type", 1099, 1120),
        Field("property_zip", 1138, 1148),
        Field("legal_description", 1150, 1250),
        Field("map_reference", 1680, 1720),
        Field("property_class", 1720, 1750),
        Field("assessed_value_1", 1820, 1835, "money"),
        Field("land_value", 1835, 1850, "money"),
        Field("improvement_value", 1850, 1865, "money"),
        Field("market_value", 1923, 1938, "money"),
        Field("appraised_value", 1938, 1953, "money"),
        Field("assessment_date", 2000, 2010, "date"),
        Field("exemption_codes", 2100, 2130),
        Field("deed_info", 2200, 2250),
        Field("property_city", 3455, 3475),
    ),
)
PROP_ENT = Layout(
    "prop_ent",
    "account_id",
    (
        Field("account_id", 0, 12),
        Field("tax_year", 12, 16, "whole"),
        Field("jurisdiction_id", 50, 62),
        Field("entity_type", 62, 72),
        Field("entity_name", 63, 143),
        Field("entity_assessed_value", 200, 215, "money"),
        Field("entity_market_value", 300, 315, "money"),
        Field("entity_taxable_value", 400, 415, "money"),
        Field("prior_year_value", 500, 515, "money"),
        Field("tax_rate", 1000, 1010, "rate"),
        Field("tax_amount", 1100, 1115, "money"),
        Field("exemption_amount", 1200, 1215, "money"),
    ),
)
IMPROVEMENT = Layout(
    "improvement",
    "account_id",
    (
        Field("account_id", 0, 12),
        Field("improvement_id", 12, 22),
        Field("improvement_type", 22, 42),
        Field("improvement_class", 42, 62),
        Field("year_built", 62, 66, "whole"),
        Field("square_footage", 66, 76, "whole"),
        Field("value", 76, 86, "whole"),
        Field("description", 86, 136),
    ),
)
LAND = Layout(
    "land",
    "account_id",
    (
        Field("account_id", 0, 12),
        Field("land_id", 12, 22),
        Field("land_type", 22, 42),
        Field("land_description", 42, 92),
        Field("land_class", 92, 112),
        Field("land_area", 112, 122, "whole"),
        Field("land_value", 122, 132, "money"),
    ),
)
AGENT = Layout(
    "agent",
    "agent_id",
    (
        Field("agent_id", 0, 12),
        Field("agent_name", 12, 72),
        Field("agent_address", 72, 142),
        Field("agent_city", 142, 162),
        Field("agent_state", 162, 165),
        Field("agent_zip", 165, 175),
    ),
)
SUBDIVISION = Layout(
    "subdivision",
    "subdivision_id",
    (
        Field("subdivision_id", 0, 12),
        Field("subdivision_name", 12, 62),
        Field("subdivision_type", 62, 82),
        Field("city", 82, 112),
        Field("county", 112, 132),
    ),
)
SIDE_LAYOUTS = (IMPROVEMENT, LAND, AGENT, SUBDIVISION)


def cut_field(line: Column, field: Field) -> Column:
    """Trimmed text of a field; null when the line ends before the field does."""
    value = strip(line.substr(field.start + 1, field.end - field.start))
    return F.when(F.length(line) >= field.end, value)


def _cut_measured(field: Field, line: str) -> Column:
    """`cut_field` of a line whose length is `_length` and whose bytes, if each is a character, are `_bytes`.

    Characters are counted from the beginning of a line for each field; bytes are not.
    """
    size = field.end - field.start
    from_bytes = F.substring("_bytes", field.start + 1, size).cast("string")
    value = F.coalesce(from_bytes, F.col(line).substr(field.start + 1, size))
    return F.when(F.col("_length") >= field.end, strip(value))


def _all_zero(value: Column) -> Column:
    """True for blank and for zeros only: both mean that the field is not filled."""
    return F.ltrim(value, F.lit("0")) == ""


def _typed(value: Column, field: Field) -> Column:
    digits = min(field.end - field.start, 38)
    if field.kind in ("whole", "money"):
        whole = F.when(value.rlike(r"^\d+$"), value).try_cast(f"decimal({digits},0)")
        whole = F.coalesce(whole, F.lit(0))
        if field.kind == "whole":
            return whole.try_cast("bigint")
        return (whole / F.lit(BILLIONTHS)).try_cast("decimal(18,2)")
    if field.kind in ("rate", "hundredths"):
        number = F.when(value.rlike(r"^\d*\.?\d*$"), value).try_cast("double")
        scale = float(BILLIONTHS) if field.kind == "rate" else 100.0
        return F.coalesce(number, F.lit(0.0)) / F.lit(scale)
    return date_text(value) if field.kind == "date" else value


def _key_field(layout: Layout) -> Field:
    return next(f for f in layout.fields if f.name == layout.key)


def line_status(layout: Layout, line: str = "value") -> Column:
    """`ok`, `short` (line below the minimum) or `no_key` (key field blank)."""
    key = cut_field(F.col(line), _key_field(layout))
    no_key = F.coalesce(F.ltrim(key, F.lit("0")), F.lit("")) == ""  # a filter works the key out anew for each mention
    return F.when(F.length(line) < SHORTEST_LINE, "short").when(no_key, "no_key").otherwise("ok")


def project_fields(
    df: DataFrame,
    layout: Layout,
    keep: list[str] | None = None,
    line: str = "value",
    usable_only: bool = True,
) -> DataFrame:
    """Typed columns of all usable lines, or of every line.

    Measuring, cutting, null rule and typing are separate projections: each text is cut once and the
    generated code stays small.
    """
    keep = keep or []
    usable = df.filter(line_status(layout, line) == "ok") if usable_only else df
    length = F.length(line)
    single = F.when(length == F.octet_length(line), F.col(line).cast("binary"))
    measured = usable.select(*dict.fromkeys([*keep, line]), length.alias("_length"), single.alias("_bytes"))
    cut = measured.select(*keep, *[_cut_measured(f, line).alias(f.name) for f in layout.fields])
    filled = cut.select(
        *keep,
        *[F.when(~_all_zero(F.col(f.name)), F.col(f.name)).alias(f.name) for f in layout.fields],
    )
    typed = [
        F.when(F.col(f.name).isNotNull(), _typed(F.col(f.name), f)).alias(f.name)
        if f.kind != "text"
        else F.col(f.name)
        for f in layout.fields
    ]
    return filled.select(*keep, *typed)

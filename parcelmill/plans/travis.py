"""Travis: fixed-width files to unified records."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions.address import street_with_type
from parcelmill.functions.dates import tax_year
from parcelmill.functions.ids import account_id
from parcelmill.operators.joins import keep_keys_of, lookup_join
from parcelmill.operators.keyed import last_per_key
from parcelmill.operators.nesting import Nested, attach, nest_children
from parcelmill.plans.columns import struct_of
from parcelmill.schemas import conform, section
from parcelmill.sources.fixed_width import (
    AGENT,
    IMPROVEMENT,
    LAND,
    PROP,
    PROP_ENT,
    SUBDIVISION,
    line_status,
    project_fields,
)

COUNTY = "travis"
KEY = "account_id"


@dataclass(frozen=True)
class TravisFiles:
    """Raw lines (`value`) of each file, with their order in the file (`source_pos`)."""

    properties: DataFrame
    entities: DataFrame | None = None
    improvements: DataFrame | None = None
    land: DataFrame | None = None
    agents: DataFrame | None = None
    subdivisions: DataFrame | None = None


def keyed_rows(lines: DataFrame, layout) -> DataFrame:
    rows = project_fields(lines, layout, keep=["source_pos"])
    return rows.withColumn(KEY, account_id(F.col(KEY), COUNTY))


def properties(lines: DataFrame) -> DataFrame:
    """Typed property rows, one per account: the last line of an account wins."""
    return last_per_key(keyed_rows(lines, PROP), [KEY], "source_pos")


def first_properties(lines: DataFrame, n: int) -> DataFrame:
    """The first `n` distinct accounts of the file, in file order."""
    keys = keyed_rows(lines, PROP).groupBy(KEY).agg(F.min("source_pos").alias("first_pos"))
    return keys.orderBy("first_pos").limit(n)


def lines_of(lines: DataFrame, selected: DataFrame) -> DataFrame:
    """Raw lines of the selected accounts; only the key is cut before the join."""
    with_key = lines.withColumn(KEY, account_id(F.trim(F.col("value").substr(1, 12)), COUNTY))
    return keep_keys_of(with_key, selected, KEY).drop(KEY)


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("decimal(18,2)"))


def nest_entities(lines: DataFrame) -> Nested:
    item = section(
        "tax_entities",
        entity_name=F.col("entity_name"),
        entity_type=F.col("entity_type"),
        jurisdiction_id=F.col("jurisdiction_id"),
        assessed_value=_or_zero("entity_assessed_value"),
        market_value=_or_zero("entity_market_value"),
        taxable_value=_or_zero("entity_taxable_value"),
        tax_rate=F.coalesce("tax_rate", F.lit(0.0)),
        tax_amount=_or_zero("tax_amount"),
        exemption_amount=_or_zero("exemption_amount"),
    )
    order = [F.col("source_pos")]
    return nest_children(keyed_rows(lines, PROP_ENT), KEY, order, item)


def nest_improvements(lines: DataFrame) -> Nested:
    item = section("improvements", **{f.name: F.col(f.name) for f in IMPROVEMENT.fields[1:]})
    order = [F.col("source_pos")]
    return nest_children(keyed_rows(lines, IMPROVEMENT), KEY, order, item)


def nest_land(lines: DataFrame) -> Nested:
    item = section("land_details", **{f.name: F.col(f.name) for f in LAND.fields[1:]})
    return nest_children(keyed_rows(lines, LAND), KEY, [F.col("source_pos")], item)


def subdivision_codes(lines: DataFrame) -> DataFrame:
    """One row per subdivision code: the last line of a code wins."""
    rows = project_fields(lines, SUBDIVISION, keep=["source_pos"])
    return last_per_key(rows, ["subdivision_id"], "source_pos").drop("source_pos")


def with_subdivision(df: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Subdivision struct of the code column `key`; null where the code is unknown."""
    structs = subdivision_codes(lines).select(
        F.col("subdivision_id").alias("_subdivision"),
        section("subdivision", **{f.name: F.col(f.name) for f in SUBDIVISION.fields}).alias("subdivision"),
    )
    return lookup_join(df, structs, key, "_subdivision")


def agents(lines: DataFrame) -> DataFrame:
    """The agent reference table; agents belong to no single property."""
    return project_fields(lines, AGENT)


def base_record() -> dict[str, Column]:
    state = F.lit("TX")
    return {
        "county": F.lit(COUNTY),
        "year": tax_year(F.col("tax_year")),
        "property_address": section(
            "property_address",
            street_address=street_with_type(
                F.col("property_street_name"), F.col("property_street_type")
            ),
            city=F.col("property_city"),
            state=state,
            zip_code=F.col("property_zip"),
        ),
        "mailing_address": section(
            "mailing_address",
            name=F.col("owner_name"),
            address_line_1=F.col("owner_address"),
            address_line_2=F.col("owner_address2"),
            city=F.col("owner_city"),
            state=F.col("owner_state"),
            zip_code=F.col("owner_zip"),
        ),
        "property_details": section(
            "property_details",
            property_type=F.col("property_type"),
            property_class=F.col("property_class"),
            legal_description=F.col("legal_description"),
            map_reference=F.col("map_reference"),
            geo_id=F.col("geo_id"),
            owner_id=F.col("owner_id"),
        ),
        "valuation": section(
            "valuation",
            land_value=_or_zero("land_value"),
            improvement_value=_or_zero("improvement_value"),
            assessed_value=_or_zero("assessed_value_1"),
            market_value=_or_zero("market_value"),
            appraised_value=_or_zero("appraised_value"),
        ),
        "legal_status": section(
            "legal_status",
            assessment_date=F.col("assessment_date"),
            deed_info=F.col("deed_info"),
            exemption_codes=F.col("exemption_codes"),
        ),
        "owners": F.array_compact(
            F.array(
                F.when(
                    F.col("owner_name").isNotNull(),
                    section(
                        "owners",
                        name=F.col("owner_name"),
                        owner_id=F.col("owner_id"),
                        owner_type=F.lit("primary"),
                        percentage=F.lit(100),
                    ),
                )
            )
        ),
    }


def property_records(lines: DataFrame) -> DataFrame:
    """All parts of the record that come from the property line alone."""
    rows = properties(lines)
    sections = [c.alias(n) for n, c in base_record().items()]
    # columns that later steps may use as lookup keys stay until the final cast
    return rows.select(KEY, "map_reference", *sections)


def children(files: TravisFiles) -> dict[str, Nested]:
    builders = {
        "tax_entities": (files.entities, nest_entities),
        "improvements": (files.improvements, nest_improvements),
        "land_details": (files.land, nest_land),
    }
    return {
        name: build(df) for name, (df, build) in builders.items() if df is not None
    }


def with_counts(records: DataFrame, n_agents: Column) -> DataFrame:
    """Number of entities, improvements, land rows and known agents per record."""
    counts = struct_of(
        entities=F.col("child_counts.tax_entities"),
        improvements=F.col("child_counts.improvements"),
        land=F.col("child_counts.land_details"),
        agents=n_agents,
    )
    metadata = section(
        "metadata",
        data_source=F.lit("travis_county_appraisal"),
        record_type=F.lit("property"),
        counts=counts,
    )
    return records.withColumn("metadata", metadata)


def unified_records(
    files: TravisFiles, subdivision_key: str = "map_reference", arrays: bool = True
) -> DataFrame:
    records = property_records(files.properties)
    nested = children(files)
    for name, n in nested.items():
        records = attach(records, n, name, arrays)
    if files.subdivisions is not None:
        records = with_subdivision(records, files.subdivisions, subdivision_key)
    records = conform(records)  # absent child families are empty arrays from here on
    if files.agents is None:
        n_agents = F.lit(0).cast("bigint")
    else:
        n_agents = agents(files.agents).agg(F.count(F.lit(1))).scalar()
    return conform(with_counts(records, n_agents))


def extraction_status(lines: DataFrame, layout) -> DataFrame:
    """Lines per outcome: ok, short (below the minimum length), no_key."""
    return lines.groupBy(line_status(layout).alias("status")).agg(F.count(F.lit(1)).alias("lines"))

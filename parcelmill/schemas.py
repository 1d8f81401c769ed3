"""Schema of the unified property record and the means to build records in that shape."""

from functools import cache

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

# Field names and types of the unified record.
PROPERTY_DDL = """
account_id string, county string, year int,
property_address struct<street_number string, street_prefix string, street_name string,
    street_suffix string, street_direction string, unit string, street_address string,
    full_address string, city string, state string, zip_code string>,
mailing_address struct<name string, care_of string, address_line_1 string, address_line_2 string,
    city string, state string, zip_code string, country string>,
property_details struct<year_improved int, year_annexed int, building_area bigint, land_area bigint,
    acreage decimal(18,4), school_district string, state_class string, economic_area string,
    economic_building_class string, center_code string, market_area_1 string,
    market_area_1_description string, market_area_2 string, market_area_2_description string,
    neighborhood_code string, neighborhood_group string,
    property_type string, property_class string, legal_description string, map_reference string,
    geo_id string, owner_id string,
    division_code string, business_name string, gis_parcel_id string, zoning string, year_built int,
    building_class string, living_area_sf bigint, main_area_sf bigint, num_stories string,
    num_bedrooms int, num_full_baths int, num_half_baths int, commercial_area_sf bigint,
    net_lease_area bigint, property_name string, property_quality string, property_condition string,
    commercial_year_built int, commercial_remodel_year int, commercial_stories int,
    commercial_num_units int, commercial_construction_type string, commercial_heating_type string,
    commercial_ac_type string, land_area_sf double, front_dimension double, depth_dimension double>,
valuation struct<land_value decimal(18,2), building_value decimal(18,2),
    improvement_value decimal(18,2), extra_features_value decimal(18,2),
    agricultural_value decimal(18,2), assessed_value decimal(18,2), appraised_value decimal(18,2),
    total_appraised_value decimal(18,2), market_value decimal(18,2),
    total_market_value decimal(18,2), total_value decimal(18,2), homestead_cap_value decimal(18,2),
    new_construction_value decimal(18,2), total_rcn_value decimal(18,2),
    prior_values struct<land decimal(18,2), building decimal(18,2), extra_features decimal(18,2),
        agricultural decimal(18,2), total_appraised decimal(18,2), total_market decimal(18,2)>,
    value_changes struct<
        land_change struct<dollar_change decimal(18,2), percent_change decimal(18,2)>,
        building_change struct<dollar_change decimal(18,2), percent_change decimal(18,2)>,
        total_market_change struct<dollar_change decimal(18,2), percent_change decimal(18,2)>>>,
legal_status struct<value_status string, noticed boolean, notice_date string, protested boolean,
    certified_date string, revision_date string, revision_by string, new_owner_date string,
    legal_description array<string>, jurisdictions string, assessment_date string, deed_info string,
    exemption_codes string, deed_transfer_date string, appraisal_method string>,
owners array<struct<line_number int, name string, aka string, owner_id string, owner_type string,
    percentage decimal(9,4)>>,
deeds array<struct<date_of_sale string, clerk_year string, clerk_id string, deed_id string>>,
permits array<struct<permit_id string, agency_id string, status string, description string,
    dor_code string, permit_type string, permit_type_description string, property_type string,
    issue_date string, year string, site_address struct<site_number string, site_prefix string,
    site_street string, site_type string, site_suffix string, site_apartment string>>>,
tax_entities array<struct<entity_name string, entity_type string, jurisdiction_id string,
    assessed_value decimal(18,2), market_value decimal(18,2), taxable_value decimal(18,2),
    tax_rate double, tax_amount decimal(18,2), exemption_amount decimal(18,2),
    split_percentage double, description string>>,
improvements array<struct<improvement_id string, improvement_type string, improvement_class string,
    year_built int, effective_year_built int, remodel_year int, square_footage bigint,
    total_area bigint, net_lease_area bigint, value decimal(18,2), description string,
    stories string, construction_type string, foundation_type string, foundation_area bigint,
    basement_desc string, basement_area bigint, heating_type string, ac_type string, bedrooms int,
    full_baths int, half_baths int, fireplaces int, kitchens int, wet_bars int, num_units int,
    property_name string, quality string, condition string,
    amenities struct<pool boolean, spa boolean, deck boolean, sprinkler boolean, sauna boolean>,
    exterior_features struct<fence_type string, exterior_wall string, basement string,
        roof_type string, roof_material string>,
    mobile_home_info struct<serial_number string, manufacturer string, length double, width double,
        space double>,
    completion struct<percent_complete double, depreciation_percent double, num_units int>,
    depreciation struct<physical double, functional double, external double, total double>>>,
land_details array<struct<land_id string, land_type string, land_description string,
    land_class string, land_area double, land_value decimal(18,2), acreage double,
    market_area string, market_area_description string, neighborhood_code string,
    neighborhood_group string, economic_area string, center_code string, zoning string,
    front_dimension double, depth_dimension double, area_size double, area_unit string,
    section_number string, sptd_code string, sptd_description string, pricing_method string,
    cost_per_unit double, market_adjustment double, agricultural_use boolean,
    agricultural_value decimal(18,2)>>,
neighborhood struct<group_code string, description string>,
mineral_rights struct<dor_code string, rail_lease_num string, interest_type string,
    interest_percent string>,
subdivision struct<subdivision_id string, subdivision_name string, subdivision_type string,
    city string, county string>,
parcel_relationships array<struct<account_id string, type string, description string,
    related_account_id string, percentage string>>,
child_counts struct<owners bigint, deeds bigint, permits bigint, tax_entities bigint,
    improvements bigint, land_details bigint, parcel_relationships bigint>,
metadata struct<batch_id string, data_source string, record_type string, version string,
    ingestion_type string, created_at timestamp, updated_at timestamp, source_files array<string>,
    counts struct<entities bigint, improvements bigint, land bigint, agents bigint>>
"""


@cache
def property_schema() -> StructType:
    """The unified record as a StructType; needs a running session to parse the text."""
    return StructType.fromDDL(PROPERTY_DDL)


_NULLS: dict[tuple, Column] = {}


def _typed_null(name: str, kind: DataType) -> Column:
    """Named null of a type, made once per context: records have many absent fields."""
    key = (id(SparkContext._active_spark_context), name, kind.simpleString())
    if key not in _NULLS:
        _NULLS[key] = F.lit(None).cast(kind).alias(name)
    return _NULLS[key]


def _filled(fields: StructType, parts: dict[str, Column]) -> Column:
    unknown = set(parts) - set(fields.names)
    if unknown:
        raise ValueError(f"not in the schema: {sorted(unknown)}")
    out = []
    for field in fields:
        c = parts.get(field.name)
        if c is None:
            out.append(_typed_null(field.name, field.dataType))
            continue
        nested = isinstance(field.dataType, (StructType, ArrayType))
        out.append((c if nested else c.cast(field.dataType)).alias(field.name))
    return F.struct(*out)


def section(name: str, /, **parts: Column) -> Column:
    """The struct section `name` in its full shape; parts that are not given are null."""
    kind = property_schema()[name].dataType
    return _filled(kind.elementType if isinstance(kind, ArrayType) else kind, parts)


def conform(df: DataFrame) -> DataFrame:
    """`df` with exactly the columns of the unified record.

    Sections must already have their full shape (see `section`); absent ones become null, absent
    arrays empty. `child_counts` takes the `<array>_count` columns where they exist, else the array
    sizes.
    """
    have = {f.name: f.dataType for f in df.schema}
    out = []
    for field in property_schema():
        if field.name == "child_counts" and field.name not in have:
            out.append(_child_counts(field.dataType, have).alias(field.name))
            continue
        want = field.dataType
        if field.name not in have:
            c = _typed_null(field.name, want)
        elif have[field.name].simpleString() == want.simpleString():
            c = F.col(field.name)
        elif isinstance(want, (StructType, ArrayType)):
            raise ValueError(f"section {field.name} is {have[field.name].simpleString()}")
        else:
            c = F.col(field.name).cast(want)
        if isinstance(want, ArrayType):
            c = F.coalesce(c, F.array().cast(want))
        out.append(c.alias(field.name))
    return df.select(*out)


def _child_counts(kind: StructType, have: dict[str, DataType]) -> Column:
    counts = []
    for family in kind.names:
        if f"{family}_count" in have:
            c = F.col(f"{family}_count")
        else:
            c = F.size(family) if family in have else F.lit(0)
        counts.append(c.cast("bigint").alias(family))
    return F.struct(*counts)

"""Harris: delimited account file plus child files to unified records."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions import text
from parcelmill.functions.ids import account_id
from parcelmill.functions.values import value_change
from parcelmill.operators.joins import join_parts, lookup_join
from parcelmill.operators.keyed import last_per_key, split_by_id
from parcelmill.operators.nesting import Nested, attach, nest_children
from parcelmill.plans.columns import Source, struct_of
from parcelmill.schemas import conform, section

COUNTY = "harris"
KEY = "account_id"


@dataclass(frozen=True)
class HarrisFiles:
    accounts: DataFrame
    owners: DataFrame | None = None
    deeds: DataFrame | None = None
    permits: DataFrame | None = None
    minerals: DataFrame | None = None
    relations: DataFrame | None = None
    neighborhoods: DataFrame | None = None


def keyed(df: DataFrame) -> DataFrame:
    """Rows with an account id, and their key; `split_by_id` has the others."""
    return split_by_id(df, "acct")[0].withColumn(KEY, account_id(F.col("acct"), COUNTY))


def with_position(df: DataFrame, position: str = "source_pos") -> DataFrame:
    """Row order within the source; a frame without one is ordered by its fields."""
    return df if position in df.columns else df.withColumn(position, F.struct(*df.columns))


def nest_owners(owners: DataFrame) -> Nested:
    s = Source(owners)
    line = F.col("ln_num").cast("int")
    item = section(
        "owners",
        line_number=line,
        name=s.raw("name"),
        aka=s.raw("aka"),
        percentage=s.raw("pct_own").try_cast("decimal(9,4)"),
    )
    return nest_children(keyed(owners), KEY, [line, s.raw("name"), s.raw("aka")], item)


def nest_deeds(deeds: DataFrame) -> Nested:
    s = Source(deeds)
    sold = F.try_to_date(s.raw("dos"), "MM/dd/yyyy")
    item = section(
        "deeds",
        date_of_sale=s.raw("dos"),
        clerk_year=s.raw("clerk_yr"),
        clerk_id=s.raw("clerk_id"),
        deed_id=s.raw("deed_id"),
    )
    return nest_children(keyed(deeds), KEY, [sold, s.raw("deed_id")], item)


def nest_permits(permits: DataFrame) -> Nested:
    s = Source(permits)
    item = section(
        "permits",
        permit_id=s.raw("id"),
        agency_id=s.raw("agency_id"),
        status=s.raw("status"),
        description=F.regexp_replace(s.raw("dscr"), r'^[\s"]+|[\s"]+$', ""),
        dor_code=s.raw("dor_cd"),
        permit_type=s.raw("permit_type"),
        permit_type_description=s.raw("permit_tp_descr"),
        property_type=s.raw("property_tp"),
        issue_date=s.raw("issue_date"),
        year=s.raw("yr"),
        site_address=struct_of(
            site_number=s.raw("site_num"),
            site_prefix=s.raw("site_pfx"),
            site_street=s.raw("site_str"),
            site_type=s.raw("site_tp"),
            site_suffix=s.raw("site_sfx"),
            site_apartment=s.raw("site_apt"),
        ),
    )
    return nest_children(keyed(permits), KEY, [s.raw("yr"), s.raw("id")], item)


def nest_relations(relations: DataFrame) -> Nested:
    s = Source(relations)
    item = section(
        "parcel_relationships",
        account_id=s.raw("acct"),
        type=s.raw("tp"),
        description=s.raw("dscr"),
        related_account_id=s.raw("related_acct"),
        percentage=s.raw("pct"),
    )
    order = [s.raw("related_acct"), s.raw("tp"), s.raw("pct")]
    return nest_children(keyed(relations), KEY, order, item)


def mineral_struct(minerals: DataFrame) -> DataFrame:
    """One mineral-rights struct per account: the last row of the file wins."""
    s = Source(minerals)
    last = last_per_key(keyed(with_position(minerals)), [KEY], "source_pos")
    return last.select(
        KEY,
        section(
            "mineral_rights",
            dor_code=s.raw("dor_cd"),
            rail_lease_num=s.raw("rail_leasenum"),
            interest_type=s.raw("type_interest"),
            interest_percent=s.raw("interest_percent"),
        ).alias("mineral_rights"),
    )


def neighborhood_struct(df: DataFrame, codes: DataFrame, key: str = "market_area_1") -> DataFrame:
    """Neighbourhood of the code column `key`; the last row of a repeated code wins."""
    latest = last_per_key(with_position(codes), ["cd"], "source_pos")
    structs = latest.select(
        "cd",
        section(
            "neighborhood", group_code=F.col("grp_cd"), description=F.col("dscr")
        ).alias("neighborhood"),
    )
    return lookup_join(df, structs, key, "cd")


def tax_entities(s: Source, legacy_split: bool = False) -> Column:
    """School, county, city and one entity per listed jurisdiction, in that order."""
    school, city = s.filled("school_dist"), s.filled("site_addr_2")
    separator = "," if legacy_split else r"[,\s]+"
    listed = F.filter(
        F.transform(F.split(F.coalesce(s.filled("jurs"), F.lit("")), separator), text.strip),
        lambda x: x != "",
    )

    def entity(name: Column, kind: str, code: Column, description: str) -> Column:
        return section(
            "tax_entities",
            entity_name=name,
            entity_type=F.lit(kind),
            jurisdiction_id=code,
            assessed_value=s.money("assessed_val"),
            market_value=s.money("tot_mkt_val"),
            taxable_value=s.money("assessed_val"),
            description=F.lit(description),
        )

    def code_of(c: Column) -> Column:
        return F.replace(F.upper(c), F.lit(" "), F.lit("_"))

    def when_set(c: Column, e: Column) -> Column:
        return F.when(c.isNotNull(), e)

    fixed = F.array(
        when_set(
            school,
            entity(F.concat(F.lit("School District "), school), "SCHOOL", school, "School District"),
        ),
        entity(F.lit("Harris County"), "COUNTY", F.lit("HARRIS"), "County Government"),
        when_set(
            city,
            entity(F.concat(F.lit("City of "), city), "CITY", code_of(city), "Municipal Government"),
        ),
    )
    jurisdictions = F.transform(
        listed,
        lambda j: entity(
            F.concat(F.lit("Jurisdiction: "), j), "JURISDICTION", code_of(j), "Special Jurisdiction"
        ),
    )
    return F.concat(F.array_compact(fixed), jurisdictions)


def improvements(s: Source, legacy_truthy: bool = False) -> Column:
    """Main building, extra features and agricultural improvement, where there is any."""
    year, area = s.integer("yr_impr"), s.whole("bld_ar")
    if legacy_truthy:
        any_main = (F.coalesce(s.raw("yr_impr"), F.lit("")) != "") | (
            F.coalesce(s.raw("bld_ar"), F.lit("")) != ""
        )
    else:
        any_main = (year > 0) | (area > 0)

    def item(suffix, kind, cls, value, description, **more: Column) -> Column:
        return section(
            "improvements",
            improvement_id=F.concat(F.col(KEY), F.lit(suffix)),
            improvement_type=F.lit(kind),
            improvement_class=cls,
            value=value,
            description=description,
            **more,
        )

    building_class = s.filled("econ_bld_class")
    main = item(
        "_MAIN",
        "Main Building",
        F.coalesce(building_class, F.lit("Building")),
        s.whole("bld_val"),
        F.concat(
            F.lit("Building - "),
            F.coalesce(building_class, F.lit("Structure")),
            F.lit(" - "),
            F.coalesce(s.filled("bld_ar"), F.lit("0")),
            F.lit(" sq ft"),
        ),
        year_built=year,
        square_footage=area,
    )
    extra, farm = s.whole("x_features_val"), s.whole("ag_val")
    return F.array_compact(
        F.array(
            F.when(any_main, main),
            F.when(
                extra > 0,
                item("_EXTRA", "Extra Features", F.lit("Features"), extra,
                     F.lit("Extra features and amenities")),
            ),
            F.when(
                farm > 0,
                item("_AG", "Agricultural", F.lit("Agricultural"), farm,
                     F.lit("Agricultural improvements and structures")),
            ),
        )
    )


def land_details(s: Source) -> Column:
    """The land row and, where an economic area is given, a row for it."""
    area_code, hood = s.filled("market_area_1"), s.filled("neighborhood_code")
    economic = s.filled("econ_area")
    land = section(
        "land_details",
        land_id=F.concat(F.col(KEY), F.lit("_LAND")),
        land_type=F.lit("LAND"),
        land_description=text.join_present(" ", *[s.raw(f"lgl_{i}") for i in range(1, 5)]),
        land_class=F.coalesce(s.filled("state_class"), F.lit("Unknown")),
        land_area=s.whole("land_ar").cast("double"),
        land_value=s.whole("land_val").cast("decimal(18,2)"),
        acreage=F.when(s.filled("acreage").isNotNull(), s.double("acreage")),
        market_area=area_code,
        market_area_description=F.when(area_code.isNotNull(), s.filled("market_area_1_dscr")),
        neighborhood_code=hood,
        neighborhood_group=F.when(hood.isNotNull(), s.filled("neighborhood_grp")),
    )
    zone = section(
        "land_details",
        land_id=F.concat(F.col(KEY), F.lit("_ECON")),
        land_type=F.lit("ECONOMIC_AREA"),
        land_description=F.concat(F.lit("Economic Area: "), economic),
        land_class=F.lit("Economic"),
        land_area=F.lit(0.0),
        land_value=F.lit(0),
        economic_area=economic,
        center_code=s.filled("center_code"),
    )
    return F.array_compact(F.array(land, F.when(economic.isNotNull(), zone)))


def base_record(s: Source) -> dict[str, Column]:
    """Scalar sections of the record from the account row."""
    site = s.raw("site_addr_1")
    return {
        "county": F.lit(COUNTY),
        "year": s.raw("yr").try_cast("int"),
        "property_address": section(
            "property_address",
            street_number=s.raw("str_num"),
            street_prefix=s.raw("str_pfx"),
            street_name=s.raw("str"),
            street_suffix=s.raw("str_sfx"),
            street_direction=s.raw("str_sfx_dir"),
            unit=s.raw("str_unit"),
            street_address=site,
            full_address=site,
            city=s.raw("site_addr_2"),
            zip_code=s.raw("site_addr_3"),
        ),
        "mailing_address": section(
            "mailing_address",
            name=s.raw("mailto"),
            address_line_1=s.raw("mail_addr_1"),
            address_line_2=s.raw("mail_addr_2"),
            city=s.raw("mail_city"),
            state=s.raw("mail_state"),
            zip_code=s.raw("mail_zip"),
            country=s.raw("mail_country"),
        ),
        "property_details": section(
            "property_details",
            year_improved=s.filled("yr_impr").try_cast("int"),
            year_annexed=s.filled("yr_annexed").try_cast("int"),
            building_area=s.money("bld_ar").cast("bigint"),
            land_area=s.money("land_ar").cast("bigint"),
            acreage=s.filled("acreage").try_cast("decimal(18,4)"),
            school_district=s.filled("school_dist"),
            state_class=s.raw("state_class"),
            economic_area=s.raw("econ_area"),
            economic_building_class=s.raw("econ_bld_class"),
            center_code=s.raw("center_code"),
            market_area_1=s.raw("market_area_1"),
            market_area_1_description=s.raw("market_area_1_dscr"),
            market_area_2=s.raw("market_area_2"),
            market_area_2_description=s.raw("market_area_2_dscr"),
            neighborhood_code=s.raw("neighborhood_code"),
            neighborhood_group=s.raw("neighborhood_grp"),
        ),
        "valuation": section(
            "valuation",
            land_value=s.money("land_val"),
            building_value=s.money("bld_val"),
            extra_features_value=s.money("x_features_val"),
            agricultural_value=s.money("ag_val"),
            assessed_value=s.money("assessed_val"),
            total_appraised_value=s.money("tot_appr_val"),
            market_value=s.money("tot_mkt_val"),
            total_market_value=s.money("tot_mkt_val"),
            new_construction_value=s.money("new_construction_val"),
            total_rcn_value=s.money("tot_rcn_val"),
            prior_values=struct_of(
                land=s.money("prior_land_val"),
                building=s.money("prior_bld_val"),
                extra_features=s.money("prior_x_features_val"),
                agricultural=s.money("prior_ag_val"),
                total_appraised=s.money("prior_tot_appr_val"),
                total_market=s.money("prior_tot_mkt_val"),
            ),
            value_changes=struct_of(
                land_change=value_change(s.raw("land_val"), s.raw("prior_land_val")),
                building_change=value_change(s.raw("bld_val"), s.raw("prior_bld_val")),
                total_market_change=value_change(s.raw("tot_mkt_val"), s.raw("prior_tot_mkt_val")),
            ),
        ),
        "legal_status": section(
            "legal_status",
            value_status=s.raw("value_status"),
            noticed=text.is_yes(F.upper(s.raw("noticed"))),
            notice_date=s.raw("notice_dt"),
            protested=text.is_yes(F.upper(s.raw("protested"))),
            certified_date=s.raw("certified_date"),
            revision_date=s.raw("rev_dt"),
            revision_by=s.raw("rev_by"),
            new_owner_date=s.raw("new_own_dt"),
            legal_description=F.array(*[s.raw(f"lgl_{i}") for i in range(1, 5)]),
            jurisdictions=s.raw("jurs"),
        ),
    }


def account_records(
    accounts: DataFrame, legacy_split: bool = False, legacy_truthy: bool = False
) -> DataFrame:
    """All parts of the record that come from the account row alone; no shuffle."""
    keyed_accounts = keyed(accounts)
    s = Source(keyed_accounts)
    sections = base_record(s) | {
        "tax_entities": tax_entities(s, legacy_split),
        "improvements": improvements(s, legacy_truthy),
        "land_details": land_details(s),
    }
    return keyed_accounts.select(
        KEY, "market_area_1", *[c.alias(n) for n, c in sections.items()]
    )


def children(files: HarrisFiles) -> dict[str, Nested]:
    """The nested child families of the files that are there."""
    builders = {
        "owners": (files.owners, nest_owners),
        "deeds": (files.deeds, nest_deeds),
        "permits": (files.permits, nest_permits),
        "parcel_relationships": (files.relations, nest_relations),
    }
    return {
        name: build(df) for name, (df, build) in builders.items() if df is not None
    }


def unified_records(
    files: HarrisFiles, legacy_split: bool = False, arrays: bool = True
) -> DataFrame:
    """Unified records with all their children, or (`arrays=False`) with the numbers of those that are rows of a file.

    `children(files)[..]` has the children as rows and as pages.
    """
    records = account_records(files.accounts, legacy_split)
    for name, nested in children(files).items():
        records = attach(records, nested, name, arrays)
    if files.minerals is not None:
        records = join_parts(records, mineral_struct(files.minerals), KEY)
    if files.neighborhoods is not None:
        records = neighborhood_struct(records, files.neighborhoods)
    return conform(records)

"""Dallas: relational CSV files to unified records."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmill.functions import casts, text
from parcelmill.functions.address import numbered_street
from parcelmill.functions.ids import account_id
from parcelmill.functions.values import acres_to_sq_ft, division_type
from parcelmill.operators.joins import join_parts
from parcelmill.operators.keyed import first_per_key, split_by_id
from parcelmill.operators.nesting import Nested, attach, nest_children
from parcelmill.plans.columns import Source, struct_of
from parcelmill.schemas import conform, section

COUNTY = "dallas"
KEY = "account_id"
TAX_YEAR = 2025

# Taxing bodies in output order, and the name of an empty one.
JURISDICTIONS = ["CITY", "COUNTY", "ISD", "HOSPITAL", "COLLEGE", "SPECIAL_DIST"]
UNASSIGNED = "UNASSIGNED"


@dataclass(frozen=True)
class DallasFiles:
    accounts: DataFrame
    appraisal: DataFrame | None = None
    owners: DataFrame | None = None
    residential: DataFrame | None = None
    commercial: DataFrame | None = None
    land: DataFrame | None = None


def keyed(df: DataFrame) -> DataFrame:
    """Rows with an account id, and their key; `split_by_id` has the others."""
    return split_by_id(df, "account_num")[0].withColumn(KEY, account_id(F.col("account_num"), COUNTY))


def first_row_struct(df: DataFrame, name: str) -> DataFrame:
    """The first row of each account as one struct column."""
    rows = first_per_key(keyed(df), [KEY], "source_pos")
    columns = [c for c in rows.columns if c not in (KEY, "account_num", "source_pos")]
    return rows.select(KEY, F.struct(*columns).alias(name))


class Part(Source):
    """Typed access to the fields of a nested struct that may be null as a whole."""

    def __init__(self, df: DataFrame, name: str):
        self.there = F.col(name).isNotNull() if name in df.columns else F.lit(False)
        fields = df.schema[name].dataType.names if name in df.columns else []
        self._known = {f.lower() for f in fields}
        self._name = name

    def raw(self, name: str) -> Column:
        if self.has(name):
            return F.col(f"{self._name}.{name}")
        return F.lit(None).cast("string")

    def when_there(self, c: Column) -> Column:
        return F.when(self.there, c)


def nest_owners(owners: DataFrame) -> Nested:
    """Additional owners with a name."""
    named = keyed(owners).filter(text.blank_to_null(F.col("owner_name")).isNotNull())
    share = casts.safe_double(F.col("ownership_pct"))
    item = section(
        "owners",
        name=text.strip(F.col("owner_name")),
        owner_type=F.lit("additional"),
        percentage=share,
    )
    return nest_children(named, KEY, [F.col("owner_name"), share], item)


def owner_share(owners: DataFrame) -> DataFrame:
    """Sum of all additional shares per account, rows without a name included."""
    total = F.sum(casts.safe_double(F.col("ownership_pct")).cast("decimal(18,4)"))
    return keyed(owners).groupBy(KEY).agg(total.alias("additional_pct"))


def primary_owner_name(s: Source) -> Column:
    return text.join_present(" ", s.raw("owner_name1"), s.raw("owner_name2"))


def primary_share(records: DataFrame, owners: DataFrame | None) -> DataFrame:
    """`_primary`: the primary owner with the share that the additional owners leave; null without a name."""
    share_left = F.lit(100).cast("decimal(9,4)")
    if owners is not None:
        records = join_parts(records, owner_share(owners), KEY)
        share_left = share_left - F.coalesce("additional_pct", F.lit(0).cast("decimal(18,4)"))
    primary = section(
        "owners",
        name=F.col("_primary_name"),
        owner_type=F.lit("primary"),
        percentage=share_left.try_cast("decimal(9,4)"),
    )
    out = records.withColumn("_primary", F.when(F.col("_primary_name") != "", primary))
    return out.drop("additional_pct") if owners is not None else out


def all_owners(files: "DallasFiles") -> Nested:
    """Owners as rows: the primary one of each account first, then the additional ones of known accounts."""
    rows = keyed(files.accounts)
    named = primary_share(rows.select(KEY, primary_owner_name(Source(rows)).alias("_primary_name")), files.owners)
    first = F.struct(F.lit(0).alias("o0"), F.lit(None).cast("string").alias("o1"), F.lit(None).cast("double").alias("o2"))
    owners = named.filter(F.col("_primary").isNotNull()).select(KEY, F.struct(first.alias("o"), F.col("_primary").alias("v")).alias("item"))
    if files.owners is None:
        return Nested(KEY, owners)
    order = F.struct(F.lit(1).alias("o0"), F.col("item.o.o0").alias("o1"), F.col("item.o.o1").alias("o2"))
    others = nest_owners(files.owners).rows.join(named.select(KEY), KEY, "left_semi")
    return Nested(KEY, owners.unionByName(others.select(KEY, F.struct(order.alias("o"), F.col("item.v").alias("v")).alias("item"))))


def with_owners(records: DataFrame, owners: DataFrame | None, arrays: bool = True) -> DataFrame:
    """Owner array: the primary owner, then the additional ones; without `arrays` only their number."""
    records = primary_share(records, owners)
    first = F.array_compact(F.array("_primary"))
    if owners is None:
        return records.withColumn("owners", first).drop("_primary")
    records = attach(records, nest_owners(owners), "_additional", arrays)
    count = F.size(first) + F.col("_additional_count")
    if arrays:
        records = records.withColumn("owners", F.concat(first, F.col("_additional")))
    return records.withColumn("owners_count", count).drop("_primary", "_additional", "_additional_count")


def tax_entities(a: Part) -> Column:
    """One entity per named taxing body; empty and unassigned ones are left out."""
    items = []
    for kind in JURISDICTIONS:
        name = a.filled(f"{kind}_juris_desc")
        item = section(
            "tax_entities",
            entity_name=name,
            entity_type=F.lit(kind),
            taxable_value=a.whole(f"{kind}_taxable_val"),
            split_percentage=a.double(f"{kind}_split_pct"),
        )
        items.append(F.when(name != UNASSIGNED, item))
    return F.array_compact(F.array(*items))


def improvements(s: Source, res: Part, com: Part) -> Column:
    """Main building, additional area, commercial building and building id, where given."""
    raw_id = s.raw("account_num")

    def item(suffix: Column, **parts: Column) -> Column:
        return section("improvements", improvement_id=F.concat(raw_id, suffix), **parts)

    money_zero = F.lit(0)
    main = item(
        F.lit("_MAIN"),
        improvement_type=F.lit("Main Building"),
        improvement_class=res.text("bldg_class_desc"),
        year_built=res.integer("yr_built"),
        effective_year_built=res.integer("eff_yr_built"),
        square_footage=res.whole("tot_living_area_sf"),
        total_area=res.whole("tot_main_sf"),
        stories=res.text("num_stories_desc"),
        construction_type=res.text("constr_fram_typ_desc"),
        foundation_type=res.text("foundation_typ_desc"),
        heating_type=res.text("heating_typ_desc"),
        ac_type=res.text("ac_typ_desc"),
        bedrooms=res.integer("num_bedrooms"),
        full_baths=res.integer("num_full_baths"),
        half_baths=res.integer("num_half_baths"),
        fireplaces=res.integer("num_fireplaces"),
        kitchens=res.integer("num_kitchens"),
        wet_bars=res.integer("num_wet_bars"),
        amenities=struct_of(
            pool=res.yes("pool_ind"),
            spa=res.yes("spa_ind"),
            deck=res.yes("deck_ind"),
            sprinkler=res.yes("sprinkler_sys_ind"),
            sauna=res.yes("sauna_ind"),
        ),
        exterior_features=struct_of(
            fence_type=res.text("fence_typ_desc"),
            exterior_wall=res.text("ext_wall_desc"),
            basement=res.text("basement_desc"),
            roof_type=res.text("roof_typ_desc"),
            roof_material=res.text("roof_mat_desc"),
        ),
        mobile_home_info=struct_of(
            serial_number=res.text("mbl_home_ser_num"),
            manufacturer=res.text("mbl_home_manufctr"),
            length=res.double("mbl_home_length"),
            width=res.double("mbl_home_width"),
            space=res.double("mbl_home_space"),
        ),
        completion=struct_of(
            percent_complete=res.double("pct_complete"),
            depreciation_percent=res.double("depreciation_pct"),
            num_units=F.coalesce(
                casts.number_or_null(res.raw("num_units"), "int"),
                F.lit(0) if res.has("num_units") else F.lit(1),
            ),
        ),
        value=res.whole("impr_val"),
        description=F.concat(
            F.coalesce(res.filled("bldg_class_desc"), F.lit("Building")),
            F.lit(" - "),
            res.text("num_stories_desc"),
            F.lit(" stories"),
        ),
    )
    living, total = res.filled("tot_living_area_sf"), res.filled("tot_main_sf")
    additional = item(
        F.lit("_ADDITIONAL"),
        improvement_type=F.lit("Additional Area"),
        improvement_class=F.lit("Additional"),
        square_footage=res.whole("tot_main_sf"),
        value=money_zero,
        description=F.lit("Additional building area beyond living space"),
    )
    commercial = item(
        F.lit("_COMMERCIAL"),
        improvement_type=F.lit("Commercial Building"),
        improvement_class=com.text("bldg_class_desc"),
        year_built=com.integer("year_built"),
        remodel_year=com.integer("remodel_year"),
        square_footage=com.whole("gross_bldg_area"),
        net_lease_area=com.whole("net_lease_area"),
        stories=com.integer("num_stories"),
        construction_type=com.text("constr_typ_desc"),
        foundation_type=com.text("foundation_typ_desc"),
        foundation_area=com.whole("foundation_area"),
        basement_desc=com.text("basement_desc"),
        basement_area=com.whole("basement_area"),
        heating_type=com.text("heating_typ_desc"),
        ac_type=com.text("ac_typ_desc"),
        num_units=com.integer("num_units"),
        property_name=com.text("property_name"),
        quality=com.text("property_qual_desc"),
        condition=com.text("property_cond_desc"),
        depreciation=struct_of(
            physical=com.double("phys_depr_pct"),
            functional=com.double("funct_depr_pct"),
            external=com.double("extrnl_depr_pct"),
            total=com.double("tot_depr_pct"),
        ),
        value=com.whole("imp_val"),
        description=F.concat(
            F.lit("Commercial Building - "),
            F.coalesce(com.filled("bldg_class_desc"), F.lit("Commercial")),
        ),
    )
    building = s.filled("bldg_id")
    structure = item(
        F.concat(F.lit("_BLDG_"), building),
        improvement_type=F.lit("Building Structure"),
        improvement_class=F.lit("Structure"),
        value=money_zero,
        description=F.concat(F.lit("Building ID: "), building),
    )
    return F.array_compact(
        F.array(
            F.when(res.there & (living.isNotNull() | res.filled("yr_built").isNotNull()), main),
            F.when(res.there & total.isNotNull() & ~total.eqNullSafe(living), additional),
            F.when(
                com.there
                & (com.filled("gross_bldg_area").isNotNull() | com.filled("year_built").isNotNull()),
                commercial,
            ),
            F.when(building.isNotNull(), structure),
        )
    )


def land_details(s: Source, land: Part) -> Column:
    """The land row, with zoning, size and pricing where given, and an acreage row."""
    main = section(
        "land_details",
        land_id=F.concat(s.raw("account_num"), F.lit("_LAND")),
        land_type=F.lit("LAND"),
        land_description=legal_description(s),
        land_class=s.text("division_cd"),
        land_area=s.double("land_area"),
        land_value=s.whole("land_val"),
        zoning=land.when_there(land.text("zoning")),
        front_dimension=land.when_there(land.double("front_dim")),
        depth_dimension=land.when_there(land.double("depth_dim")),
        area_size=land.when_there(land.double("area_size")),
        area_unit=land.when_there(land.text("area_uom_desc")),
        section_number=land.when_there(land.text("section_num")),
        sptd_code=land.when_there(land.text("sptd_cd")),
        sptd_description=land.when_there(land.text("sptd_desc")),
        pricing_method=land.when_there(land.text("pricing_meth_desc")),
        cost_per_unit=land.when_there(land.double("cost_per_uom")),
        market_adjustment=land.when_there(land.double("market_adj_pct")),
        agricultural_use=land.when_there(land.yes("ag_use_ind")),
        agricultural_value=land.when_there(land.whole("acct_ag_val_amt")),
    )
    acreage = s.filled("acreage")
    acres = section(
        "land_details",
        land_id=F.concat(s.raw("account_num"), F.lit("_ACREAGE")),
        land_type=F.lit("ACREAGE"),
        land_description=F.concat(F.lit("Acreage: "), acreage, F.lit(" acres")),
        land_class=F.lit("ACREAGE"),
        land_area=acres_to_sq_ft(s.double("acreage")),
        land_value=F.lit(0),
    )
    return F.array_compact(F.array(main, F.when(acreage.isNotNull(), acres)))


def legal_description(s: Source) -> Column:
    return text.join_present(" ", *[s.raw(f"legal{i}") for i in range(1, 6)])


def property_details(s: Source, res: Part, com: Part, land: Part) -> Column:
    return section(
        "property_details",
        division_code=s.text("division_cd"),
        property_type=division_type(s.raw("division_cd")),
        business_name=s.text("biz_name"),
        neighborhood_code=s.text("nbhd_cd"),
        map_reference=s.text("mapsco"),
        gis_parcel_id=s.text("gis_parcel_id"),
        legal_description=legal_description(s),
        year_built=res.when_there(res.integer("yr_built")),
        building_class=res.when_there(res.text("bldg_class_desc")),
        living_area_sf=res.when_there(res.whole("tot_living_area_sf")),
        main_area_sf=res.when_there(res.whole("tot_main_sf")),
        num_stories=res.when_there(res.text("num_stories_desc")),
        num_bedrooms=res.when_there(res.integer("num_bedrooms")),
        num_full_baths=res.when_there(res.integer("num_full_baths")),
        num_half_baths=res.when_there(res.integer("num_half_baths")),
        commercial_area_sf=com.when_there(com.whole("gross_bldg_area")),
        net_lease_area=com.when_there(com.whole("net_lease_area")),
        property_name=com.when_there(com.text("property_name")),
        property_quality=com.when_there(com.text("property_qual_desc")),
        property_condition=com.when_there(com.text("property_cond_desc")),
        commercial_year_built=com.when_there(com.integer("year_built")),
        commercial_remodel_year=com.when_there(com.integer("remodel_year")),
        commercial_stories=com.when_there(com.integer("num_stories")),
        commercial_num_units=com.when_there(com.integer("num_units")),
        commercial_construction_type=com.when_there(com.text("constr_typ_desc")),
        commercial_heating_type=com.when_there(com.text("heating_typ_desc")),
        commercial_ac_type=com.when_there(com.text("ac_typ_desc")),
        zoning=land.when_there(land.text("zoning")),
        land_area_sf=land.when_there(land.double("area_size")),
        front_dimension=land.when_there(land.double("front_dim")),
        depth_dimension=land.when_there(land.double("depth_dim")),
    )


def valuation(a: Part) -> Column:
    total = a.whole("tot_val")
    return a.when_there(
        section(
            "valuation",
            land_value=a.whole("land_val"),
            improvement_value=a.whole("impr_val"),
            total_value=total,
            homestead_cap_value=a.whole("hmstd_cap_val"),
            market_value=total,
            agricultural_value=a.whole("ag_use_val"),
        )
    )


def joined_rows(files: DallasFiles) -> DataFrame:
    """Account rows with the first appraisal, residential, commercial and land row as structs."""
    rows = keyed(files.accounts)
    for df, name in [
        (files.appraisal, "appraisal"),
        (files.residential, "residential"),
        (files.commercial, "commercial"),
        (files.land, "land"),
    ]:
        if df is not None:
            rows = join_parts(rows, first_row_struct(df, name), KEY)
    return rows


def children(files: DallasFiles) -> dict[str, Nested]:
    return {} if files.owners is None else {"owners": all_owners(files)}


def unified_records(files: DallasFiles, arrays: bool = True) -> DataFrame:
    rows = joined_rows(files)
    s = Source(rows)
    apprl, res, com, land = (
        Part(rows, n) for n in ("appraisal", "residential", "commercial", "land")
    )
    name = primary_owner_name(s)
    records = rows.select(
        KEY,
        F.lit(COUNTY).alias("county"),
        F.lit(TAX_YEAR).alias("year"),
        section(
            "property_address",
            street_address=numbered_street(
                s.raw("street_num"),
                s.raw("street_half_num"),
                s.raw("full_street_name"),
                s.raw("bldg_id"),
                s.raw("unit_id"),
            ),
            city=s.text("property_city"),
            state=F.lit("TX"),
            zip_code=s.text("property_zipcode"),
        ).alias("property_address"),
        section(
            "mailing_address",
            name=name,
            address_line_1=s.text("owner_address_line1"),
            address_line_2=s.text("owner_address_line2"),
            city=s.text("owner_city"),
            state=s.text("owner_state"),
            zip_code=s.text("owner_zipcode"),
        ).alias("mailing_address"),
        property_details(s, res, com, land).alias("property_details"),
        valuation(apprl).alias("valuation"),
        section(
            "legal_status",
            deed_transfer_date=s.text("deed_txfr_date"),
            appraisal_method=apprl.when_there(apprl.text("appraisal_meth_cd")),
        ).alias("legal_status"),
        tax_entities(apprl).alias("tax_entities"),
        improvements(s, res, com).alias("improvements"),
        land_details(s, land).alias("land_details"),
        section(
            "metadata",
            data_source=F.lit("dallas_county_appraisal_district"),
            record_type=F.lit("property"),
        ).alias("metadata"),
        name.alias("_primary_name"),
    )
    return conform(with_owners(records, files.owners, arrays))

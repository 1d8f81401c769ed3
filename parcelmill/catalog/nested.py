"""Unified-record queries (N*, J6, U*) and the flagship county report."""

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.catalog import files
from parcelmill.catalog.registry import Inputs, query
from parcelmill.fixtures import TABLES
from parcelmill.operators import summary
from parcelmill.operators.keyed import split_by_id
from parcelmill.operators.nesting import Nested
from parcelmill.plans import dallas, gold, harris, travis
from parcelmill.session import scratch_path
from parcelmill.sources import store


def harris_files(src: Inputs) -> harris.HarrisFiles:
    return harris.HarrisFiles(
        accounts=src.view("fx_real_acct"),
        owners=src.view("fx_owners"),
        deeds=src.view("fx_deeds"),
        permits=src.view("fx_permits"),
        minerals=src.view("fx_mineral"),
        relations=src.view("fx_tieback"),
        neighborhoods=src.view("fx_nbhd"),
    )


def travis_files(src: Inputs) -> travis.TravisFiles:
    return travis.TravisFiles(
        properties=src.view("fx_travis_prop"),
        entities=src.view("fx_travis_ent"),
        improvements=src.view("fx_travis_imp"),
        land=src.view("fx_travis_land"),
        agents=src.view("fx_travis_agent"),
        subdivisions=src.view("fx_travis_subd"),
    )


def dallas_files(src: Inputs) -> dallas.DallasFiles:
    return dallas.DallasFiles(
        accounts=src.view("fx_dallas_account"),
        appraisal=src.view("fx_dallas_appraisal"),
        owners=src.view("fx_dallas_owner"),
        residential=src.view("fx_dallas_res"),
        commercial=src.view("fx_dallas_com"),
        land=src.view("fx_dallas_land"),
    )


def county_records(src: Inputs) -> dict[str, Callable[[], DataFrame]]:
    """Records of each county, with the numbers of their children."""
    return {
        "travis": lambda: travis.unified_records(travis_files(src), arrays=False),
        "dallas": lambda: dallas.unified_records(dallas_files(src), arrays=False),
        "harris": lambda: harris.unified_records(harris_files(src), arrays=False),
    }


def county_children(src: Inputs) -> dict[str, dict[str, Nested]]:
    """Child families of each county that are rows of files."""
    return {
        "travis": travis.children(travis_files(src)),
        "dallas": dallas.children(dallas_files(src)),
        "harris": harris.children(harris_files(src)),
    }


_STORES: dict[tuple, str] = {}


def _files_of(src: Inputs) -> tuple:
    """Names, sizes and times of the base files, from their listing: changed data is never served stale."""
    found = []
    for name in TABLES:
        path = src.spark._jvm.org.apache.hadoop.fs.Path(f"{src.sf_dir}/{name}.parquet")
        system = path.getFileSystem(src.spark._jsc.hadoopConfiguration())
        top = system.getFileStatus(path)
        for f in system.listStatus(path) if top.isDirectory() else [top]:
            found.append((str(f.getPath()), f.getLen(), f.getModificationTime()))
    return (src.spark.sparkContext.applicationId, *found)


def sample_store(src: Inputs) -> str:
    """A property store of all counties, from three batches that overlap and a reload of one county.

    The first batch has records of all counties in an earlier state, those of Harris under ids that end; the second
    brings all up to date, and the third reloads Harris, so that its other records go. Reports have no place for the
    status of a county, so one that fails is their error.
    """
    key = _files_of(src)
    if key not in _STORES:
        root = scratch_path(src.spark, "store")
        records = gold.all_counties(src.spark, county_records(src), f"{root}/counties").withColumn("pos", F.lit(1))
        ended = F.when(F.col("county") == "harris", F.concat(F.lit("ended-"), "account_id")).otherwise(F.col("account_id"))
        bare = {n: F.lit(None).cast(records.schema[n].dataType) for n in ("mailing_address", "valuation", "legal_status")}
        earlier = records.withColumns({"account_id": ended, "year": F.lit(None).cast("int")} | bare)
        late, reloaded = records.filter("county <> 'harris'"), records.filter("county = 'harris'")
        store.upsert(src.spark, root, earlier, "earlier", "2025-05-01 12:00:00", "pos")
        store.upsert(src.spark, root, late.unionByName(reloaded), "update", "2025-05-02 12:00:00", "pos")
        store.upsert(src.spark, root, reloaded, "reload", "2025-05-03 12:00:00", "pos", reload_county="harris")
        _STORES[key] = root
    return _STORES[key]


HARRIS = "fx_real_acct fx_owners fx_deeds fx_permits fx_mineral fx_tieback fx_nbhd"
TRAVIS = "fx_travis_prop fx_travis_ent fx_travis_imp fx_travis_land fx_travis_agent fx_travis_subd"
DALLAS = (
    "fx_dallas_account fx_dallas_appraisal fx_dallas_owner fx_dallas_res fx_dallas_com fx_dallas_land"
)
H_ID = "lpad(trim(acct), 13, '0')"
D_ID = "lpad(replace(account_num, '-', ''), 17, '0')"
T_ID = "substr(value, 1, 12)"
T_OK = "substr(value, 1, 12) <> '000000000000'"


def money(expr: str) -> str:
    return f"try_cast(replace(nullif(trim({expr}), ''), ',', '') AS decimal(18,2))"


@query(
    "n1_harris_record",
    "fx_real_acct",
    f"""WITH v AS (SELECT *, CASE WHEN coalesce(trim(prior_land_val), '') = '' THEN 0
        ELSE try_cast(prior_land_val AS decimal(18,2)) END AS p FROM fx_real_acct)
    SELECT {H_ID} AS account_id, 'harris' AS county, 2025 AS year, site_addr_1 AS street_address,
        site_addr_2 AS city, site_addr_3 AS zip_code, mailto AS mail_name, mail_addr_1 AS address_line_1,
        try_cast(nullif(trim(yr_impr), '') AS int) AS year_improved,
        cast({money('bld_ar')} AS bigint) AS building_area, nullif(trim(school_dist), '') AS school_district,
        market_area_1, {money('land_val')} AS land_value, {money('tot_mkt_val')} AS market_value,
        {money('prior_land_val')} AS prior_land,
        cast(cast(land_val AS decimal(18,2)) - p AS decimal(18,2)) AS land_dollar_change,
        CASE WHEN p <> 0 THEN cast(round_even((cast(land_val AS decimal(18,2)) - p) * 100 / p, 2)
            AS decimal(18,2)) END AS land_percent_change,
        upper(noticed) = 'Y' AS noticed, coalesce(protested = 'Y', false) AS protested, jurs AS jurisdictions,
        lgl_1 AS legal_1, lgl_2 AS legal_2 FROM v""",
)
def n1(src: Inputs):
    return harris.account_records(src.view("fx_real_acct")).select(
        "account_id",
        "county",
        "year",
        "property_address.street_address",
        "property_address.city",
        "property_address.zip_code",
        F.col("mailing_address.name").alias("mail_name"),
        "mailing_address.address_line_1",
        "property_details.year_improved",
        "property_details.building_area",
        "property_details.school_district",
        "property_details.market_area_1",
        "valuation.land_value",
        "valuation.market_value",
        F.col("valuation.prior_values.land").alias("prior_land"),
        F.col("valuation.value_changes.land_change.dollar_change").alias("land_dollar_change"),
        F.col("valuation.value_changes.land_change.percent_change").alias("land_percent_change"),
        "legal_status.noticed",
        "legal_status.protested",
        "legal_status.jurisdictions",
        F.col("legal_status.legal_description")[0].alias("legal_1"),
        F.col("legal_status.legal_description")[1].alias("legal_2"),
    )


@query(
    "n2_harris_owners",
    "fx_owners",
    f"""SELECT {H_ID} AS account_id, ln_num AS line_number, name, aka,
        try_cast(nullif(pct_own, '') AS decimal(9,4)) AS percentage FROM fx_owners""",
)
def n2(src: Inputs):
    return harris.nest_owners(src.view("fx_owners")).flat().select(
        "account_id", "line_number", "name", "aka", "percentage"
    )


@query(
    "n3_harris_deeds",
    "fx_deeds",
    """SELECT lpad(acct, 13, '0') AS account_id, dos AS date_of_sale, clerk_yr AS clerk_year, clerk_id, deed_id
    FROM fx_deeds""",
)
def n3(src: Inputs):
    return harris.nest_deeds(src.view("fx_deeds")).flat().select(
        "account_id", "date_of_sale", "clerk_year", "clerk_id", "deed_id"
    )


@query(
    "n4_harris_permits",
    "fx_permits",
    f"""SELECT {H_ID} AS account_id, id AS permit_id, status, trim(dscr, ' "') AS description, permit_type, yr AS year,
    site_num AS site_number FROM fx_permits""",
)
def n4(src: Inputs):
    return harris.nest_permits(src.view("fx_permits")).flat().select(
        "account_id",
        "permit_id",
        "status",
        "description",
        "permit_type",
        "year",
        "site_address.site_number",
    )


@query(
    "n5_parcel_relations",
    "fx_tieback",
    f"""SELECT {H_ID} AS account_id, acct AS source_account, tp AS type, dscr AS description,
    related_acct AS related_account_id, pct AS percentage FROM fx_tieback""",
)
def n5(src: Inputs):
    relations = harris.nest_relations(src.view("fx_tieback")).flat()
    return relations.select(
        "account_id",
        "source_account",
        "type",
        "description",
        "related_account_id",
        "percentage",
    )


@query(
    "n6_mineral_rights",
    "fx_mineral",
    f"""SELECT {H_ID} AS account_id, dor_cd AS dor_code, type_interest AS interest_type, interest_percent
    FROM fx_mineral QUALIFY row_number() OVER (PARTITION BY acct ORDER BY source_pos DESC) = 1""",
)
def n6(src: Inputs):
    return harris.mineral_struct(src.view("fx_mineral")).select(
        "account_id",
        "mineral_rights.dor_code",
        "mineral_rights.interest_type",
        "mineral_rights.interest_percent",
    )


@query(
    "n1_rejected_rows",
    "",
    """SELECT 'usable' AS outcome, count(*) AS row_count FROM customer WHERE c_acctbal >= 1000
    UNION ALL SELECT 'rejected', count(*) FROM customer WHERE c_acctbal < 1000""",
)
def n1_rejects(src: Inputs):
    """Accounts without a usable id: null, blank or without a digit."""
    balance = F.col("c_acctbal")
    no_id = F.when(balance < 0, None).when(balance < 500, F.lit("  ")).otherwise("n/a")
    rows = src.table("customer").select(
        F.when(balance >= 1000, F.col("c_custkey").cast("string")).otherwise(no_id).alias("acct")
    )
    usable, rejected = split_by_id(rows, "acct")
    return usable.agg(F.lit("usable").alias("outcome"), F.count("*").alias("row_count")).unionByName(
        rejected.agg(F.lit("rejected").alias("outcome"), F.count("*").alias("row_count"))
    )


@query(
    "n7_neighbourhood",
    "fx_real_acct fx_nbhd",
    f"""SELECT {H_ID} AS account_id, n.grp_cd AS group_code, n.dscr AS description
    FROM fx_real_acct a LEFT JOIN fx_nbhd n ON a.market_area_1 = cast(n.cd AS string)""",
)
def n7(src: Inputs):
    records = harris.account_records(src.view("fx_real_acct")).select("account_id", "market_area_1")
    # a file in which each code was written twice, the earlier row outdated
    now = src.view("fx_nbhd").withColumn("turn", F.lit(1))
    old = now.withColumns({"turn": F.lit(0), "dscr": F.lit("OLD")})
    codes = files.reread(old.unionByName(now), "n7", ["turn", "cd"], [c for c in now.columns if c != "turn"])
    return harris.neighborhood_struct(records, codes).select(
        "account_id", "neighborhood.group_code", "neighborhood.description"
    )


@query(
    "n8_harris_tax_entities",
    "fx_real_acct",
    f"""WITH a AS (SELECT {H_ID} AS account_id, nullif(trim(school_dist), '') AS school,
        nullif(trim(site_addr_2), '') AS city, nullif(trim(jurs), '') AS jurs, {money('tot_mkt_val')} AS market_value
        FROM fx_real_acct)
    SELECT account_id, 'School District ' || school AS entity_name, 'SCHOOL' AS entity_type,
        school AS jurisdiction_id, market_value, 'School District' AS description FROM a WHERE school IS NOT NULL
    UNION ALL SELECT account_id, 'Harris County', 'COUNTY', 'HARRIS', market_value, 'County Government' FROM a
    UNION ALL SELECT account_id, 'City of ' || city, 'CITY', upper(replace(city, ' ', '_')), market_value,
        'Municipal Government' FROM a WHERE city IS NOT NULL
    UNION ALL SELECT account_id, 'Jurisdiction: ' || j, 'JURISDICTION', j, market_value, 'Special Jurisdiction'
        FROM (SELECT account_id, market_value, unnest(string_split(jurs, ' ')) AS j FROM a WHERE jurs IS NOT NULL)""",
)
def n8(src: Inputs):
    records = harris.account_records(src.view("fx_real_acct"))
    return records.select("account_id", F.explode("tax_entities").alias("e")).select(
        "account_id",
        "e.entity_name",
        "e.entity_type",
        "e.jurisdiction_id",
        "e.market_value",
        "e.description",
    )


@query(
    "n9_harris_improvements",
    "fx_real_acct",
    f"""SELECT {H_ID} AS account_id, {H_ID} || '_MAIN' AS improvement_id, 'Main Building' AS improvement_type,
        coalesce(try_cast(trim(yr_impr) AS int), 0) AS year_built,
        cast(replace(bld_ar, ',', '') AS bigint) AS square_footage, cast(bld_val AS decimal(18,2)) AS value,
        'Building - Structure - ' || bld_ar || ' sq ft' AS description
    FROM fx_real_acct WHERE coalesce(try_cast(trim(yr_impr) AS int), 0) > 0
        OR cast(replace(bld_ar, ',', '') AS bigint) > 0""",
)
def n9(src: Inputs):
    records = harris.account_records(src.view("fx_real_acct"))
    return records.select("account_id", F.explode("improvements").alias("i")).select(
        "account_id",
        "i.improvement_id",
        "i.improvement_type",
        "i.year_built",
        "i.square_footage",
        "i.value",
        "i.description",
    )


@query(
    "n10_harris_land",
    "fx_real_acct",
    f"""SELECT {H_ID} AS account_id, {H_ID} || '_LAND' AS land_id, 'LAND' AS land_type,
        concat_ws(' ', lgl_1, lgl_2) AS land_description, 'Unknown' AS land_class,
        cast(trunc(cast(land_val AS double)) AS decimal(18,2)) AS land_value, market_area_1 AS market_area,
        market_area_1_dscr AS market_area_description FROM fx_real_acct""",
)
def n10(src: Inputs):
    records = harris.account_records(src.view("fx_real_acct"))
    return records.select("account_id", F.explode("land_details").alias("l")).select(
        "account_id",
        "l.land_id",
        "l.land_type",
        "l.land_description",
        "l.land_class",
        "l.land_value",
        "l.market_area",
        "l.market_area_description",
    )


@query(
    "n11_travis_record",
    "fx_travis_prop",
    f"""SELECT {T_ID} AS account_id, 'travis' AS county, 2025 AS year, 'TX' AS state,
        nullif(trim(substr(value, 609, 52)), '') AS mail_name, substr(value, 13, 1) AS property_type,
        nullif(trim(substr(value, 551, 20)), '') AS geo_id,
        cast(coalesce(try_cast(substr(value, 1821, 15) AS decimal(18,0)), 0) / 1000000000 AS decimal(18,2))
            AS assessed_value,
        cast(coalesce(try_cast(substr(value, 1836, 15) AS decimal(18,0)), 0) / 1000000000 AS decimal(18,2))
            AS land_value,
        CASE WHEN trim(substr(value, 609, 52)) <> '' THEN 'primary' END AS owner_type
    FROM fx_travis_prop WHERE {T_OK}""",
)
def n11(src: Inputs):
    return travis.property_records(src.view("fx_travis_prop")).select(
        "account_id",
        "county",
        "year",
        "property_address.state",
        F.col("mailing_address.name").alias("mail_name"),
        "property_details.property_type",
        "property_details.geo_id",
        "valuation.assessed_value",
        "valuation.land_value",
        F.try_element_at("owners", F.lit(1)).getField("owner_type").alias("owner_type"),
    )


@query(
    "n12_travis_tax_entities",
    "fx_travis_ent",
    f"""SELECT {T_ID} AS account_id, trim(substr(value, 64, 80)) AS entity_name,
        trim(substr(value, 63, 10)) AS entity_type, trim(substr(value, 51, 12)) AS jurisdiction_id,
        cast(cast(substr(value, 201, 15) AS decimal(18,0)) / 1000000000 AS decimal(18,2)) AS assessed_value,
        cast(0 AS decimal(18,2)) AS market_value, cast(0 AS double) AS tax_rate FROM fx_travis_ent WHERE {T_OK}""",
)
def n12(src: Inputs):
    return travis.nest_entities(src.view("fx_travis_ent")).flat().select(
        "account_id",
        "entity_name",
        "entity_type",
        "jurisdiction_id",
        "assessed_value",
        "market_value",
        "tax_rate",
    )


@query(
    "n13_travis_improvements_land",
    "fx_travis_imp fx_travis_land",
    f"""SELECT 'improvement' AS family, {T_ID} AS account_id,
        CASE WHEN ltrim(substr(value, 13, 10), '0') <> '' THEN substr(value, 13, 10) END AS item_id,
        trim(substr(value, 23, 20)) AS item_type, cast(substr(value, 67, 10) AS double) AS size,
        cast(cast(substr(value, 77, 10) AS bigint) AS decimal(18,2)) AS value
    FROM fx_travis_imp WHERE {T_OK}
    UNION ALL SELECT 'land', {T_ID}, substr(value, 13, 10), trim(substr(value, 23, 20)),
        cast(substr(value, 113, 10) AS double),
        cast(cast(substr(value, 123, 10) AS bigint) / 1e9 AS decimal(18,2))
    FROM fx_travis_land WHERE {T_OK}""",
)
def n13(src: Inputs):
    built = travis.nest_improvements(src.view("fx_travis_imp")).flat().select(
        F.lit("improvement").alias("family"),
        "account_id",
        F.col("improvement_id").alias("item_id"),
        F.col("improvement_type").alias("item_type"),
        F.col("square_footage").cast("double").alias("size"),
        "value",
    )
    land = travis.nest_land(src.view("fx_travis_land")).flat().select(
        F.lit("land").alias("family"),
        "account_id",
        F.col("land_id").alias("item_id"),
        F.col("land_type").alias("item_type"),
        F.col("land_area").alias("size"),
        F.col("land_value").alias("value"),
    )
    return built.unionByName(land)


@query(
    "n14_travis_subdivision",
    "fx_travis_prop fx_travis_subd",
    f"""WITH p AS (SELECT {T_ID} AS account_id, 'S' || cast(cast({T_ID} AS bigint) % 30 AS string) AS code
        FROM fx_travis_prop WHERE {T_OK})
    SELECT account_id, code, trim(substr(s.value, 13, 50)) AS subdivision_name,
        trim(substr(s.value, 83, 30)) AS city, trim(substr(s.value, 113, 20)) AS subdivision_county
    FROM p LEFT JOIN fx_travis_subd s ON code = trim(substr(s.value, 1, 12))""",
)
def n14(src: Inputs):
    lots = travis.properties(src.view("fx_travis_prop")).select(
        "account_id", F.concat(F.lit("S"), F.col("account_id").cast("bigint") % 30).alias("code")
    )
    return travis.with_subdivision(lots, src.view("fx_travis_subd"), "code").select(
        "account_id",
        "code",
        "subdivision.subdivision_name",
        "subdivision.city",
        F.col("subdivision.county").alias("subdivision_county"),
    )


@query(
    "n15_agents",
    "fx_travis_agent",
    """SELECT trim(substr(value, 1, 12)) AS agent_id, trim(substr(value, 13, 60)) AS agent_name,
        trim(substr(value, 73, 70)) AS agent_address, trim(substr(value, 143, 20)) AS agent_city,
        trim(substr(value, 163, 3)) AS agent_state, trim(substr(value, 166, 10)) AS agent_zip
    FROM fx_travis_agent WHERE trim(substr(value, 1, 12)) <> '0'""",
)
def n15(src: Inputs):
    return travis.agents(src.view("fx_travis_agent"))


D_FIRST = f"""a AS (SELECT *, {D_ID} AS account_id FROM fx_dallas_account),
    v AS (SELECT *, {D_ID} AS id FROM fx_dallas_appraisal
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1),
    r AS (SELECT *, {D_ID} AS id FROM fx_dallas_res
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1),
    c AS (SELECT *, {D_ID} AS id FROM fx_dallas_com
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1),
    l AS (SELECT *, {D_ID} AS id FROM fx_dallas_land
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1)"""


@query(
    "n16_dallas_record",
    DALLAS,
    f"""WITH {D_FIRST}
    SELECT a.account_id, 'dallas' AS county, 2025 AS year,
        concat_ws(' ', a.street_num, nullif(a.street_half_num, ''), a.full_street_name, 'Bldg ' || a.bldg_id)
            AS street_address,
        concat_ws(' ', a.owner_name1, a.owner_name2) AS mail_name,
        CASE WHEN r.id IS NOT NULL THEN coalesce(cast(r.yr_built AS int), 0) END AS year_built,
        CASE WHEN r.id IS NOT NULL THEN cast(r.num_bedrooms AS int) END AS num_bedrooms,
        CASE WHEN r.id IS NOT NULL THEN 1900 END AS living_area_sf,
        cast(c.gross_bldg_area AS bigint) AS commercial_area_sf, c.property_name,
        cast(c.year_built AS int) AS commercial_year_built, l.zoning, cast(l.area_size AS double) AS land_area_sf,
        CASE WHEN l.id IS NOT NULL THEN cast(0 AS double) END AS depth_dimension,
        cast(trunc(cast(v.land_val AS double)) AS decimal(18,2)) AS land_value,
        cast(trunc(cast(v.tot_val AS double)) AS decimal(18,2)) AS market_value
    FROM a LEFT JOIN v ON a.account_id = v.id LEFT JOIN r ON a.account_id = r.id
        LEFT JOIN c ON a.account_id = c.id LEFT JOIN l ON a.account_id = l.id""",
)
def n16(src: Inputs):
    return dallas.unified_records(dallas_files(src)).select(
        "account_id",
        "county",
        "year",
        "property_address.street_address",
        F.col("mailing_address.name").alias("mail_name"),
        "property_details.year_built",
        "property_details.num_bedrooms",
        "property_details.living_area_sf",
        "property_details.commercial_area_sf",
        "property_details.property_name",
        "property_details.commercial_year_built",
        "property_details.zoning",
        "property_details.land_area_sf",
        "property_details.depth_dimension",
        "valuation.land_value",
        "valuation.market_value",
    )


@query(
    "n17_dallas_tax_entities",
    "fx_dallas_account fx_dallas_appraisal",
    f"""WITH v AS (SELECT *, {D_ID} AS account_id FROM fx_dallas_appraisal
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1)
    SELECT account_id, city_juris_desc AS entity_name, 'CITY' AS entity_type,
        cast(100000 AS decimal(18,2)) AS taxable_value, cast(1 AS double) AS split_percentage FROM v
        WHERE city_juris_desc NOT IN ('', 'UNASSIGNED')
    UNION ALL SELECT account_id, county_juris_desc, 'COUNTY', 90000, 0 FROM v
    UNION ALL SELECT account_id, isd_juris_desc, 'ISD', 0, 0.5 FROM v WHERE isd_juris_desc <> ''""",
)
def n17(src: Inputs):
    files = dallas_files(src)
    rows = dallas.joined_rows(dallas.DallasFiles(files.accounts, files.appraisal))
    entities = dallas.tax_entities(dallas.Part(rows, "appraisal"))
    return rows.select("account_id", F.explode(entities).alias("e")).select(
        "account_id",
        "e.entity_name",
        "e.entity_type",
        "e.taxable_value",
        "e.split_percentage",
    )


@query(
    "n18_dallas_owners",
    "fx_dallas_account fx_dallas_owner",
    f"""SELECT {D_ID} AS account_id, 'primary' AS owner_type, concat_ws(' ', owner_name1, owner_name2) AS name,
        cast(100 - coalesce((SELECT sum(cast(ownership_pct AS int)) FROM fx_dallas_owner o
            WHERE o.account_num = a.account_num), 0) AS decimal(9,4)) AS percentage FROM fx_dallas_account a
    UNION ALL SELECT {D_ID}, 'additional', owner_name, cast(ownership_pct AS decimal(9,4))
    FROM fx_dallas_owner WHERE owner_name IS NOT NULL""",
)
def n18(src: Inputs):
    files = dallas_files(src)
    return dallas.all_owners(files).flat().select("account_id", "owner_type", "name", "percentage")


@query(
    "n19_dallas_improvements",
    DALLAS,
    f"""WITH {D_FIRST}
    SELECT a.account_id, a.account_num || '_MAIN' AS improvement_id, 'Main Building' AS improvement_type,
        coalesce(cast(r.yr_built AS int), 0) AS year_built, 1900 AS square_footage,
        cast(0 AS decimal(18,2)) AS value, r.pool_ind IS NOT NULL AS pool, cast(NULL AS double) AS physical
    FROM a JOIN r ON a.account_id = r.id
    UNION ALL SELECT a.account_id, a.account_num || '_ADDITIONAL', 'Additional Area', NULL, 2100, 0, NULL, NULL
    FROM a JOIN r ON a.account_id = r.id WHERE r.tot_main_sf = '2,100'
    UNION ALL SELECT a.account_id, a.account_num || '_COMMERCIAL', 'Commercial Building', 1999,
        cast(c.gross_bldg_area AS bigint), cast(trunc(cast(c.imp_val AS double)) AS decimal(18,2)), NULL, 10.5
    FROM a JOIN c ON a.account_id = c.id
    UNION ALL SELECT account_id, account_num || '_BLDG_' || bldg_id, 'Building Structure', NULL, NULL, 0, NULL, NULL
    FROM a WHERE bldg_id IS NOT NULL""",
)
def n19(src: Inputs):
    records = dallas.unified_records(dallas_files(src))
    return records.select("account_id", F.explode("improvements").alias("i")).select(
        "account_id",
        "i.improvement_id",
        "i.improvement_type",
        "i.year_built",
        "i.square_footage",
        "i.value",
        "i.amenities.pool",
        "i.depreciation.physical",
    )


@query(
    "n20_dallas_land",
    DALLAS,
    f"""WITH {D_FIRST}
    SELECT a.account_id, a.account_num || '_LAND' AS land_id, 'LAND' AS land_type,
        concat_ws(' ', a.legal1, a.legal2) AS land_description, coalesce(a.division_cd, '') AS land_class,
        cast(0 AS double) AS land_area, l.zoning, cast(l.area_size AS double) AS area_size,
        CASE WHEN l.id IS NOT NULL THEN l.ag_use_ind = 'Y' END AS agricultural_use
    FROM a LEFT JOIN l ON a.account_id = l.id
    UNION ALL SELECT account_id, account_num || '_ACREAGE', 'ACREAGE', 'Acreage: ' || acreage || ' acres', 'ACREAGE',
        cast(acreage AS double) * 43560, NULL, NULL, NULL FROM a WHERE acreage IS NOT NULL""",
)
def n20(src: Inputs):
    records = dallas.unified_records(dallas_files(src))
    return records.select("account_id", F.explode("land_details").alias("l")).select(
        "account_id",
        "l.land_id",
        "l.land_type",
        "l.land_description",
        "l.land_class",
        "l.land_area",
        "l.zoning",
        "l.area_size",
        "l.agricultural_use",
    )


@query(
    "n21_travis_counts",
    TRAVIS,
    f"""WITH p AS (SELECT {T_ID} AS account_id FROM fx_travis_prop WHERE {T_OK}),
    e AS (SELECT {T_ID} AS id, count(*) AS n FROM fx_travis_ent GROUP BY 1),
    i AS (SELECT {T_ID} AS id, count(*) AS n FROM fx_travis_imp GROUP BY 1),
    l AS (SELECT {T_ID} AS id, count(*) AS n FROM fx_travis_land GROUP BY 1)
    SELECT account_id, coalesce(e.n, 0) AS entities, coalesce(i.n, 0) AS improvements, coalesce(l.n, 0) AS land,
        (SELECT count(*) FROM fx_travis_agent WHERE trim(substr(value, 1, 12)) <> '0') AS agents
    FROM p LEFT JOIN e ON account_id = e.id LEFT JOIN i ON account_id = i.id LEFT JOIN l ON account_id = l.id""",
)
def n21(src: Inputs):
    return travis.unified_records(travis_files(src)).select("account_id", "metadata.counts.*")


@query(
    "j6_nest_join",
    HARRIS,
    f"""WITH o AS (SELECT {H_ID} AS id, count(*) AS n, string_agg(ln_num || ':' || coalesce(trim(name), ''), ','
            ORDER BY ln_num) AS all_of FROM fx_owners GROUP BY 1),
    d AS (SELECT {H_ID} AS id, count(*) AS n, string_agg(deed_id, ',' ORDER BY strptime(dos, '%m/%d/%Y'), deed_id)
        AS all_of FROM fx_deeds GROUP BY 1),
    p AS (SELECT {H_ID} AS id, count(*) AS n, string_agg(yr || ':' || id, ',' ORDER BY yr, id) AS all_of
        FROM fx_permits GROUP BY 1),
    t AS (SELECT {H_ID} AS id, count(*) AS n, string_agg(related_acct, ',') AS all_of FROM fx_tieback GROUP BY 1),
    m AS (SELECT {H_ID} AS id, dor_cd FROM fx_mineral
        QUALIFY row_number() OVER (PARTITION BY acct ORDER BY source_pos DESC) = 1)
    SELECT {H_ID} AS account_id, coalesce(o.n, 0) AS owners, coalesce(d.n, 0) AS deeds,
        coalesce(p.n, 0) AS permits, coalesce(t.n, 0) AS relations, coalesce(o.all_of, '') AS all_owners,
        coalesce(d.all_of, '') AS all_deeds, coalesce(p.all_of, '') AS all_permits,
        coalesce(t.all_of, '') AS all_relations, m.dor_cd AS mineral_code, n.dscr AS neighborhood
    FROM fx_real_acct a LEFT JOIN o ON {H_ID} = o.id LEFT JOIN d ON {H_ID} = d.id LEFT JOIN p ON {H_ID} = p.id
    LEFT JOIN t ON {H_ID} = t.id LEFT JOIN m ON {H_ID} = m.id
    LEFT JOIN fx_nbhd n ON a.market_area_1 = cast(n.cd AS string)""",
)
def j6(src: Inputs):
    def listed(family: str, *fields: str):
        parts = lambda x: F.concat_ws(":", *[F.coalesce(F.trim(x[f].cast("string")), F.lit("")) for f in fields])
        return F.array_join(F.transform(family, parts), ",")

    return harris.unified_records(harris_files(src)).select(
        "account_id",
        "child_counts.owners",
        "child_counts.deeds",
        "child_counts.permits",
        F.col("child_counts.parcel_relationships").alias("relations"),
        listed("owners", "line_number", "name").alias("all_owners"),
        listed("deeds", "deed_id").alias("all_deeds"),
        listed("permits", "year", "permit_id").alias("all_permits"),
        listed("parcel_relationships", "related_account_id").alias("all_relations"),
        F.col("mineral_rights.dor_code").alias("mineral_code"),
        F.col("neighborhood.description").alias("neighborhood"),
    )


@query(
    "u1_concat_chunks",
    "fx_dallas_appraisal",
    "SELECT account_num, land_val, source_pos FROM fx_dallas_appraisal",
)
def u1(src: Inputs):
    rows = src.view("fx_dallas_appraisal").select("account_num", "land_val", "source_pos")
    chunks = [rows.filter(F.pmod("source_pos", F.lit(3)) == i) for i in range(3)]
    return chunks[0].unionByName(chunks[1]).unionByName(chunks[2])


@query(
    "u2_union_counties",
    f"{HARRIS} {TRAVIS} {DALLAS}",
    f"""WITH h AS (SELECT acct, count(*) AS n FROM fx_owners GROUP BY acct),
    o AS (SELECT account_num, count(*) AS n FROM fx_dallas_owner WHERE owner_name IS NOT NULL GROUP BY 1),
    e AS (SELECT {T_ID} AS id, count(*) AS n FROM fx_travis_ent GROUP BY 1),
    r AS (SELECT 'harris' AS county, {H_ID.replace('acct', 'a.acct')} AS account_id,
        {money('tot_mkt_val')} AS market_value, coalesce(h.n, 0) AS children FROM fx_real_acct a LEFT JOIN h ON h.acct = trim(a.acct)
    UNION ALL SELECT 'travis', {T_ID}, cast(0 AS decimal(18,2)), coalesce(e.n, 0)
        FROM fx_travis_prop LEFT JOIN e ON e.id = {T_ID} WHERE {T_OK}
    UNION ALL SELECT 'dallas', {D_ID.replace('account_num', 'd.account_num')}, (SELECT cast(trunc(cast(min_by(tot_val,
        source_pos) AS double)) AS decimal(18,2)) FROM fx_dallas_appraisal v WHERE v.account_num = d.account_num),
        1 + coalesce(o.n, 0) FROM fx_dallas_account d LEFT JOIN o ON o.account_num = d.account_num),
    c AS (SELECT 'harris' AS county, {H_ID} AS id, ln_num || ':' || coalesce(trim(name), '') AS child FROM fx_owners
        WHERE acct IN (SELECT trim(acct) FROM fx_real_acct)
    UNION ALL SELECT 'dallas', {D_ID}, 'primary:' || concat_ws(' ', owner_name1, owner_name2) FROM fx_dallas_account
    UNION ALL SELECT 'dallas', {D_ID}, 'additional:' || trim(owner_name) FROM fx_dallas_owner
        WHERE owner_name IS NOT NULL)
    SELECT 'record' AS kind, county, account_id, market_value, children, NULL AS value FROM r
    UNION ALL SELECT 'child', county, id, NULL, NULL, child FROM c
    UNION ALL SELECT 'status', county, NULL, NULL, count(*), 'ok' FROM r GROUP BY county
    UNION ALL SELECT 'status', 'broken', NULL, NULL, 0, 'failed'""",
)
def u2(src: Inputs):
    """Three counties and one whose file breaks while it is read."""
    torn = travis_files(src).properties
    torn = torn.withColumn("value", F.when(F.col("value").substr(1, 12) > "000000000009", F.raise_error(F.lit("torn line"))).otherwise(F.col("value")))
    builders = county_records(src) | {"broken": lambda: travis.unified_records(travis.TravisFiles(torn), arrays=False)}
    records, status = gold.union_counties(src.spark, builders, scratch_path(src.spark, "u2"))
    n_children = F.when(F.col("county") == "travis", F.col("child_counts.tax_entities")).otherwise(F.col("child_counts.owners"))
    out = records.select(F.lit("record").alias("kind"), "county", "account_id", "valuation.market_value", n_children.alias("children"))
    out = out.unionByName(
        status.select(F.lit("status").alias("kind"), "county", F.col("records").alias("children"), F.col("status").alias("value")),
        allowMissingColumns=True,
    )
    for county, first in (("harris", F.col("line_number").cast("string")), ("dallas", F.col("owner_type"))):
        owners = county_children(src)[county]["owners"].flat()
        value = F.concat(first, F.lit(":"), F.coalesce(F.trim("name"), F.lit("")))
        known = owners.join(records.filter(F.col("county") == county).select("account_id"), "account_id", "left_semi")
        rows = known.select(F.lit("child").alias("kind"), F.lit(county).alias("county"), "account_id", value.alias("value"))
        out = out.unionByName(rows, allowMissingColumns=True)
    return out


@query(
    "flagship_county_values",
    f"{HARRIS}",
    f"""WITH v AS (SELECT {money('tot_mkt_val')} AS m, {money('land_val')} AS l,
        (SELECT count(*) FROM fx_owners o WHERE o.acct = trim(a.acct)) AS n FROM fx_real_acct a)
    SELECT 'harris' AS county, count(*) AS properties,
        count(*) FILTER (m > 0 AND m < 100000000) AS valued,
        round(avg(m) FILTER (m > 0 AND m < 100000000), 4) AS avg_value,
        min(m) FILTER (m > 0 AND m < 100000000) AS min_value,
        max(m) FILTER (m > 0 AND m < 100000000) AS max_value,
        sum(l) AS land_value, cast(sum(n) AS bigint) AS owners FROM v""",
)
def flagship(src: Inputs):
    """Records with owners, valued and summed per county."""
    files = harris.HarrisFiles(src.view("fx_real_acct"), src.view("fx_owners"))
    records = harris.unified_records(files, arrays=False)
    value = F.col("valuation.market_value")
    usable = F.when((value > 0) & (value < 100_000_000), value)
    return records.groupBy("county").agg(
        F.count(F.lit(1)).alias("properties"),
        F.count(usable).alias("valued"),
        F.round(F.avg(usable).cast("double"), 4).alias("avg_value"),
        F.min(usable).alias("min_value"),
        F.max(usable).alias("max_value"),
        F.sum("valuation.land_value").alias("land_value"),
        F.sum("child_counts.owners").alias("owners"),
    )


@query(
    "a10_dallas_profile",
    "fx_dallas_account fx_dallas_res",
    f"""WITH r AS (SELECT {D_ID} AS id, yr_built FROM fx_dallas_res
        QUALIFY row_number() OVER (PARTITION BY account_num ORDER BY source_pos) = 1)
    SELECT coalesce(a.division_cd, '') AS division_code, count(*) AS count,
        round(count(*) * 100.0 / (SELECT count(*) FROM fx_dallas_account), 6) AS percent,
        round(avg(try_cast(r.yr_built AS int)), 6) AS average_year
    FROM fx_dallas_account a LEFT JOIN r ON lpad(replace(a.account_num, '-', ''), 17, '0') = r.id GROUP BY 1""",
)
def a10(src: Inputs):
    # only the residential file is needed, so the other files are not joined
    files = dallas_files(src)
    homes = dallas.DallasFiles(files.accounts, residential=files.residential)
    records = dallas.unified_records(homes).select(
        F.col("property_details.division_code").alias("division_code"),
        F.col("property_details.year_built").alias("year_built"),
    )
    year = F.avg(F.when(F.col("year_built") > 0, F.col("year_built"))).alias("average_year")
    return summary.distribution(records, ["division_code"], year).withColumns(
        {"percent": F.round("percent", 6), "average_year": F.round("average_year", 6)}
    )

"""Projection and scalar-function queries (P*)."""

from pyspark.sql import functions as F

from parcelmill.catalog.registry import Inputs, query
from parcelmill.functions import address, casts, dates, ids, names, text, values
from parcelmill.sources import tables
from parcelmill.sources.fixed_width import PROP, project_fields

CLEAN_NAME = r"upper(regexp_replace(regexp_replace(mailto, '^\s+|\s+$', '', 'g'), '\s+', ' ', 'g'))"


@query(
    "p1_strip_quotes",
    "fx_permits",
    r"""SELECT trim(acct, '"') AS acct, trim(id, '"') AS id, trim(status, '"') AS status,
        trim(dscr, '"') AS dscr, trim(permit_type, '"') AS permit_type, trim(yr, '"') AS yr,
        trim(site_num, '"') AS site_num FROM fx_permits""",
)
def p1(src: Inputs):
    return tables.strip_quoted_strings(src.view("fx_permits"))


@query(
    "p2_empty_to_null",
    "fx_real_acct fx_owners",
    """SELECT 'account' AS src, trim(acct) AS acct,
        CASE WHEN land_val <> '' THEN land_val END AS a, CASE WHEN tot_mkt_val <> '' THEN tot_mkt_val END AS b,
        CASE WHEN prior_land_val <> '' THEN prior_land_val END AS c FROM fx_real_acct
    UNION ALL SELECT 'owner', acct, CASE WHEN pct_own <> '' THEN pct_own END, NULL, NULL FROM fx_owners""",
)
def p2(src: Inputs):
    accounts = tables.empty_numbers_to_null(src.view("fx_real_acct")).select(
        F.lit("account").alias("src"),
        F.trim("acct").alias("acct"),
        F.col("land_val").alias("a"),
        F.col("tot_mkt_val").alias("b"),
        F.col("prior_land_val").alias("c"),
    )
    owners = tables.empty_numbers_to_null(src.view("fx_owners")).select(
        F.lit("owner").alias("src"), "acct", F.col("pct_own").alias("a")
    )
    return accounts.unionByName(owners, allowMissingColumns=True)


@query(
    "p3_upper_flags",
    "fx_real_acct",
    "SELECT trim(acct) AS acct, upper(noticed) AS noticed, upper(protested) AS protested FROM fx_real_acct",
)
def p3(src: Inputs):
    return tables.upper_flags(src.view("fx_real_acct")).select(
        F.trim("acct").alias("acct"), "noticed", "protested"
    )


@query(
    "p4_zip_characters",
    "fx_real_acct",
    "SELECT trim(acct) AS acct, regexp_replace(mail_zip, '[^0-9-]', '', 'g') AS mail_zip FROM fx_real_acct",
)
def p4(src: Inputs):
    return src.view("fx_real_acct").select(
        F.trim("acct").alias("acct"), address.zip_characters(F.col("mail_zip")).alias("mail_zip")
    )


@query(
    "p5_concat_addresses",
    "fx_real_acct",
    """SELECT trim(acct) AS acct, concat_ws(', ', mail_addr_1, mail_addr_2) AS full_mail_address,
        concat_ws(' ', str_num, str, str_sfx) AS full_property_address,
        concat_ws(' ', lgl_1, lgl_2) AS full_legal_description FROM fx_real_acct""",
)
def p5(src: Inputs):
    return tables.with_full_addresses(src.view("fx_real_acct")).select(
        F.trim("acct").alias("acct"),
        "full_mail_address",
        "full_property_address",
        "full_legal_description",
    )


@query(
    "p6_trim_owner",
    "fx_owners",
    r"""SELECT acct, ln_num, regexp_replace(name, '^\s+|\s+$', '', 'g') AS name,
        regexp_replace(aka, '^\s+|\s+$', '', 'g') AS aka FROM fx_owners""",
)
def p6(src: Inputs):
    return src.view("fx_owners").select(
        "acct",
        "ln_num",
        text.strip(F.col("name")).alias("name"),
        text.strip(F.col("aka")).alias("aka"),
    )


@query(
    "p7_owner_flags",
    "fx_owners",
    """SELECT acct, ln_num, ln_num = 1 AS is_primary_owner,
        try_cast(nullif(pct_own, '') AS double) >= 1 AS is_full_owner FROM fx_owners""",
)
def p7(src: Inputs):
    return tables.clean_owners(src.view("fx_owners")).select(
        "acct", "ln_num", "is_primary_owner", "is_full_owner"
    )


@query(
    "p8_match_name",
    "fx_owners",
    r"""SELECT acct, ln_num, regexp_replace(upper(trim(name)), '[^A-Z0-9\s]', '', 'g') AS name_normalized
    FROM fx_owners""",
)
def p8(src: Inputs):
    return tables.clean_owners(src.view("fx_owners")).select("acct", "ln_num", "name_normalized")


@query(
    "p9_account_id",
    "fx_real_acct fx_deeds fx_dallas_account fx_travis_prop",
    r"""SELECT 'harris' AS county, acct AS raw, lpad(trim(acct), 13, '0') AS account_id FROM fx_real_acct
    UNION ALL SELECT 'harris', acct, lpad(acct, 13, '0') FROM fx_deeds
    UNION ALL SELECT 'dallas', account_num, lpad(replace(account_num, '-', ''), 17, '0') FROM fx_dallas_account
    UNION ALL SELECT 'travis', substr(value, 1, 12), substr(value, 1, 12) FROM fx_travis_prop""",
)
def p9(src: Inputs):
    def ids_of(view, county, raw):
        return src.view(view).select(
            F.lit(county).alias("county"),
            raw.alias("raw"),
            ids.account_id(raw, county).alias("account_id"),
        )

    return (
        ids_of("fx_real_acct", "harris", F.col("acct"))
        .unionByName(ids_of("fx_deeds", "harris", F.col("acct")))
        .unionByName(ids_of("fx_dallas_account", "dallas", F.col("account_num")))
        .unionByName(ids_of("fx_travis_prop", "travis", F.col("value").substr(1, 12)))
    )


@query(
    "p10_safe_casts",
    "fx_real_acct fx_dallas_appraisal",
    """WITH raw AS (SELECT trim(acct) AS id, bld_ar AS a, prior_land_val AS b, yr_impr AS c FROM fx_real_acct
        UNION ALL SELECT cast(source_pos AS string), city_taxable_val, isd_taxable_val, county_split_pct
        FROM fx_dallas_appraisal)
    SELECT id, coalesce(cast(trunc(try_cast(replace(trim(a), ',', '') AS double)) AS bigint), 0) AS a_long,
        round(coalesce(try_cast(replace(trim(b), ',', '') AS double), 0), 6) AS b_double,
        coalesce(cast(trunc(try_cast(replace(trim(c), ',', '') AS double)) AS bigint), 0) AS c_long,
        coalesce(trim(c), '') AS c_text FROM raw""",
)
def p10(src: Inputs):
    raw = (
        src.view("fx_real_acct")
        .select(
            F.trim("acct").alias("id"),
            F.col("bld_ar").alias("a"),
            F.col("prior_land_val").alias("b"),
            F.col("yr_impr").alias("c"),
        )
        .union(
            src.view("fx_dallas_appraisal").select(
                F.col("source_pos").cast("string"),
                "city_taxable_val",
                "isd_taxable_val",
                "county_split_pct",
            )
        )
    )
    return raw.select(
        "id",
        casts.safe_long(F.col("a")).alias("a_long"),
        F.round(casts.safe_double(F.col("b")), 6).alias("b_double"),
        casts.safe_long(F.col("c")).alias("c_long"),
        text.text_or_empty(F.col("c")).alias("c_text"),
    )


@query(
    "p11_fixed_width_types",
    "fx_travis_prop",
    """WITH f AS (SELECT source_pos, trim(substr(value, 609, 52)) AS owner_name,
        trim(substr(value, 1821, 15)) AS assessed, trim(substr(value, 1836, 15)) AS land,
        trim(substr(value, 551, 20)) AS geo_id FROM fx_travis_prop)
    SELECT source_pos, nullif(owner_name, '') AS owner_name, nullif(geo_id, '') AS geo_id,
        CASE WHEN assessed = '' OR assessed SIMILAR TO '0*' THEN NULL
             ELSE cast(cast(assessed AS bigint) / 1e9 AS decimal(18,2)) END AS assessed_value_1,
        CASE WHEN land = '' OR land SIMILAR TO '0*' THEN NULL
             ELSE cast(cast(land AS bigint) / 1e9 AS decimal(18,2)) END AS land_value FROM f""",
)
def p11(src: Inputs):
    every_line = project_fields(
        src.view("fx_travis_prop"), PROP, keep=["source_pos"], usable_only=False
    )
    return every_line.select("source_pos", "owner_name", "geo_id", "assessed_value_1", "land_value")


@query(
    "p12_date_text",
    "fx_travis_prop",
    """WITH f AS (SELECT source_pos, nullif(trim(substr(value, 2001, 10)), '') AS d FROM fx_travis_prop)
    SELECT source_pos,
        CASE WHEN length(d) = 8 AND substr(d, 1, 2) BETWEEN '01' AND '12'
             THEN substr(d, 5, 4) || '-' || substr(d, 1, 2) || '-' || substr(d, 3, 2)
             WHEN length(d) = 8 THEN substr(d, 1, 4) || '-' || substr(d, 5, 2) || '-' || substr(d, 7, 2)
             WHEN length(d) = 10 THEN replace(d, '-', '/') ELSE d END AS assessment_date,
        CASE WHEN d IS NOT NULL THEN DATE '2025-01-31' END AS assessment_day FROM f""",
)
def p12(src: Inputs):
    raw = F.nullif(F.trim(F.col("value").substr(2001, 10)), F.lit(""))
    return src.view("fx_travis_prop").select(
        "source_pos",
        dates.date_text(raw).alias("assessment_date"),
        dates.date_value(raw).alias("assessment_day"),
    )


@query(
    "p13_tax_year",
    "fx_travis_prop fx_travis_ent",
    """SELECT 'prop' AS src, source_pos, CASE WHEN substr(value, 18, 5) LIKE '0____'
            THEN cast(substr(value, 19, 4) AS int) ELSE 2025 END AS tax_year FROM fx_travis_prop
    UNION ALL SELECT 'ent', source_pos, 2025 FROM fx_travis_ent""",
)
def p13(src: Inputs):
    def years(view, label, start, size):
        raw = F.col("value").substr(start, size)
        return src.view(view).select(
            F.lit(label).alias("src"), "source_pos", dates.tax_year(raw).alias("tax_year")
        )

    return years("fx_travis_prop", "prop", 18, 5).unionByName(years("fx_travis_ent", "ent", 13, 4))


@query(
    "p14_value_change",
    "fx_real_acct",
    """WITH v AS (SELECT trim(acct) AS acct, cast(land_val AS decimal(18,2)) AS c,
        CASE WHEN coalesce(trim(prior_land_val), '') = '' THEN 0
             ELSE try_cast(prior_land_val AS decimal(18,2)) END AS p FROM fx_real_acct)
    SELECT acct, cast(c - p AS decimal(18,2)) AS dollar_change,
        CASE WHEN p <> 0 THEN cast(round_even((c - p) * 100 / p, 2) AS decimal(18,2)) END AS percent_change
    FROM v""",
)
def p14(src: Inputs):
    change = values.value_change(F.col("land_val"), F.col("prior_land_val"))
    return src.view("fx_real_acct").select(
        F.trim("acct").alias("acct"), change.alias("change")
    ).select("acct", "change.dollar_change", "change.percent_change")


_SHORT = (
    "AVENUE AVE|BOULEVARD BLVD|CIRCLE CIR|COURT CT|DRIVE DR|LANE LN|PLACE PL|ROAD RD|STREET ST|TRAIL TRL|"
    "NORTH N|SOUTH S|EAST E|WEST W|NORTHEAST NE|NORTHWEST NW|SOUTHEAST SE|SOUTHWEST SW"
)


def _short_words_sql(expr: str) -> str:
    for pair in _SHORT.split("|"):
        full, short = pair.split()
        expr = rf"regexp_replace({expr}, '\b{full}\b', '{short}', 'g')"
    return expr


_ADDRESS_SQL = (
    r"trim(regexp_replace(regexp_replace("
    + _short_words_sql("upper(trim({col}))")
    + r", '\s+', ' ', 'g'), '[^\w\s-]', '', 'g'))"
)


@query(
    "p15_address_standardise",
    "fx_real_acct",
    "SELECT trim(acct) AS acct, "
    + _ADDRESS_SQL.replace("{col}", "mail_addr_1")
    + " AS mail_cleaned, "
    + _ADDRESS_SQL.replace("{col}", "concat_ws(' ', str_num, str, str_sfx)")
    + " AS site_cleaned, "
    + _ADDRESS_SQL.replace("{col}", "mail_addr_2")
    + " AS line2_cleaned FROM fx_real_acct",
)
def p15(src: Inputs):
    return src.view("fx_real_acct").select(
        F.trim("acct").alias("acct"),
        address.standard_address(F.col("mail_addr_1")).alias("mail_cleaned"),
        address.standard_address(F.concat_ws(" ", "str_num", "str", "str_sfx")).alias("site_cleaned"),
        address.standard_address(F.col("mail_addr_2")).alias("line2_cleaned"),
    )


@query(
    "p16_zip_extract",
    "fx_real_acct",
    r"""SELECT trim(acct) AS acct, nullif(regexp_extract(mail_zip, '(\d{5}(?:-\d{4})?)', 1), '') AS zip_cleaned,
        nullif(regexp_extract(mail_zip, '(\d{5})', 1), '') AS zip_5digit,
        nullif(regexp_extract(site_addr_2, '(\d{5})', 1), '') AS no_zip FROM fx_real_acct""",
)
def p16(src: Inputs):
    return src.view("fx_real_acct").select(
        F.trim("acct").alias("acct"),
        address.zip_full(F.col("mail_zip")).alias("zip_cleaned"),
        address.zip5(F.col("mail_zip")).alias("zip_5digit"),
        address.zip5(F.col("site_addr_2")).alias("no_zip"),
    )


def _named(src: Inputs):
    return src.view("fx_real_acct").select(
        F.trim("acct").alias("acct"), names.standard_name(F.col("mailto")).alias("name")
    )


_NAMED_SQL = f"WITH n AS (SELECT trim(acct) AS acct, {CLEAN_NAME} AS name FROM fx_real_acct) "


@query("p17_name_standardise", "fx_real_acct", _NAMED_SQL + "SELECT acct, name FROM n")
def p17(src: Inputs):
    return _named(src)


_ENTITY = (
    r"(?:^|[^A-Z0-9_])(LIMITED LIABILITY COMPANY|LIMITED PARTNERSHIP|INCORPORATED|CORPORATION|PARTNERSHIP|"
    r"FOUNDATION|PARTNERS|COMPANY|LIMITED|ESTATE|TRUST|CORP|L\.P\.|INC|LLC|LTD|CO|LP)(?:$|[^A-Z0-9_])"
)


@query(
    "p18_entity_words",
    "fx_real_acct",
    _NAMED_SQL
    + f"""SELECT acct, regexp_matches(name, '{_ENTITY}') AS is_business_entity,
    nullif(regexp_extract(name, '{_ENTITY}', 1), '') AS entity_type FROM n""",
)
def p18(src: Inputs):
    return _named(src).select(
        "acct",
        names.is_entity(F.col("name")).alias("is_business_entity"),
        names.entity_word(F.col("name")).alias("entity_type"),
    )


@query(
    "p19_likely_business",
    "fx_real_acct fx_owners",
    _NAMED_SQL
    + f""", both_sides AS (SELECT acct, 0 AS ln_num, name FROM n UNION ALL
        SELECT acct, ln_num, upper(trim(name)) FROM fx_owners)
    SELECT acct, ln_num, regexp_matches(name, '{_ENTITY}') OR regexp_matches(name,
    '\\b(PROPERTIES|INVESTMENTS|HOLDINGS|VENTURES|DEVELOPMENT|REAL ESTATE|MANAGEMENT|ASSOCIATES|PARTNERS|GROUP)\\b')
    AS is_likely_business FROM both_sides""",
)
def p19(src: Inputs):
    owners = src.view("fx_owners").select(
        "acct", "ln_num", names.standard_name(F.col("name")).alias("name")
    )
    both = _named(src).withColumn("ln_num", F.lit(0)).unionByName(owners)
    return both.select(
        "acct", "ln_num", names.is_likely_business(F.col("name")).alias("is_likely_business")
    )


_LAST_FIRST = r"^([A-Z\s]+),\s*([A-Z\s]+)"


@query(
    "p20_split_names",
    "fx_real_acct",
    _NAMED_SQL
    + rf"""SELECT acct, nullif(regexp_extract(name, '{_LAST_FIRST}', 1), '') AS last_name_parsed,
    nullif(regexp_extract(name, '{_LAST_FIRST}', 2), '') AS first_name_parsed FROM n""",
)
def p20(src: Inputs):
    return _named(src).select(
        "acct",
        names.last_name(F.col("name")).alias("last_name_parsed"),
        names.first_name(F.col("name")).alias("first_name_parsed"),
    )


@query(
    "p21_related_owner_key",
    "fx_real_acct",
    _NAMED_SQL
    + rf"""SELECT acct, coalesce(nullif(regexp_extract(name, '{_LAST_FIRST}', 1), ''),
    nullif(regexp_extract(name, '^(\w+)', 1), '')) AS matching_key FROM n""",
)
def p21(src: Inputs):
    return _named(src).select("acct", names.related_owner_key(F.col("name")).alias("matching_key"))


@query(
    "p22_trust_names",
    "fx_real_acct",
    _NAMED_SQL
    + r"""SELECT acct, CASE WHEN name LIKE '% ESTATE OF' THEN 'ESTATE OF ' || left(name, length(name) - 10)
    ELSE name END AS trust_name FROM n""",
)
def p22(src: Inputs):
    return _named(src).select("acct", names.standard_trust_name(F.col("name")).alias("trust_name"))


@query(
    "p23_division_type",
    "fx_dallas_account",
    """SELECT account_num, CASE WHEN division_cd IS NULL THEN 'Unknown' WHEN upper(division_cd) = 'RES'
    THEN 'Residential' WHEN upper(division_cd) = 'COM' THEN 'Commercial'
    ELSE 'Other (' || division_cd || ')' END AS property_type FROM fx_dallas_account""",
)
def p23(src: Inputs):
    return src.view("fx_dallas_account").select(
        "account_num", values.division_type(F.col("division_cd")).alias("property_type")
    )


@query(
    "p24_address_builders",
    "fx_dallas_account",
    """SELECT account_num, concat_ws(' ', nullif(street_num, ''), nullif(street_half_num, ''), full_street_name,
        'Bldg ' || bldg_id, 'Unit ' || nullif(unit_id, '')) AS street_address,
        concat_ws(' ', legal1, legal2) AS legal_description,
        nullif(concat_ws(' ', full_street_name, legal2), '') AS name_and_type FROM fx_dallas_account""",
)
def p24(src: Inputs):
    return src.view("fx_dallas_account").select(
        "account_num",
        address.numbered_street(
            F.col("street_num"),
            F.col("street_half_num"),
            F.col("full_street_name"),
            F.col("bldg_id"),
            F.col("unit_id"),
        ).alias("street_address"),
        text.join_present(" ", F.col("legal1"), F.col("legal2")).alias("legal_description"),
        address.street_with_type(F.col("full_street_name"), F.col("legal2")).alias("name_and_type"),
    )


@query(
    "p25_yes_flags",
    "fx_real_acct fx_dallas_res",
    """SELECT 'account' AS src, trim(acct) AS id, upper(noticed) = 'Y' AS flag_a,
        coalesce(upper(protested) = 'Y', false) AS flag_b FROM fx_real_acct
    UNION ALL SELECT 'res', cast(source_pos AS string), coalesce(pool_ind = 'Y', false), false FROM fx_dallas_res""",
)
def p25(src: Inputs):
    accounts = src.view("fx_real_acct").select(
        F.lit("account").alias("src"),
        F.trim("acct").alias("id"),
        text.is_yes(F.upper("noticed")).alias("flag_a"),
        text.is_yes(F.upper("protested")).alias("flag_b"),
    )
    homes = src.view("fx_dallas_res").select(
        F.lit("res").alias("src"),
        F.col("source_pos").cast("string").alias("id"),
        text.is_yes(F.col("pool_ind")).alias("flag_a"),
        F.lit(False).alias("flag_b"),
    )
    return accounts.unionByName(homes)


@query(
    "p26_acres_to_sq_ft",
    "fx_dallas_account",
    """SELECT account_num, round(coalesce(try_cast(acreage AS double), 0) * 43560, 6) AS sq_ft
    FROM fx_dallas_account""",
)
def p26(src: Inputs):
    acres = casts.safe_double(F.col("acreage"))
    return src.view("fx_dallas_account").select(
        "account_num", F.round(values.acres_to_sq_ft(acres), 6).alias("sq_ft")
    )


@query(
    "p27_effective_value",
    "fx_gold",
    """SELECT county, account_id, CASE WHEN market_value > 0 AND market_value < 100000000 THEN market_value
        WHEN total_market_value > 0 AND total_market_value < 100000000 THEN total_market_value
        ELSE assessed_value END AS effective_value FROM fx_gold""",
)
def p27(src: Inputs):
    return src.view("fx_gold").select(
        "county",
        "account_id",
        values.effective_value(
            F.col("market_value"), F.col("total_market_value"), F.col("assessed_value")
        ).alias("effective_value"),
    )


@query(
    "p28_repaired_value",
    "fx_gold",
    """WITH v AS (SELECT county, account_id, coalesce(nullif(market_value, 0), nullif(total_market_value, 0),
        nullif(assessed_value, 0)) AS raw FROM fx_gold)
    SELECT county, account_id, CASE WHEN raw > 10000000000 AND raw / 1e8 < 1e8
            THEN cast(raw / 1e8 AS decimal(18,2))
        WHEN raw > 0 AND raw < 100000000 THEN raw ELSE cast(0 AS decimal(18,2)) END AS market_value FROM v""",
)
def p28(src: Inputs):
    return src.view("fx_gold").select(
        "county",
        "account_id",
        values.repaired_value(
            F.col("market_value"), F.col("total_market_value"), F.col("assessed_value")
        ).alias("market_value"),
    )


@query(
    "p29_owner_address_labels",
    "fx_gold fx_real_acct",
    """SELECT county, account_id, CASE WHEN owner_name <> '' THEN owner_name ELSE 'Unknown Owner' END AS owner,
        coalesce(city, 'No Address') AS address FROM fx_gold
    UNION ALL SELECT 'raw', trim(acct), mailto, site_addr_1 || ', ' || site_addr_2 FROM fx_real_acct""",
)
def p29(src: Inputs):
    missing = F.lit(None).cast("string")
    gold = src.view("fx_gold").select(
        "county",
        "account_id",
        values.owner_label(F.col("owner_name"), missing).alias("owner"),
        values.address_label(missing, missing, F.col("city")).alias("address"),
    )
    raw = src.view("fx_real_acct").select(
        F.lit("raw").alias("county"),
        F.trim("acct").alias("account_id"),
        values.owner_label(F.col("mailto"), missing).alias("owner"),
        values.address_label(F.col("site_addr_1"), F.col("site_addr_2"), missing).alias("address"),
    )
    return gold.unionByName(raw)


@query(
    "p30_county_property_type",
    "fx_gold",
    """SELECT county, account_id, CASE WHEN county = 'dallas' THEN 'division ' || property_type
        WHEN county = 'travis' THEN property_type ELSE 'class ' || property_type END AS property_type FROM fx_gold""",
)
def p30(src: Inputs):
    kind = F.col("property_type")
    return src.view("fx_gold").select(
        "county",
        "account_id",
        values.county_property_type(
            F.col("county"),
            kind,
            F.concat(F.lit("division "), kind),
            F.concat(F.lit("class "), kind),
        ).alias("property_type"),
    )

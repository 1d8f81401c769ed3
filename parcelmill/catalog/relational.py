"""Join, summary, ranking, set and search queries (J*, W*, L*, A1-A10, U*, F*)."""

from pyspark.sql import functions as F

from parcelmill.catalog import files
from parcelmill.catalog.registry import Inputs, query
from parcelmill.functions import casts, text
from parcelmill.functions.ids import account_id
from parcelmill.operators import joins, keyed, sampling, search, summary
from parcelmill.plans import travis
from parcelmill.session import scratch_path
from parcelmill.sources import search_index, tables
from parcelmill.sources.fixed_width import AGENT, IMPROVEMENT, PROP, SUBDIVISION, project_fields


def harris_rows(df):
    """Rows with an account id, in its full width."""
    return keyed.split_by_id(df, "acct")[0].withColumn("acct", account_id(F.col("acct"), "harris"))


def harris_accounts(src: Inputs):
    return harris_rows(src.view("fx_real_acct"))


def harris_children(src: Inputs, view: str):
    return harris_rows(src.view(view))


def typed_accounts(src: Inputs):
    return tables.clean_accounts(harris_accounts(src)).select(
        "acct",
        casts.money(F.col("tot_mkt_val")).alias("tot_appr_val"),
        casts.number_or_null(F.col("yr_impr"), "int").alias("yr_impr"),
        "mail_addr_1",
        "site_addr_1",
        "market_area_1",
        "market_area_1_dscr",
        text.blank_to_null(F.col("school_dist")).alias("school_dist"),
    )


A = "lpad(trim(acct), 13, '0')"


@query(
    "j1_accounts_owners",
    "fx_real_acct fx_owners",
    f"""SELECT {A.replace('acct', 'a.acct')} AS acct, a.mailto, a.market_area_1, o.ln_num, o.name, o.pct_own
    FROM fx_real_acct a LEFT JOIN fx_owners o ON trim(a.acct) = o.acct""",
)
def j1(src: Inputs):
    accounts = harris_accounts(src).select("acct", "mailto", "market_area_1")
    owners = harris_children(src, "fx_owners").select("acct", "ln_num", "name", "pct_own")
    return joins.fan_out_left_join(accounts, owners, "acct")


@query(
    "j2_primary_owner",
    "fx_real_acct fx_owners",
    f"""SELECT {A.replace('acct', 'a.acct')} AS acct, o.name AS primary_owner_name, o.aka AS primary_owner_aka,
        o.pct_own AS primary_ownership_pct
    FROM fx_real_acct a LEFT JOIN (SELECT * FROM fx_owners WHERE ln_num = 1) o ON trim(a.acct) = o.acct""",
)
def j2(src: Inputs):
    primary = joins.primary_owner(harris_children(src, "fx_owners"), "acct")
    return harris_accounts(src).select("acct").join(primary, "acct", "left")


@query(
    "j3_neighbourhood_lookup",
    "fx_real_acct fx_nbhd",
    f"""SELECT {A.replace('acct', 'a.acct')} AS acct, a.market_area_1, n.grp_cd AS neighborhood_group,
        n.dscr AS neighborhood_description
    FROM fx_real_acct a LEFT JOIN fx_nbhd n ON a.market_area_1 = cast(n.cd AS string)""",
)
def j3(src: Inputs):
    codes = src.view("fx_nbhd").select(
        "cd",
        F.col("grp_cd").alias("neighborhood_group"),
        F.col("dscr").alias("neighborhood_description"),
    )
    return joins.lookup_join(
        harris_accounts(src).select("acct", "market_area_1"), codes, "market_area_1", "cd"
    )


@query(
    "j4_mineral_flag",
    "fx_real_acct fx_mineral",
    f"""SELECT {A.replace('acct', 'a.acct')} AS acct,
        trim(a.acct) IN (SELECT acct FROM fx_mineral) AS has_mineral_rights FROM fx_real_acct a""",
)
def j4(src: Inputs):
    return joins.with_existence_flag(
        harris_accounts(src).select("acct"),
        harris_children(src, "fx_mineral"),
        "acct",
        "has_mineral_rights",
    )


@query(
    "j5_child_counts",
    "fx_real_acct fx_owners fx_deeds fx_permits",
    f"""SELECT {A.replace('acct', 'a.acct')} AS acct, o.n AS total_owners, d.n AS total_deeds, p.n AS total_permits
    FROM fx_real_acct a
    LEFT JOIN (SELECT acct, count(*) AS n FROM fx_owners GROUP BY acct) o ON trim(a.acct) = o.acct
    LEFT JOIN (SELECT cast(cast(acct AS bigint) AS string) AS acct, count(*) AS n FROM fx_deeds GROUP BY 1) d
        ON trim(a.acct) = d.acct
    LEFT JOIN (SELECT acct, count(*) AS n FROM fx_permits GROUP BY acct) p ON trim(a.acct) = p.acct""",
)
def j5(src: Inputs):
    out = harris_accounts(src).select("acct")
    for view, name in [
        ("fx_owners", "total_owners"),
        ("fx_deeds", "total_deeds"),
        ("fx_permits", "total_permits"),
    ]:
        out = joins.with_child_count(out, harris_children(src, view), "acct", name)
    return out


@query(
    "j7_semi_prefilter",
    "fx_travis_prop fx_travis_imp",
    """SELECT substr(i.value, 1, 12) AS account_id, ltrim(substr(i.value, 13, 10), ' ') AS improvement_id,
        trim(substr(i.value, 43, 20)) AS improvement_class FROM fx_travis_imp i
    WHERE substr(i.value, 1, 12) IN (SELECT substr(value, 1, 12) FROM fx_travis_prop
        WHERE substr(value, 13, 1) = 'R') AND substr(i.value, 1, 12) <> '000000000000'""",
)
def j7(src: Inputs):
    # the key is cut from the raw line first, so unselected lines are never parsed
    key = F.col("value").substr(1, 12)
    selected = src.view("fx_travis_prop").filter(F.col("value").substr(13, 1) == "R")
    lines = joins.keep_keys_of(
        src.view("fx_travis_imp").withColumn("raw_key", key),
        selected.select(key.alias("raw_key")),
        "raw_key",
    )
    return project_fields(lines, IMPROVEMENT).select(
        "account_id", "improvement_id", "improvement_class"
    )


@query(
    "j8_dictionary_lookup",
    "fx_travis_prop fx_travis_subd",
    """WITH p AS (SELECT substr(value, 1, 12) AS account_id,
        'S' || cast(cast(substr(value, 1, 12) AS bigint) % 30 AS string) AS subdivision_id FROM fx_travis_prop
        WHERE substr(value, 1, 12) <> '000000000000')
    SELECT account_id, p.subdivision_id, trim(substr(s.value, 13, 50)) AS subdivision_name
    FROM p LEFT JOIN fx_travis_subd s ON p.subdivision_id = trim(substr(s.value, 1, 12))""",
)
def j8(src: Inputs):
    lots = project_fields(src.view("fx_travis_prop"), PROP).select(
        "account_id",
        F.concat(F.lit("S"), F.col("account_id").cast("bigint") % 30).alias("subdivision_id"),
    )
    # a file in which each code was written twice, the earlier line outdated
    now = src.view("fx_travis_subd").select(F.lit(1).alias("turn"), "value")
    old = now.select(F.lit(0).alias("turn"), F.overlay("value", F.rpad(F.lit("OLD"), 50, " "), 13).alias("value"))
    lines = files.reread_lines(old.unionByName(now), "j8", ["turn", "value"])
    codes = travis.subdivision_codes(lines).select(
        F.col("subdivision_id").alias("code"), "subdivision_name"
    )
    return joins.lookup_join(lots, codes, "subdivision_id", "code")


@query(
    "j9_agent_reference",
    "fx_travis_prop fx_travis_agent",
    """SELECT substr(value, 1, 12) AS account_id, (SELECT count(*) FROM fx_travis_agent
        WHERE trim(substr(value, 1, 12)) <> '0') AS agent_count
    FROM fx_travis_prop WHERE substr(value, 1, 12) <> '000000000000'""",
)
def j9(src: Inputs):
    agents = project_fields(src.view("fx_travis_agent"), AGENT)
    lots = project_fields(src.view("fx_travis_prop"), PROP).select("account_id")
    return lots.withColumn("agent_count", agents.agg(F.count(F.lit(1))).scalar())


@query(
    "w1_first_per_key",
    "fx_dallas_appraisal fx_dallas_res fx_dallas_com fx_dallas_land",
    """WITH r AS (SELECT 'appraisal' AS src, account_num, land_val AS v, source_pos FROM fx_dallas_appraisal
        UNION ALL SELECT 'res', account_num, tot_main_sf, source_pos FROM fx_dallas_res
        UNION ALL SELECT 'com', account_num, gross_bldg_area, source_pos FROM fx_dallas_com
        UNION ALL SELECT 'land', account_num, area_size, source_pos FROM fx_dallas_land)
    SELECT src, account_num, v, source_pos FROM r
    QUALIFY row_number() OVER (PARTITION BY src, account_num ORDER BY source_pos) = 1""",
)
def w1(src: Inputs):
    def first(view, label, value):
        rows = src.view(view).select(
            F.lit(label).alias("src"), "account_num", F.col(value).alias("v"), "source_pos"
        )
        # the place in the file decides; the sample's own number goes along as data
        read = files.reread(rows, f"w1-{label}", ["source_pos"], position="place")
        return keyed.first_per_key(read, ["account_num"], "place").drop("place").withColumn(
            "source_pos", F.col("source_pos").cast("bigint")
        )

    return (
        first("fx_dallas_appraisal", "appraisal", "land_val")
        .unionByName(first("fx_dallas_res", "res", "tot_main_sf"))
        .unionByName(first("fx_dallas_com", "com", "gross_bldg_area"))
        .unionByName(first("fx_dallas_land", "land", "area_size"))
    )


@query(
    "w2_last_per_key",
    "fx_mineral",
    """SELECT lpad(acct, 13, '0') AS acct, dor_cd, type_interest, interest_percent FROM fx_mineral
    QUALIFY row_number() OVER (PARTITION BY acct ORDER BY source_pos DESC) = 1""",
)
def w2(src: Inputs):
    rows = src.view("fx_mineral")
    fields = [c for c in rows.columns if c != "source_pos"]
    read = harris_rows(files.reread(rows, "w2", ["source_pos"], fields))
    return keyed.last_per_key(read, ["acct"], "source_pos").drop("source_pos")


TYPED = f"""WITH t AS (SELECT {A} AS acct, try_cast(nullif(trim(tot_mkt_val), '') AS decimal(18,2)) AS tot_appr_val,
    try_cast(nullif(trim(yr_impr), '') AS int) AS yr_impr, mail_addr_1, site_addr_1, market_area_1,
    market_area_1_dscr, nullif(trim(school_dist), '') AS school_dist FROM fx_real_acct) """


@query(
    "a1_account_summary",
    "fx_real_acct",
    TYPED
    + """SELECT count(*) AS total_records, count(DISTINCT acct) AS unique_accounts,
    round(avg(tot_appr_val), 4) AS avg_value, max(tot_appr_val) AS max_value, min(tot_appr_val) AS min_value,
    min(yr_impr) AS min_year, max(yr_impr) AS max_year, round(median(cast(tot_appr_val AS double)), 4) AS median_value
    FROM t""",
)
def a1(src: Inputs):
    return summary.account_summary(typed_accounts(src)).withColumns(
        {
            "avg_value": F.round(F.col("avg_value").cast("double"), 4),
            "median_value": F.round("median_value", 4),
        }
    )


@query(
    "a2_missing_percent",
    "fx_real_acct fx_owners",
    TYPED
    + " UNION ALL ".join(
        f"SELECT 'account' AS src, '{c}' AS field, round(avg(CASE WHEN {c} IS NULL THEN 100.0 ELSE 0 END), 6) "
        "AS missing_pct FROM t"
        for c in ["mail_addr_1", "site_addr_1", "yr_impr", "tot_appr_val"]
    )
    + """ UNION ALL SELECT 'owner', 'name', round(avg(CASE WHEN name IS NULL THEN 100.0 ELSE 0 END), 6) FROM fx_owners
    UNION ALL SELECT 'owner', 'pct_own', round(avg(CASE WHEN pct_own = '' THEN 100.0 ELSE 0 END), 6) FROM fx_owners""",
)
def a2(src: Inputs):
    accounts = summary.missing_percent(
        typed_accounts(src), ["mail_addr_1", "site_addr_1", "yr_impr", "tot_appr_val"]
    ).withColumn("src", F.lit("account"))
    owners = summary.missing_percent(
        tables.clean_owners(src.view("fx_owners")), ["name", "pct_own"]
    ).withColumn("src", F.lit("owner"))
    return accounts.unionByName(owners).withColumn("missing_pct", F.round("missing_pct", 6))


@query(
    "a3_owner_summary",
    "fx_owners",
    """WITH o AS (SELECT acct, trim(name) AS name, try_cast(nullif(pct_own, '') AS double) AS p FROM fx_owners)
    SELECT count(*) AS total_records, count(DISTINCT acct) AS unique_accounts,
    count(DISTINCT coalesce(name, '<null>')) AS unique_owners, round(avg(p), 6) AS avg_ownership_pct,
    count(*) FILTER (p >= 1) AS full_ownership_count, count(*) FILTER (p < 1) AS partial_ownership_count FROM o""",
)
def a3(src: Inputs):
    owners = tables.clean_owners(src.view("fx_owners"))
    return summary.owner_summary(owners).withColumn(
        "avg_ownership_pct", F.round("avg_ownership_pct", 6)
    )


@query(
    "a4_multiple_owners",
    "fx_owners",
    "SELECT lpad(acct, 13, '0') AS acct, count(*) AS owner_count FROM fx_owners GROUP BY acct HAVING count(*) > 1",
)
def a4(src: Inputs):
    return summary.accounts_with_many(harris_children(src, "fx_owners"), "acct")


@query(
    "a5_county_distribution",
    "fx_gold",
    """SELECT county, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM fx_gold), 6) AS percent
    FROM fx_gold GROUP BY county""",
)
def a5(src: Inputs):
    return summary.distribution(src.view("fx_gold"), ["county"]).withColumn(
        "percent", F.round("percent", 6)
    )


_EFFECTIVE = """CASE WHEN market_value > 0 AND market_value < 100000000 THEN market_value
    WHEN total_market_value > 0 AND total_market_value < 100000000 THEN total_market_value
    ELSE assessed_value END"""
_USABLE = """(market_value > 0 AND market_value < 100000000) OR (total_market_value > 0 AND total_market_value
    < 100000000) OR (assessed_value > 0 AND assessed_value < 100000000)"""


@query(
    "a6_value_statistics",
    "fx_gold",
    f"""SELECT round(avg({_EFFECTIVE}), 4) AS avg_value, min({_EFFECTIVE}) AS min_value,
    max({_EFFECTIVE}) AS max_value, count(*) AS count FROM fx_gold WHERE {_USABLE}""",
)
def a6(src: Inputs):
    stats = summary.value_statistics(
        src.view("fx_gold"), "market_value", "total_market_value", "assessed_value"
    )
    return stats.withColumn("avg_value", F.round(F.col("avg_value").cast("double"), 4))


@query(
    "a7_view_statistics",
    "fx_gold",
    """WITH v AS (SELECT cast(floor(CASE WHEN market_value <> 0 THEN market_value ELSE total_market_value END)
        AS bigint) AS v FROM fx_gold WHERE CASE WHEN market_value <> 0 THEN market_value
        ELSE total_market_value END > 0),
    r AS (SELECT v, row_number() OVER (ORDER BY v) AS i, count(*) OVER () AS n FROM v)
    SELECT count(*) AS with_value, cast(floor(sum(v) / count(*)) AS bigint) AS average, min(v) AS lowest,
    max(v) AS highest, max(v) FILTER (i = n // 2 + 1) AS median FROM r""",
)
def a7(src: Inputs):
    return summary.view_statistics(src.view("fx_gold"), "market_value", "total_market_value")


@query(
    "a8_tax_entity_counts",
    "fx_gold",
    """SELECT round(avg(n_tax_entities), 6) AS average, min(n_tax_entities) AS lowest,
    max(n_tax_entities) AS highest FROM fx_gold""",
)
def a8(src: Inputs):
    return summary.spread(src.view("fx_gold"), F.col("n_tax_entities")).withColumn(
        "average", F.round("average", 6)
    )


@query(
    "a9_year_built",
    "fx_gold fx_dallas_res",
    """SELECT 'store' AS src, round(avg(year_built), 6) AS average, min(year_built) AS lowest,
        max(year_built) AS highest FROM fx_gold WHERE year_built > 0
    UNION ALL SELECT 'dallas', round(avg(cast(yr_built AS int)), 6), min(cast(yr_built AS int)),
        max(cast(yr_built AS int)) FROM fx_dallas_res WHERE yr_built IS NOT NULL""",
)
def a9(src: Inputs):
    store = summary.positive_spread(src.view("fx_gold"), F.col("year_built"))
    homes = src.view("fx_dallas_res").select(casts.safe_int(F.col("yr_built")).alias("y"))
    dallas = summary.positive_spread(homes, F.col("y"))
    return (
        store.withColumn("src", F.lit("store"))
        .unionByName(dallas.withColumn("src", F.lit("dallas")))
        .withColumn("average", F.round("average", 6))
    )


@query(
    "l1_top_groups",
    "fx_real_acct",
    """(SELECT 'market' AS dimension, market_area_1_dscr AS value, count(*) AS count FROM fx_real_acct GROUP BY 2
        ORDER BY 3 DESC, 2 NULLS FIRST LIMIT 10)
    UNION ALL (SELECT 'school', nullif(trim(school_dist), ''), count(*) FROM fx_real_acct GROUP BY 2
        ORDER BY 3 DESC, 2 NULLS FIRST LIMIT 10)""",
)
def l1(src: Inputs):
    def top(column, label):
        return summary.top_groups(typed_accounts(src), column, 10).select(
            F.lit(label).alias("dimension"), F.col(column).alias("value"), "count"
        )

    return top("market_area_1_dscr", "market").unionByName(top("school_dist", "school"))


@query(
    "l2_top_business_owners",
    "fx_owners fx_real_acct",
    """(SELECT 'owners' AS src, trim(name) AS name, count(*) AS count FROM fx_owners
        WHERE regexp_matches(name, 'LLC|INC|CORP|TRUST|ESTATE') GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)
    UNION ALL (SELECT 'mailto', mailto, count(*) FROM fx_real_acct
        WHERE regexp_matches(mailto, 'LLC|INC|CORP|TRUST|ESTATE') GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 10)""",
)
def l2(src: Inputs):
    owners = tables.clean_owners(src.view("fx_owners"))
    mail = src.view("fx_real_acct").select(F.col("mailto").alias("name"))
    return (
        summary.common_business_owners(owners)
        .withColumn("src", F.lit("owners"))
        .unionByName(summary.common_business_owners(mail).withColumn("src", F.lit("mailto")))
    )


@query(
    "l3_top5_per_county",
    "fx_gold",
    """WITH g AS (SELECT county, property_type, count(*) AS count FROM fx_gold GROUP BY ALL)
    SELECT county, property_type, count FROM g
    QUALIFY row_number() OVER (PARTITION BY county ORDER BY count DESC, property_type) <= 5""",
)
def l3(src: Inputs):
    return summary.top_groups_per(src.view("fx_gold"), "county", "property_type", 5)


@query(
    "l4_head_with_children",
    "fx_dallas_account fx_dallas_appraisal",
    """WITH h AS (SELECT account_num FROM fx_dallas_account ORDER BY source_pos LIMIT 20)
    SELECT a.account_num, a.land_val, a.tot_val, a.source_pos FROM fx_dallas_appraisal a
    WHERE a.account_num IN (SELECT account_num FROM h)""",
)
def l4(src: Inputs):
    head = sampling.head_by_position(src.view("fx_dallas_account"), "source_pos", 20)
    return joins.keep_keys_of(
        src.view("fx_dallas_appraisal"), head, "account_num"
    ).select("account_num", "land_val", "tot_val", "source_pos")


@query(
    "l5_random_sample",
    "fx_gold",
    """SELECT county, account_id, owner_name FROM fx_gold WHERE county = 'travis'
    ORDER BY md5('s1|' || account_id), account_id LIMIT 50""",
)
def l5(src: Inputs):
    travis = search.in_county(src.view("fx_gold"), "Travis")
    return sampling.random_sample(travis, "account_id", 50, "s1").select(
        "county", "account_id", "owner_name"
    )


@query(
    "l6_sample_per_county",
    "fx_gold",
    """SELECT county, account_id, owner_name FROM fx_gold
    QUALIFY row_number() OVER (PARTITION BY county ORDER BY md5('s2|' || account_id), account_id) <= 25""",
)
def l6(src: Inputs):
    return sampling.random_sample_per(src.view("fx_gold"), "county", "account_id", 25, "s2").select(
        "county", "account_id", "owner_name"
    )


@query(
    "f1_county_filter",
    "fx_gold",
    "SELECT county, account_id, owner_name, city FROM fx_gold WHERE county = 'dallas'",
)
def f1(src: Inputs):
    return search.in_county(src.view("fx_gold"), "Dallas").select(
        "county", "account_id", "owner_name", "city"
    )


@query(
    "f2_substring_search",
    "fx_gold",
    """SELECT county, account_id, owner_name, city FROM fx_gold WHERE lower(county) LIKE '%#12%'
    OR lower(account_id) LIKE '%#12%' OR lower(coalesce(nullif(owner_name, ''), 'Unknown Owner')) LIKE '%#12%'
    OR lower(coalesce(city, 'No Address')) LIKE '%#12%'
    UNION ALL SELECT county, account_id, owner_name, city FROM fx_gold
    WHERE county = 'travis' AND owner_name = ''""",
)
def f2(src: Inputs):
    from parcelmill.functions.values import owner_label

    gold = src.view("fx_gold").select("county", "account_id", "owner_name", "city")
    columns = [
        F.col("county"),
        F.col("account_id"),
        owner_label(F.col("owner_name"), F.lit(None).cast("string")),
        F.coalesce("city", F.lit("No Address")),
    ]
    path = scratch_path(src.spark, "f2")
    search_index.build_text_index(gold, "account_id", columns, path)
    first, second = (search_index.containing(src.spark, path, t) for t in (" #12 ", "UNKNOWN owner"))
    found = search_index.matching(gold, "account_id", first)
    return found.unionByName(search_index.matching(gold, "account_id", second))


@query(
    "f3_equality_filter",
    "fx_gold",
    """SELECT county, account_id, city, property_type FROM fx_gold
    WHERE county = 'harris' AND city = 'HOUSTON' AND property_type = 'BUILDING'
    ORDER BY account_id LIMIT 100""",
)
def f3(src: Inputs):
    wanted = {"county": "harris", "city": "HOUSTON", "property_type": "BUILDING"}
    hits = search.equal_to_all(src.view("fx_gold"), wanted)
    return hits.select("county", "account_id", "city", "property_type").orderBy("account_id").limit(100)


@query(
    "f4_word_search",
    "fx_real_acct",
    r"""WITH w AS (SELECT trim(acct) AS acct, string_split_regex(lower(concat_ws(' ', site_addr_1, mailto, lgl_1,
        lgl_2)), '[^a-z0-9]+') AS words FROM fx_real_acct)
    SELECT acct, cast(list_contains(words, 'trust') AS int) + cast(list_contains(words, 'blk') AS int)
        + cast(list_contains(words, 'france') AS int) AS score FROM w
    WHERE list_contains(words, 'trust') OR list_contains(words, 'blk') OR list_contains(words, 'france')""",
)
def f4(src: Inputs):
    accounts = src.view("fx_real_acct")
    columns = [F.col(c) for c in ("site_addr_1", "mailto", "lgl_1", "lgl_2")]
    path = scratch_path(src.spark, "f4")
    search_index.build_word_index(accounts, "acct", columns, path)
    found = search_index.word_search(src.spark, path, ["TRUST", "blk", "france"])
    return found.select(F.trim("key").alias("acct"), "score")


@query(
    "f5_value_range",
    "fx_gold",
    f"SELECT county, account_id, market_value FROM fx_gold WHERE {_USABLE}",
)
def f5(src: Inputs):
    return search.with_usable_value(
        src.view("fx_gold"), "market_value", "total_market_value", "assessed_value"
    ).select("county", "account_id", "market_value")

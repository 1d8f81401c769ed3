"""Coverage, quality, comparison and repair queries (A11-A26, L7, U3, M*)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.catalog.io import ragged_lines, written_lines
from parcelmill.catalog.nested import (
    D_ID,
    DALLAS,
    H_ID,
    HARRIS,
    T_ID,
    T_OK,
    TRAVIS,
    money,
    sample_store,
)
from parcelmill.catalog.registry import Inputs, query
from parcelmill.operators import ledger, quality, repair
from parcelmill.plans import harris, travis
from parcelmill.session import scratch_path
from parcelmill.sources import store
from parcelmill.sources.fixed_width import PROP

# One row per record with a flag per report field: the rule of each county restated over its sources.
FLAGS_SQL = f"""rec AS (
    SELECT 'harris' AS county, {H_ID} AS id, true AS addr, true AS mail, true AS val, true AS legal, true AS tax,
        coalesce(try_cast(trim(yr_impr) AS int), 0) > 0 OR cast(replace(bld_ar, ',', '') AS bigint) > 0 AS impr,
        true AS land, true AS det FROM fx_real_acct
    UNION ALL SELECT 'travis', {T_ID}, true, trim(substr(value, 609, 52)) <> '', true,
        trim(substr(value, 2001, 10)) <> '',
        {T_ID} IN (SELECT {T_ID} FROM fx_travis_ent), {T_ID} IN (SELECT {T_ID} FROM fx_travis_imp),
        {T_ID} IN (SELECT {T_ID} FROM fx_travis_land), true FROM fx_travis_prop WHERE {T_OK}
    UNION ALL SELECT 'dallas', {D_ID}, true, true, account_num IN (SELECT account_num FROM fx_dallas_appraisal),
        true, account_num IN (SELECT account_num FROM fx_dallas_appraisal),
        bldg_id IS NOT NULL OR account_num IN (SELECT account_num FROM fx_dallas_res)
            OR account_num IN (SELECT account_num FROM fx_dallas_com), true, true FROM fx_dallas_account),
cov AS (SELECT county, field, count(*) AS total, count(*) FILTER (ok) AS non_empty FROM (
    SELECT county, unnest(['account_id', 'county', 'year', 'property_address', 'mailing_address', 'valuation',
        'legal_status', 'tax_entities', 'improvements', 'land_details', 'property_details']) AS field,
        unnest([true, true, true, addr, mail, val, legal, tax, impr, land, det]) AS ok FROM rec) GROUP BY ALL)"""
ALL = f"{HARRIS} {TRAVIS} {DALLAS}"


def ledger_of(src: Inputs) -> DataFrame:
    return store.coverage_ledger(src.spark, sample_store(src))


def coverage_of(src: Inputs) -> DataFrame:
    return ledger.coverage(ledger_of(src), quality.COVERAGE_FIELDS)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(n, 6) for n in names})


@query(
    "a11_field_coverage",
    ALL,
    f"""WITH {FLAGS_SQL} SELECT county, field, total, non_empty, round(non_empty * 100.0 / total, 6) AS quality_rate
    FROM cov""",
)
def a11(src: Inputs):
    return rounded(coverage_of(src), "quality_rate").select(
        "county", "field", "total", "non_empty", "quality_rate"
    )


def _count_paths_sql(rows: str, paths: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{path}' AS field, count(*) AS total, count(*) FILTER ({rule}) AS non_empty FROM {rows}"
        for path, rule in paths
    )


@query(
    "a12_sub_field_coverage",
    "fx_real_acct",
    _count_paths_sql(
        "fx_real_acct",
        [
            ("property_address.street_address", "true"),
            ("property_address.city", "trim(site_addr_2) <> ''"),
            ("property_address.state", "false"),
            ("property_address.zip_code", "true"),
            ("mailing_address.name", "true"),
            ("mailing_address.address_line_1", "mail_addr_1 IS NOT NULL"),
            ("mailing_address.city", "false"),
            ("mailing_address.state", "false"),
            ("mailing_address.zip_code", "true"),
            ("valuation.market_value", f"{money('tot_mkt_val')} <> 0"),
            ("valuation.assessed_value", "false"),
            ("valuation.total_market_value", f"{money('tot_mkt_val')} <> 0"),
        ],
    ),
)
def a12(src: Inputs):
    records = harris.account_records(src.view("fx_real_acct"))
    return quality.field_coverage(records, quality.SUB_FIELDS).select("field", "total", "non_empty")


@query(
    "a13_category_quality",
    ALL,
    f"""WITH {FLAGS_SQL}, r AS (SELECT county, CASE WHEN field IN ('account_id', 'county', 'year') THEN 'core_fields'
        WHEN field LIKE '%address' THEN 'address_fields' WHEN field = 'valuation' THEN 'financial_fields'
        WHEN field = 'legal_status' THEN 'legal_fields' WHEN field = 'tax_entities' THEN 'entity_fields'
        ELSE 'detail_fields' END AS category, non_empty * 100.0 / total AS q FROM cov),
    c AS (SELECT county, avg(q) AS q FROM r GROUP BY county)
    SELECT county, category, round(avg(q), 6) AS quality FROM r GROUP BY county, category
    UNION ALL SELECT county, 'all', round(q, 6) FROM c UNION ALL SELECT 'all', 'all', round(avg(q), 6) FROM c""",
)
def a13(src: Inputs):
    return rounded(quality.category_quality(coverage_of(src)), "quality")


@query(
    "a14_missing_key_fields",
    ALL,
    f"""WITH {FLAGS_SQL}, m AS (SELECT county, id AS account_id, concat_ws(',',
        CASE WHEN NOT mail THEN 'mailing_address' END, CASE WHEN NOT val THEN 'valuation' END,
        CASE WHEN NOT legal THEN 'legal_status' END, CASE WHEN NOT tax THEN 'tax_entities' END,
        CASE WHEN NOT impr THEN 'improvements' END, CASE WHEN NOT land THEN 'land_details' END) AS missing FROM rec)
    SELECT county, account_id, missing FROM m WHERE missing <> ''""",
)
def a14(src: Inputs):
    missing = ledger.missing_records(store.coverage_gaps(src.spark, sample_store(src)))
    return missing.select(
        "county", "account_id", F.array_join("missing_fields", ",").alias("missing")
    )


@query(
    "a15_completeness_summary",
    ALL,
    f"""WITH {FLAGS_SQL} SELECT county, max(total) AS total_properties,
        count(*) FILTER (non_empty = total) AS complete_fields,
        round(avg(non_empty * 100.0 / total), 6) AS average_completeness FROM cov GROUP BY county""",
)
def a15(src: Inputs):
    return rounded(quality.completeness_summary(coverage_of(src)), "average_completeness")


@query(
    "a16_load_coverage",
    ALL,
    f"""WITH {FLAGS_SQL}, x AS (
        SELECT 'harris' AS county, true AS street, true AS name, {money('tot_mkt_val')} <> 0 AS v FROM fx_real_acct
        UNION ALL SELECT 'travis', false, trim(substr(value, 609, 52)) <> '', false FROM fx_travis_prop WHERE {T_OK}
        UNION ALL SELECT 'dallas', true, true, account_num IN (SELECT account_num FROM fx_dallas_appraisal)
        FROM fx_dallas_account)
    SELECT county, 'property_address.street_address' AS field, count(*) FILTER (street) AS non_empty FROM x GROUP BY 1
    UNION ALL SELECT county, 'mailing_address.name', count(*) FILTER (name) FROM x GROUP BY 1
    UNION ALL SELECT county, 'valuation.market_value', count(*) FILTER (v) FROM x GROUP BY 1
    UNION ALL SELECT county, field, non_empty FROM cov WHERE field IN ('tax_entities', 'improvements')""",
)
def a16(src: Inputs):
    return ledger.coverage(ledger_of(src), quality.LOAD_PATHS).select(
        "county", "field", "non_empty"
    )


@query(
    "a17_county_distributions",
    f"{HARRIS} {TRAVIS} {DALLAS}",
    f"""WITH d AS (
        SELECT 'harris' AS county, 'Unknown' AS kind, site_addr_2 AS city, site_addr_3 AS zip,
            CASE WHEN coalesce(try_cast(trim(yr_impr) AS int), 0) > 0
                OR cast(replace(bld_ar, ',', '') AS bigint) > 0 THEN 1 ELSE 0 END AS improvements FROM fx_real_acct
        UNION ALL SELECT 'travis', substr(value, 13, 1), 'Unknown', 'Unknown',
            (SELECT count(*) FROM fx_travis_imp i WHERE substr(i.value, 1, 12) = substr(p.value, 1, 12))
            FROM fx_travis_prop p WHERE {T_OK}
        UNION ALL SELECT 'dallas', coalesce(division_cd, ''), '', '',
            (SELECT count(*) FROM (SELECT DISTINCT account_num FROM fx_dallas_res) r
                WHERE r.account_num = a.account_num)
            + (SELECT count(*) FROM (SELECT account_num, min_by(tot_main_sf, source_pos) AS f FROM fx_dallas_res
                GROUP BY 1) r WHERE r.account_num = a.account_num AND f = '2,100')
            + (SELECT count(*) FROM (SELECT DISTINCT account_num FROM fx_dallas_com) c
                WHERE c.account_num = a.account_num)
            + CASE WHEN bldg_id IS NOT NULL THEN 1 ELSE 0 END FROM fx_dallas_account a),
    l AS (SELECT county, 'property_type' AS dimension, kind AS value FROM d
        UNION ALL SELECT county, 'city', city FROM d UNION ALL SELECT county, 'zip_code', zip FROM d
        UNION ALL SELECT county, 'improvements', cast(improvements AS string) FROM d)
    SELECT county, dimension, value, count(*) AS count, round(count(*) * 100.0 / (SELECT count(*) FROM d
        WHERE d.county = l.county), 6) AS percent FROM l GROUP BY county, dimension, value""",
)
def a17(src: Inputs):
    return rounded(ledger.distributions(ledger_of(src)), "percent")


@query(
    "a17_feature_presence",
    ALL,
    f"""WITH {FLAGS_SQL} SELECT county, bool_or(impr) AS has_improvements, bool_or(land) AS has_land_details,
        bool_or(tax) AS has_tax_entities FROM rec GROUP BY county""",
)
def a17_features(src: Inputs):
    return ledger.feature_presence(ledger_of(src), ["improvements", "land_details", "tax_entities"])


def sparse_accounts(src: Inputs) -> DataFrame:
    """Account rows of which some are empty or nearly empty."""
    key = F.trim("acct").cast("bigint")
    rows = src.view("fx_real_acct")
    return rows.select(
        *[
            F.when(key % 20 == 0, None)
            .when((key % 20 == 1) & (F.lit(i) > 1), "")
            .otherwise(F.col(c))
            .alias(c)
            for i, c in enumerate(rows.columns)
        ]
    )


def _integrity(src: Inputs) -> DataFrame:
    return quality.row_integrity(sparse_accounts(src), "accounts").unionByName(
        quality.row_integrity(src.view("fx_owners"), "owners")
    )


_INTEGRITY_SQL = """SELECT 'accounts' AS file, 26 AS columns, count(*) AS total_rows,
        count(*) FILTER (c_custkey % 20 = 0) AS empty_rows, count(*) FILTER (c_custkey % 20 IN (0, 1))
        AS fragmented_rows FROM customer
    UNION ALL SELECT 'owners', 5, count(*), 0, count(*) FILTER (
        2 + CASE WHEN name <> '' THEN 1 ELSE 0 END + CASE WHEN aka <> '' THEN 1 ELSE 0 END
        + CASE WHEN pct_own <> '' THEN 1 ELSE 0 END < 3) FROM fx_owners"""


@query(
    "a18_row_integrity",
    "fx_owners",
    f"""WITH i AS ({_INTEGRITY_SQL}) SELECT *, round(1 - (empty_rows + fragmented_rows) / total_rows, 6) AS integrity
    FROM i""",
)
def a18(src: Inputs):
    return rounded(_integrity(src), "integrity")


@query(
    "a19_structure_check",
    "",
    """SELECT 2 AS expected_delimiters, count(*) AS lines, count(*) FILTER (o_orderkey % 4 <> 0) AS issues_found,
    round(count(*) FILTER (o_orderkey % 4 <> 0) / count(*), 6) AS problem_rate FROM orders""",
)
def a19(src: Inputs):
    path = written_lines(ragged_lines(src), "a19")
    issues = quality.structure_issues(src.spark.read.text(path), ["a", "b", "c"])
    return rounded(issues, "problem_rate")


@query(
    "a20_quality_grades",
    "fx_owners",
    f"""WITH i AS ({_INTEGRITY_SQL}), s AS (SELECT file, 1 - (empty_rows + fragmented_rows) / total_rows AS x FROM i)
    SELECT file, round(x, 6) AS integrity, CASE WHEN x >= 0.98 THEN 'Excellent' WHEN x >= 0.9 THEN 'Good'
        WHEN x >= 0.75 THEN 'Fair' ELSE 'Poor' END AS status FROM s
    UNION ALL SELECT 'average', round(avg(x), 6), CASE WHEN avg(x) >= 0.95 THEN 'proceed'
        WHEN avg(x) >= 0.85 THEN 'investigate' ELSE 'inspect' END FROM s""",
)
def a20(src: Inputs):
    integrity = _integrity(src)
    files = quality.graded(integrity).select("file", "integrity", "status")
    average = quality.overall_advice(integrity).select(
        F.lit("average").alias("file"),
        F.col("average_integrity").alias("integrity"),
        F.col("advice").alias("status"),
    )
    return rounded(files.unionByName(average), "integrity")


PROFILED = {
    "county": "string", "account_id": "string", "owner_name": "string", "city": "string", "market_value": "decimal(18,2)",
    "total_market_value": "decimal(18,2)", "assessed_value": "decimal(18,2)", "property_type": "string",
    "year_built": "int", "n_tax_entities": "int",
}


@query(
    "a21_profile",
    "fx_gold",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{kind}' AS type, count(*) AS rows, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"count(DISTINCT {c}) + coalesce(max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END), 0) AS distinct_count FROM fx_gold"
        for c, kind in PROFILED.items()
    ),
)
def a21(src: Inputs):
    return quality.profile(src.view("fx_gold"))


@query(
    "a22_file_diagnostics",
    "fx_travis_prop fx_travis_ent",
    """SELECT 'prop' AS file, count(*) AS lines, min(length(value)) AS shortest, max(length(value)) AS longest,
        round(avg(length(value)), 6) AS average, 'fixed_width' AS format FROM fx_travis_prop
    UNION ALL SELECT 'prop_ent', count(*), min(length(value)), max(length(value)), round(avg(length(value)), 6),
        'fixed_width' FROM fx_travis_ent
    UNION ALL SELECT 'nation', count(*), min(length(n_name)), max(length(n_name)), round(avg(length(n_name)), 6),
        'unknown' FROM nation""",
)
def a22(src: Inputs):
    root = scratch_path(src.spark, "a22")
    src.view("fx_travis_prop").select("value").write.text(f"{root}/prop")
    src.view("fx_travis_ent").select("value").write.text(f"{root}/prop_ent")
    src.table("nation").select("n_name").write.text(f"{root}/nation")
    lines = src.spark.read.option("recursiveFileLookup", True).text(root)
    named = lines.select(
        "value", F.regexp_extract("_metadata.file_path", r"/(\w+)/[^/]+$", 1).alias("folder")
    )
    return rounded(quality.file_diagnostics(named, F.col("folder")), "average")


@query(
    "a23_county_comparison",
    ALL,
    f"""WITH {FLAGS_SQL} SELECT h.field, round(h.non_empty * 100.0 / h.total, 6) AS left_rate,
        round(t.non_empty * 100.0 / t.total, 6) AS right_rate,
        CASE WHEN h.non_empty > 0 AND t.non_empty > 0 THEN 'common' WHEN h.non_empty > 0 THEN 'only_harris'
            WHEN t.non_empty > 0 THEN 'only_travis' ELSE 'neither' END AS side,
        CASE WHEN (h.non_empty > 0) <> (t.non_empty > 0) THEN 'extend the other county with ' || h.field END AS advice
    FROM cov h JOIN cov t ON h.field = t.field AND h.county = 'harris' AND t.county = 'travis'""",
)
def a23(src: Inputs):
    compared = quality.compare_coverage(coverage_of(src), "harris", "travis")
    return rounded(compared, "left_rate", "right_rate")


@query(
    "a25_extraction_status",
    "fx_travis_prop",
    """SELECT CASE WHEN cast(substr(value, 1, 12) AS bigint) % 7 = 0 THEN 'short'
        WHEN substr(value, 1, 12) = '000000000000' OR cast(substr(value, 1, 12) AS bigint) % 7 = 1 THEN 'no_key'
        ELSE 'ok' END AS status, count(*) AS lines FROM fx_travis_prop GROUP BY 1""",
)
def a25(src: Inputs):
    key = F.col("value").substr(1, 12)
    number = key.cast("bigint")
    damaged = src.view("fx_travis_prop").select(
        F.when(number % 7 == 0, F.col("value").substr(1, 60))
        .when(number % 7 == 1, F.concat(F.repeat(F.lit(" "), 12), F.expr("substring(value, 13)")))
        .otherwise(F.col("value"))
        .alias("value")
    )
    return travis.extraction_status(damaged, PROP)


@query(
    "a26_recommendations",
    ALL,
    f"""WITH {FLAGS_SQL}, gap AS (SELECT county, field || printf(' (%.1f%%)', non_empty * 100.0 / total) AS label
        FROM cov WHERE non_empty * 100.0 / total < 30),
    n AS (SELECT sum(total) AS n, count(*) AS c FROM cov WHERE field = 'county')
    SELECT county, 'data_completeness' AS type, 'high' AS priority, string_agg(label, ', ' ORDER BY label) AS detail
        FROM gap GROUP BY county
    UNION ALL SELECT 'all', 'consistency', 'medium', cast(c AS string) FROM n WHERE c > 1
    UNION ALL SELECT 'all', 'performance', 'low', cast(n AS string) FROM n WHERE n > 10000""",
)
def a26(src: Inputs):
    return quality.recommendations(coverage_of(src))


@query(
    "l7_critical_fields",
    ALL,
    f"""WITH {FLAGS_SQL} SELECT county, field, round(non_empty * 100.0 / total, 6) AS quality_rate FROM cov
    WHERE non_empty * 100.0 / total < 50 ORDER BY non_empty * 1.0 / total, county, field LIMIT 10""",
)
def l7(src: Inputs):
    worst = quality.critical_fields(coverage_of(src)).select("county", "field", "quality_rate")
    return rounded(worst, "quality_rate")


@query(
    "u3_field_sets",
    ALL,
    f"""WITH {FLAGS_SQL}, h AS (SELECT field FROM cov WHERE county = 'dallas' AND non_empty > 0),
    t AS (SELECT field FROM cov WHERE county = 'travis' AND non_empty > 0)
    SELECT 'common' AS side, field FROM h WHERE field IN (SELECT field FROM t)
    UNION ALL SELECT 'only_dallas', field FROM h WHERE field NOT IN (SELECT field FROM t)
    UNION ALL SELECT 'only_travis', field FROM t WHERE field NOT IN (SELECT field FROM h)""",
)
def u3(src: Inputs):
    coverage = coverage_of(src)
    left = quality.filled_fields(coverage, "dallas")
    right = quality.filled_fields(coverage, "travis")
    return (
        left.intersect(right)
        .select(F.lit("common").alias("side"), "field")
        .unionByName(left.exceptAll(right).select(F.lit("only_dallas").alias("side"), "field"))
        .unionByName(right.exceptAll(left).select(F.lit("only_travis").alias("side"), "field"))
    )


@query(
    "m1_fill_county",
    "fx_gold",
    """SELECT account_id, owner_name, CASE WHEN county = 'harris' AND n_tax_entities = 0 THEN 'harris' ELSE county END
        AS county, county = 'harris' AND n_tax_entities = 0 AS repaired,
        (SELECT count(*) FROM fx_gold WHERE county = 'harris' AND n_tax_entities = 0) AS repaired_total FROM fx_gold""",
)
def m1(src: Inputs):
    lost = (F.col("county") == "harris") & (F.col("n_tax_entities") == 0)
    gold = src.view("fx_gold").select(
        "account_id", "owner_name", F.when(~lost, F.col("county")).alias("county"), lost.alias("lost"), F.lit(1).alias("pos")
    )
    fixed, total = repaired_store(src, gold, repair.fill_county, "county")
    return fixed.select("account_id", "owner_name", "county", F.col("lost").alias("repaired"), total)


def repaired_store(src: Inputs, records: DataFrame, rule, path: str):
    """Records of a store after a repair, and the number of those repaired."""
    root = scratch_path(src.spark, "repair")
    store.upsert(src.spark, root, records, "load", "2025-06-01 12:00:00", "pos")
    counts = store.repair(src.spark, root, rule, path, "repair", "2025-06-02 12:00:00")
    return store.read_store(src.spark, root), F.lit(counts["replaced_count"]).cast("bigint").alias("repaired_total")


def _harris_with_gaps(src: Inputs) -> DataFrame:
    gap = F.col("account_id").cast("bigint") % 3 == 0
    records = harris.account_records(src.view("fx_real_acct"))
    street, value = F.col("property_address.street_address"), F.col("valuation.market_value")
    gaps = {
        "property_address": F.col("property_address").withField("street_address", F.when(~gap, street)),
        "valuation": F.col("valuation").withField("market_value", F.when(~gap, value)),
        "gap": gap,
        "pos": F.lit(1),
    }
    return records.withColumns(gaps).select("account_id", "county", *gaps)


@query(
    "m2_fill_street_address",
    "fx_real_acct",
    f"""SELECT {H_ID} AS account_id, site_addr_1 AS street_address, cast(trim(acct) AS bigint) % 3 = 0 AS repaired,
        (SELECT count(*) FROM fx_real_acct WHERE cast(trim(acct) AS bigint) % 3 = 0) AS repaired_total
    FROM fx_real_acct""",
)
def m2(src: Inputs):
    fixed, total = repaired_store(src, _harris_with_gaps(src), repair.fill_street_address, "property_address.street_address")
    return fixed.select("account_id", "property_address.street_address", F.col("gap").alias("repaired"), total)


@query(
    "m3_fill_market_value",
    "fx_real_acct",
    f"""SELECT {H_ID} AS account_id, {money('tot_mkt_val')} AS market_value,
        cast(trim(acct) AS bigint) % 3 = 0 AND {money('tot_mkt_val')} IS NOT NULL AS repaired, (SELECT count(*)
        FROM fx_real_acct WHERE cast(trim(acct) AS bigint) % 3 = 0 AND {money('tot_mkt_val')} IS NOT NULL)
        AS repaired_total FROM fx_real_acct""",
)
def m3(src: Inputs):
    fixed, total = repaired_store(src, _harris_with_gaps(src), repair.fill_market_value, "valuation.market_value")
    value = F.col("valuation.market_value")
    return fixed.select("account_id", value, (F.col("gap") & value.isNotNull()).alias("repaired"), total)

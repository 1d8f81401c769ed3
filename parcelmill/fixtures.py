"""Sample county sources derived from the driver tables.

Each view is plain SQL that Spark and DuckDB both run, so a query and its oracle start from the
same rows. `{table}` is filled with a Parquet path for Spark and a view name for DuckDB.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.operators.keyed import positions

TABLES = ("customer", "supplier", "nation", "orders", "lineitem", "part")

#: Narrow tables whose rows become long lines: few row groups of them would be few, long tasks.
SPREAD = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}

VIEWS = {
    "fx_real_acct": r"""
SELECT concat(cast(c.c_custkey AS string), '   ') AS acct,
       '2025' AS yr,
       CASE WHEN c.c_custkey % 5 = 0 THEN concat('  acme  holdings ', cast(c.c_custkey AS string), ' llc ')
            WHEN c.c_custkey % 5 = 1 THEN concat('SMITH, JOHN ', n.n_name)
            WHEN c.c_custkey % 5 = 2 THEN concat(n.n_name, ' FAMILY TRUST')
            WHEN c.c_custkey % 5 = 3 THEN concat('VINCENT COX ', n.n_name)
            ELSE concat(n.n_name, ' ESTATE OF') END AS mailto,
       CASE WHEN c.c_custkey % 7 = 0 THEN NULL ELSE concat(cast(c.c_custkey % 900 + 100 AS string), ' North Main Street') END AS mail_addr_1,
       CASE WHEN c.c_custkey % 3 = 0 THEN '' ELSE 'Apt. #4' END AS mail_addr_2,
       concat('TX ', lpad(cast(c.c_custkey % 90000 + 10000 AS string), 5, '0'), CASE WHEN c.c_custkey % 2 = 0 THEN '-0012' ELSE '' END) AS mail_zip,
       cast(c.c_custkey % 900 + 100 AS string) AS str_num,
       n.n_name AS str,
       CASE WHEN c.c_custkey % 3 = 0 THEN 'STREET' WHEN c.c_custkey % 3 = 1 THEN 'AVENUE' ELSE 'BLVD.' END AS str_sfx,
       concat(cast(c.c_custkey % 900 + 100 AS string), ' ', n.n_name, ' ST') AS site_addr_1,
       CASE WHEN c.c_custkey % 11 = 0 THEN ' ' ELSE n.n_name END AS site_addr_2,
       lpad(cast(c.c_custkey % 90000 + 10000 AS string), 5, '0') AS site_addr_3,
       CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE concat(lpad(cast(n.n_regionkey AS string), 2, '0'), '   ') END AS school_dist,
       cast(n.n_nationkey AS string) AS market_area_1,
       c.c_mktsegment AS market_area_1_dscr,
       CASE WHEN c.c_custkey % 4 = 0 THEN ' ' ELSE cast(1950 + c.c_custkey % 70 AS string) END AS yr_impr,
       CASE WHEN c.c_custkey % 4 = 0 THEN '0' ELSE '1,850' END AS bld_ar,
       cast(cast(abs(c.c_acctbal) AS decimal(18,2)) AS string) AS land_val,
       cast(c.c_custkey % 500 * 1000 AS string) AS bld_val,
       CASE WHEN c.c_custkey % 6 = 0 THEN '' ELSE cast(cast(abs(c.c_acctbal) + c.c_custkey % 500 * 1000 AS decimal(18,2)) AS string) END AS tot_mkt_val,
       CASE WHEN c.c_custkey % 8 = 0 THEN '0' WHEN c.c_custkey % 9 = 0 THEN 'n/a' ELSE cast(cast(abs(c.c_acctbal) * 2 AS decimal(18,2)) AS string) END AS prior_land_val,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'y' ELSE 'N' END AS noticed,
       CASE WHEN c.c_custkey % 10 = 0 THEN NULL ELSE 'Y' END AS protested,
       concat('LT ', cast(c.c_custkey % 40 AS string)) AS lgl_1,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'BLK 2' ELSE NULL END AS lgl_2,
       CASE WHEN c.c_custkey % 12 = 0 THEN NULL ELSE '001 040 041' END AS jurs
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey
""",
    "fx_owners": r"""
SELECT cast(o.o_custkey AS string) AS acct,
       cast(row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_orderkey) AS int) AS ln_num,
       CASE WHEN o.o_orderkey % 17 = 0 THEN NULL WHEN o.o_orderkey % 4 = 0 THEN 'DELTA PROPERTIES INC' ELSE concat(' Owner ', cast(o.o_orderkey % 300 AS string), ' ') END AS name,
       CASE WHEN o.o_orderkey % 3 = 0 THEN '' ELSE 'AKA X' END AS aka,
       CASE WHEN o.o_orderkey % 5 = 0 THEN '' WHEN o.o_orderkey % 2 = 0 THEN '1.0' ELSE '0.25' END AS pct_own
FROM {orders} o
""",
    "fx_deeds": r"""
SELECT lpad(cast(o.o_custkey AS string), 9, '0') AS acct, concat(lpad(cast(month(o.o_orderdate) AS string), 2, '0'), '/', lpad(cast(day(o.o_orderdate) AS string), 2, '0'), '/', cast(year(o.o_orderdate) AS string)) AS dos,
       cast(year(o.o_orderdate) AS string) AS clerk_yr, o.o_orderpriority AS clerk_id, cast(o.o_orderkey AS string) AS deed_id
FROM {orders} o
""",
    "fx_permits": r"""
SELECT cast(o.o_custkey AS string) AS acct, concat(cast(l.l_orderkey AS string), '-', cast(l.l_linenumber AS string)) AS id,
       l.l_returnflag AS status, concat('"', o.o_orderpriority, ' 5" pipe ') AS dscr, l.l_linestatus AS permit_type,
       cast(year(l.l_shipdate) AS string) AS yr, cast(l.l_suppkey AS string) AS site_num
FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey
""",
    "fx_nbhd": r"""
SELECT cast(n_nationkey AS int) AS cd, cast(n_regionkey AS string) AS grp_cd, n_name AS dscr FROM {nation} WHERE n_nationkey % 5 <> 0
""",
    "fx_mineral": r"""
SELECT cast(s_suppkey * 7 AS string) AS acct, cast(s_nationkey AS string) AS dor_cd, 'WI' AS type_interest,
       cast(cast(abs(s_acctbal) / 10000 AS decimal(18,4)) AS string) AS interest_percent, s_suppkey AS source_pos
FROM {supplier}
UNION ALL
SELECT cast(s_suppkey * 7 AS string), 'J9', 'RI', '0.5000', s_suppkey + 1000000 FROM {supplier} WHERE s_suppkey % 3 = 0
""",
    "fx_dallas_account": r"""
SELECT concat('38-', lpad(cast(s_suppkey AS string), 8, '0')) AS account_num, s_name AS owner_name1,
       CASE WHEN s_suppkey % 4 = 0 THEN 'AND SPOUSE' ELSE NULL END AS owner_name2,
       CASE WHEN s_suppkey % 7 = 0 THEN NULL WHEN s_suppkey % 7 = 1 THEN 'com' WHEN s_suppkey % 7 = 2 THEN 'XYZ' ELSE 'RES' END AS division_cd,
       cast(s_suppkey % 900 + 1 AS string) AS street_num, CASE WHEN s_suppkey % 9 = 0 THEN '1/2' ELSE '' END AS street_half_num,
       'ELM ST' AS full_street_name, CASE WHEN s_suppkey % 5 = 0 THEN 'B' ELSE NULL END AS bldg_id, '' AS unit_id,
       'LOT 1' AS legal1, CASE WHEN s_suppkey % 2 = 0 THEN 'BLK A' ELSE NULL END AS legal2,
       CASE WHEN s_suppkey % 3 = 0 THEN '1.5' ELSE NULL END AS acreage, s_suppkey AS source_pos
FROM {supplier}
""",
    "fx_dallas_appraisal": r"""
SELECT concat('38-', lpad(cast(l_suppkey AS string), 8, '0')) AS account_num,
       cast(cast(l_extendedprice AS decimal(18,2)) AS string) AS land_val,
       cast(cast(l_extendedprice * 2 AS decimal(18,2)) AS string) AS tot_val,
       CASE WHEN l_linenumber = 1 THEN 'UNASSIGNED' ELSE 'CITY OF X' END AS city_juris_desc, '100,000' AS city_taxable_val, '1.0' AS city_split_pct,
       'DALLAS COUNTY' AS county_juris_desc, '90000' AS county_taxable_val, CAST(NULL AS string) AS county_split_pct,
       CASE WHEN l_linenumber = 2 THEN '' ELSE 'ISD X' END AS isd_juris_desc, 'bad' AS isd_taxable_val, '0.5' AS isd_split_pct,
       l_orderkey * 10 + l_linenumber AS source_pos
FROM {lineitem}
""",
    "fx_dallas_owner": r"""
SELECT concat('38-', lpad(cast(s_suppkey - s_suppkey % 3 AS string), 8, '0')) AS account_num, CASE WHEN s_suppkey % 3 = 2 THEN NULL ELSE 'CO OWNER' END AS owner_name,
       CASE WHEN s_suppkey % 3 = 0 THEN '25' ELSE '10' END AS ownership_pct FROM {supplier}
""",
    "fx_travis_prop": r"""
SELECT concat(lpad(cast(c_custkey AS string), 12, '0'), CASE WHEN c_custkey % 2 = 0 THEN 'R' ELSE 'C' END, '    ', '02025', rpad('', 528, ' '),
              rpad(concat('GEO', cast(c_custkey AS string)), 20, ' '), rpad('', 38, ' '),
              rpad(CASE WHEN c_custkey % 10 = 0 THEN '' ELSE c_name END, 52, ' '), rpad('', 1160, ' '),
              lpad(cast(cast(floor(abs(c_acctbal)) AS bigint) * 1000000000 AS string), 15, '0'),
              CASE WHEN c_custkey % 3 = 0 THEN '000000000000000' ELSE lpad('250000000000', 15, '0') END, rpad('', 150, ' '),
              CASE WHEN c_custkey % 4 = 0 THEN '01312025  ' WHEN c_custkey % 4 = 1 THEN '20250131  ' WHEN c_custkey % 4 = 2 THEN '01-31-2025' ELSE '          ' END) AS value,
       c_custkey AS source_pos
FROM {customer}
""",
    "fx_travis_ent": r"""
SELECT concat(lpad(cast(o_custkey AS string), 12, '0'), '2025', rpad('', 34, ' '), rpad(o_orderpriority, 12, ' '), rpad('X', 1, ' '),
              rpad(concat('ENTITY ', o_orderstatus), 80, ' '), rpad('', 57, ' '),
              lpad(cast(cast(floor(o_totalprice) AS bigint) * 1000000000 AS string), 15, '0')) AS value, o_orderkey AS source_pos
FROM {orders}
""",
    "fx_gold": r"""
SELECT 'harris' AS county, lpad(cast(c_custkey AS string), 13, '0') AS account_id, c_name AS owner_name, CASE WHEN c_custkey % 9 = 0 THEN NULL ELSE 'HOUSTON' END AS city,
       cast(abs(c_acctbal) AS decimal(18,2)) AS market_value, CAST(NULL AS decimal(18,2)) AS total_market_value, cast(10 AS decimal(18,2)) AS assessed_value,
       c_mktsegment AS property_type, cast(1950 + c_custkey % 70 AS int) AS year_built, cast(c_custkey % 4 AS int) AS n_tax_entities
FROM {customer}
UNION ALL
SELECT 'dallas', lpad(cast(s_suppkey AS string), 17, '0'), s_name, 'DALLAS', cast(CASE WHEN s_suppkey % 5 = 0 THEN 20000000000.00 ELSE abs(s_acctbal) END AS decimal(18,2)), cast(abs(s_acctbal) * 2 AS decimal(18,2)), NULL,
       CASE WHEN s_suppkey % 2 = 0 THEN 'RES' ELSE 'COM' END, CAST(NULL AS int), cast(s_suppkey % 7 AS int)
FROM {supplier}
UNION ALL
SELECT 'travis', lpad(cast(p_partkey AS string), 12, '0'), CASE WHEN p_partkey % 6 = 0 THEN '' ELSE p_brand END, 'AUSTIN', cast(CASE WHEN p_partkey % 8 = 0 THEN 0 ELSE p_retailprice END AS decimal(18,2)), NULL, cast(p_retailprice AS decimal(18,2)),
       p_type, cast(1900 + p_size AS int), cast(p_size % 5 AS int)
FROM {part}
""",
    "fx_plan_pages": r"""
SELECT p_partkey AS plan_id, 1 AS page_no, 'a' AS method,
       concat('FIRST FLOOR LIVING ', cast(600 + p_size * 10 AS string), ' SECOND FLOOR LIVING ', cast(500 + p_size * 5 AS string), ' TOTAL LIVING ', cast(1100 + p_size * 15 AS string),
              ' KITCHEN ', cast(120 + p_size AS string), ' BEDROOM ', cast(200 + p_size AS string), ' DOOR 1 DOOR 2 WINDOW 1 OUTLET 3 CEILING HEIGHT 9''-0 12''-6 x 14''-0 SLAB ON GRADE GABLE ROOF 4 TON') AS text
FROM {part} WHERE p_partkey % 4 <> 0
UNION ALL
SELECT p_partkey, 2, 'a', concat('LIVING ROOM ', cast(200 + p_size AS string), ' BATH 1 ', cast(40 + p_size AS string), ' POWDER 30 TOILET SINK SHOWER R-13 WALL 200 AMP PANEL 50 GAL') FROM {part} WHERE p_partkey % 3 <> 0
UNION ALL
SELECT p_partkey, 1, 'b', concat('#@!~ ', p_name, ' %%% $$') FROM {part}
""",
    "fx_plan_facts": r"""
SELECT p_partkey AS plan_id, cast(CASE WHEN p_partkey % 15 = 0 THEN 0 ELSE 400 + p_size * 200 END AS int) AS total_sqft, cast(p_partkey % 30 AS int) AS doors, cast(p_size AS int) AS windows,
       cast(p_partkey % 12 AS int) AS room_count, cast(p_size * 90 AS int) AS room_area, CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE 'SLAB' END AS foundation_type,
       cast(p_partkey % 120 AS int) AS outlets, cast(p_partkey % 25 AS int) AS plumbing_fixtures
FROM {part}
""",
    "fx_tieback": r"""
SELECT cast(o_custkey AS string) AS acct, 'S' AS tp, 'split' AS dscr, cast(o_custkey + 1 AS string) AS related_acct, '0.5' AS pct FROM {orders}
""",
    "fx_dallas_res": r"""
SELECT concat('38-', lpad(cast(cast(floor(p_partkey / 13) AS bigint) AS string), 8, '0')) AS account_num, CASE WHEN p_size % 4 = 0 THEN NULL ELSE cast(1960 + p_size AS string) END AS yr_built,
       p_type AS bldg_class_desc, '1,900' AS tot_living_area_sf, CASE WHEN p_size % 3 = 0 THEN '1,900' ELSE '2,100' END AS tot_main_sf,
       CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE NULL END AS pool_ind, cast(p_size AS string) AS num_bedrooms, p_partkey AS source_pos
FROM {part}
""",
    "fx_dallas_com": r"""
SELECT concat('38-', lpad(cast(cast(floor(p_partkey / 40) AS bigint) AS string), 8, '0')) AS account_num, cast(p_size * 1000 AS string) AS gross_bldg_area, '1999' AS year_built, p_name AS property_name,
       '10.5' AS phys_depr_pct, cast(cast(p_retailprice AS decimal(18,2)) AS string) AS imp_val, p_partkey AS source_pos
FROM {part}
""",
    "fx_dallas_land": r"""
SELECT concat('38-', lpad(cast(cast(floor(p_partkey / 17) AS bigint) AS string), 8, '0')) AS account_num, 'R-7.5' AS zoning, cast(p_size * 100 AS string) AS area_size, '50' AS front_dim, 'x' AS depth_dim,
       CASE WHEN p_size % 2 = 0 THEN 'Y' ELSE 'N' END AS ag_use_ind, p_partkey AS source_pos
FROM {part}
""",
    "fx_travis_imp": r"""
SELECT concat(lpad(cast(cast(floor(l_orderkey / 36) * 4 AS bigint) AS string), 12, '0'), lpad(cast(l_linenumber AS string), 10, '0'), rpad('1st Floor', 20, ' '), rpad(l_returnflag, 20, ' '),
              cast(1950 + l_linenumber AS string), lpad('2986', 10, '0'), lpad('80037', 10, '0'), rpad('DESC', 50, ' ')) AS value, l_orderkey * 10 + l_linenumber AS source_pos
FROM {lineitem}
""",
    "fx_travis_land": r"""
SELECT concat(lpad(cast(p_partkey AS string), 12, '0'), lpad(cast(p_size AS string), 10, '0'), rpad('LAND', 20, ' '), rpad(p_name, 50, ' '), rpad('F1', 20, ' '),
              lpad('100000', 10, '0'), lpad('2351200000', 10, '0')) AS value, p_partkey AS source_pos
FROM {part}
""",
    "fx_travis_agent": r"""
SELECT concat(lpad(cast(s_suppkey AS string), 12, ' '), rpad(s_name, 60, ' '), rpad('41 DR', 70, ' '), rpad('WOODCREEK', 20, ' '), 'TX ', rpad('78676', 10, ' ')) AS value, s_suppkey AS source_pos FROM {supplier}
""",
    "fx_travis_subd": r"""
SELECT concat(rpad(concat('S', cast(n_nationkey AS string)), 12, ' '), rpad(n_name, 50, ' '), rpad('SUB', 20, ' '), rpad('AUSTIN', 30, ' '), rpad('TRAVIS', 20, ' ')) AS value, n_nationkey AS source_pos FROM {nation}
""",
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The named sample source as a DataFrame over the Parquet files in `sf_dir`."""
    if name == "fx_owners":
        return _owners(spark, sf_dir)
    paths = {t: f"parquet.`{sf_dir}/{t}.parquet`" for t in TABLES}
    spread = {t: f"(SELECT /*+ REPARTITION({key}) */ * FROM {paths[t]})" for t, key in SPREAD.items()}
    rows = spark.sql(VIEWS[name].format(**paths | spread))
    return _built_once(rows) if name.startswith("fx_travis_") else rows


def _built_once(lines: DataFrame) -> DataFrame:
    """The same rows; filters on a line stay above the projection that builds it, as they would above a file.

    Pushed below, they would build it anew for each of their terms, and before the narrow rows are dealt out.
    """
    numbered = lines.withColumn("_row", F.monotonically_increasing_id())
    return numbered.filter("_row >= 0").drop("_row")


def _owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Same rows as the SQL view; the line number is counted without putting one account in one task.
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_custkey", "o_orderkey")
    key = F.col("o_orderkey")
    return positions(orders, ["o_custkey"], "o_orderkey", "ln_num").select(
        F.col("o_custkey").cast("string").alias("acct"),
        F.col("ln_num").cast("int").alias("ln_num"),
        F.when(key % 17 == 0, None)
        .when(key % 4 == 0, "DELTA PROPERTIES INC")
        .otherwise(F.concat(F.lit(" Owner "), (key % 300).cast("string"), F.lit(" ")))
        .alias("name"),
        F.when(key % 3 == 0, "").otherwise("AKA X").alias("aka"),
        F.when(key % 5 == 0, "").when(key % 2 == 0, "1.0").otherwise("0.25").alias("pct_own"),
    )


def oracle_sql_with(views: str, body: str) -> str:
    """DuckDB text: the named views as common table expressions, then `body`."""
    names = {t: t for t in TABLES}
    parts = [f"{v} AS ({VIEWS[v].format(**names)})" for v in views.split()]
    if body.lstrip().upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body.lstrip()[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body

"""Source, sink and stream queries (S*, K*, R*): write a sample source in the raw form, read it back."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.catalog.nested import H_ID, harris_files, money
from parcelmill.catalog.registry import Inputs, query
from parcelmill.functions import text
from parcelmill.plans import gold, harris
from parcelmill.session import scratch_path
from parcelmill.sources import delimited, runlog, sinks, store, tables
from parcelmill.sources.fixed_width import (
    AGENT,
    IMPROVEMENT,
    LAND,
    PROP,
    PROP_ENT,
    SUBDIVISION,
    project_fields,
)
from parcelmill.streaming import ingest

RUN_TIME = "2025-06-01 12:00:00"
LATER = "2025-06-02 12:00:00"
PAGE = 512  # bytes: so small that accounts have several pages


def written_csv(df: DataFrame, label: str, sep: str, **options) -> str:
    path = scratch_path(df.sparkSession, label)
    writer = df.write.option("header", True).option("sep", sep).option("escape", '"')
    for key, value in options.items():
        writer = writer.option(key, value)
    writer.csv(path)
    return path


def written_lines(df: DataFrame, label: str, **options) -> str:
    path = scratch_path(df.sparkSession, label)
    df.write.options(**options).text(path)
    return path


ACCOUNT_TYPES = {
    "acct": "string",
    "mailto": "string",
    "mail_addr_1": "string",
    "mail_addr_2": "string",
    "yr_impr": "int",
    "bld_ar": "int",
    "land_val": "decimal(18,2)",
    "tot_mkt_val": "decimal(18,2)",
    "prior_land_val": "decimal(18,2)",
    "notice_dt": "date",
}


def account_text(src: Inputs) -> DataFrame:
    day = F.date_add(F.lit("2025-01-01"), (F.trim("acct").cast("int") % 28))
    return src.view("fx_real_acct").withColumn("notice_dt", day.cast("string")).select(*ACCOUNT_TYPES)


S1_SQL = f"""SELECT trim(acct) AS acct, trim(mailto) AS mailto, mail_addr_1, nullif(mail_addr_2, '') AS mail_addr_2,
    try_cast(trim(yr_impr) AS int) AS yr_impr, cast(replace(bld_ar, ',', '') AS int) AS bld_ar,
    {money('land_val')} AS land_val, {money('tot_mkt_val')} AS tot_mkt_val,
    {money('prior_land_val')} AS prior_land_val,
    DATE '2025-01-01' + cast(cast(trim(acct) AS int) % 28 AS int) AS notice_dt FROM fx_real_acct"""


@query("s1_delimited_scan", "fx_real_acct", S1_SQL)
def s1(src: Inputs):
    path = written_csv(account_text(src), "s1", "\t", emptyValue="")
    return delimited.read_delimited(src.spark, path, ACCOUNT_TYPES).withColumns(
        {"acct": F.trim("acct"), "mailto": F.trim("mailto")}
    )


@query(
    "s2_delimiter_profile",
    "",
    """SELECT * FROM (SELECT 'comma' AS file, ',' AS delimiter, 3 * count(*) AS hits FROM customer
    UNION ALL SELECT 'tab', chr(9), 3 * count(*) FROM customer UNION ALL SELECT 'pipe', '|', 3 * count(*) FROM customer
    UNION ALL SELECT 'semicolon', ';', 3 * count(*) FROM customer UNION ALL SELECT 'none', chr(9), 0)""",
)
def s2(src: Inputs):
    root = scratch_path(src.spark, "s2")
    columns = ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"]
    customers = src.table("customer").select(*columns)
    for label, sep in {"comma": ",", "tab": "\t", "pipe": "|", "semicolon": ";"}.items():
        customers.select(F.concat_ws(sep, *columns)).write.text(f"{root}/{label}")
    customers.select("c_name").write.text(f"{root}/none")
    lines = src.spark.read.option("recursiveFileLookup", True).text(root)
    folder = F.regexp_extract("_metadata.file_path", r"/(\w+)/[^/]+$", 1)
    return delimited.detect_delimiters(lines.select("value", folder.alias("folder")), F.col("folder"))


@query(
    "s3_declared_types",
    "fx_owners",
    """SELECT acct, ln_num, trim(name) AS name, nullif(aka, '') AS aka,
    cast(nullif(pct_own, '') AS double) AS pct_own FROM fx_owners""",
)
def s3(src: Inputs):
    types = {"acct": "string", "ln_num": "int", "name": "string", "aka": "string", "pct_own": "double"}
    path = written_csv(src.view("fx_owners"), "s3", "\t", emptyValue="")
    rows = delimited.read_delimited(src.spark, path, types)
    return rows.withColumn("name", F.trim("name"))


PERMIT_COLUMNS = ["acct", "id", "status", "dscr", "permit_type", "yr", "site_num"]


@query(
    "s4_quote_blind_scan",
    "fx_permits",
    """SELECT acct, id, status, trim(dscr, ' "') AS dscr, permit_type, yr, site_num FROM fx_permits""",
)
def s4(src: Inputs):
    # written without any quoting, so the stray quotes of the descriptions are in the file as they are
    path = written_csv(
        src.view("fx_permits").select(*PERMIT_COLUMNS),
        "s4",
        "\t",
        quote="",
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )
    rows = delimited.read_quote_blind(src.spark, path, PERMIT_COLUMNS).filter("_corrupt IS NULL")
    return rows.withColumn("dscr", delimited.strip_description(F.col("dscr"))).drop("_corrupt")


def ragged_lines(src: Inputs) -> DataFrame:
    """Exact, one-short, one-over (empty) and too-long lines, by order key."""
    key = F.col("o_orderkey")
    full = [key.cast("string"), F.col("o_orderstatus"), F.col("o_orderpriority")]
    kind = key % 4
    return src.table("orders").select(
        F.when(kind == 0, F.concat_ws("\t", *full))
        .when(kind == 1, F.concat_ws("\t", *full[:2]))
        .when(kind == 2, F.concat_ws("\t", *full, F.lit("")))
        .otherwise(F.concat_ws("\t", *full, F.lit("x"), F.lit("y")))
        .alias("value")
    )


@query(
    "s5_ragged_rows",
    "",
    """SELECT 'good' AS outcome, cast(o_orderkey AS string) AS a, o_orderstatus AS b,
        CASE WHEN o_orderkey % 4 = 1 THEN '' ELSE o_orderpriority END AS c FROM orders WHERE o_orderkey % 4 <> 3
    UNION ALL SELECT 'reject', cast(o_orderkey AS string), '5', NULL FROM orders WHERE o_orderkey % 4 = 3""",
)
def s5(src: Inputs):
    path = written_lines(ragged_lines(src), "s5")
    good, rejects = delimited.repair_ragged(
        src.spark.read.text(path), ["a", "b", "c"], drop_empty_extra=True
    )
    bad = rejects.select(
        F.lit("reject").alias("outcome"),
        F.split("value", r"\t")[0].alias("a"),
        F.col("fields").cast("string").alias("b"),
        F.lit(None).cast("string").alias("c"),
    )
    return good.withColumn("outcome", F.lit("good")).unionByName(bad)


@query(
    "s6_line_endings",
    "",
    """SELECT cast(o_orderkey AS string) || ';' || o_orderstatus AS value FROM orders WHERE o_orderkey % 5 <> 0""",
)
def s6(src: Inputs):
    root = scratch_path(src.spark, "s6")
    key = F.col("o_orderkey")
    lines = src.table("orders").select(
        key,
        F.when(key % 5 == 0, F.lit("  "))
        .otherwise(F.concat_ws(";", key.cast("string"), F.col("o_orderstatus")))
        .alias("value"),
    )
    for i, ending in enumerate(["\n", "\r\n", "\r"]):
        part = lines.filter(F.pmod(key, F.lit(3)) == i).select("value")
        part.write.option("lineSep", ending).text(f"{root}/part{i}")
    return delimited.non_blank_lines(
        src.spark.read.option("recursiveFileLookup", True).text(root)
    ).select("value")


@query(
    "s7_encoding_repair",
    "",
    """SELECT 'José ' || s_name || ' Peña' AS value FROM supplier
    UNION ALL SELECT 'José ' || c_name || ' Peña' FROM customer""",
)
def s7(src: Inputs):
    root = scratch_path(src.spark, "s7")

    def accented(name):
        return F.concat(F.lit("José "), F.col(name), F.lit(" Peña")).alias("value")

    src.table("supplier").select(accented("s_name")).write.text(f"{root}/utf8")
    src.table("customer").select(accented("c_name")).write.option("encoding", "ISO-8859-1").option(
        "quote", ""
    ).csv(f"{root}/latin1")
    lines = src.spark.read.option("recursiveFileLookup", True).text(root)
    return lines.select(delimited.repaired_encoding(F.col("value")).alias("value"))


@query(
    "s8_parse_strategies",
    "",
    """WITH n AS (SELECT count(*) AS e, count(*) FILTER (o_orderkey % 4 = 0) AS exact,
        count(*) FILTER (o_orderkey % 4 IN (0, 1)) AS short FROM orders)
    SELECT strategy, e AS expected, parsed, round((e - parsed) / e, 6) AS loss, 'Poor' AS grade,
        strategy = 'one_short_allowed' AS chosen FROM
    (SELECT 'quoted' AS strategy, e, exact AS parsed FROM n UNION ALL SELECT 'quote_blind', e, exact FROM n
     UNION ALL SELECT 'one_short_allowed', e, short FROM n)""",
)
def s8(src: Inputs):
    path = written_lines(ragged_lines(src), "s8")
    quality = delimited.parse_quality(src.spark.read.text(path), delimited.tab_strategies(3))
    return quality.withColumn("loss", F.round("loss", 6))


@query(
    "s9_parquet_scan",
    "",
    "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
)
def s9(src: Inputs):
    return src.table("orders").filter("o_orderstatus = 'F'").select(
        "o_orderkey", "o_custkey", "o_orderstatus"
    )


@query(
    "s10_json_scan",
    "fx_real_acct",
    f"""SELECT 'record' AS kind, {H_ID} AS account_id, {money('land_val')} AS land_value,
        market_area_1 AS market_area FROM fx_real_acct
    UNION ALL SELECT 'array', {H_ID}, {money('land_val')}, market_area_1 FROM fx_real_acct
    UNION ALL SELECT 'corrupt', 'broken ' || s_name, NULL, NULL FROM supplier""",
)
def s10(src: Inputs):
    from parcelmill.schemas import property_schema

    root = scratch_path(src.spark, "s10")
    records = harris.account_records(src.view("fx_real_acct"))
    records.select("account_id", "county", "valuation", "property_details").write.json(f"{root}/a")
    src.table("supplier").select(F.concat(F.lit("broken "), "s_name")).write.text(f"{root}/b")
    good, corrupt = delimited.read_json_records(src.spark, f"{root}/*", property_schema())
    # the same records as one array, with brackets, quotes and escapes inside a text
    note = F.lit('a, [b] {c\\" ,').alias("note")
    texts = records.select("account_id", F.to_json(F.struct(note, "account_id", "valuation", "property_details")).alias("value"))
    opens = F.when(F.col("account_id") == texts.agg(F.min("account_id")).scalar(), "[").otherwise(",")
    lines = texts.select("account_id", F.concat(opens, "value").alias("value")).unionByName(src.spark.sql("SELECT '~' AS account_id, ']' AS value"))
    lines.orderBy("account_id").select("value").coalesce(1).write.text(f"{root}/c")
    listed, _ = delimited.read_json_records(src.spark, f"{root}/c", property_schema(), array_file=True)

    def shown(kind: str, df: DataFrame) -> DataFrame:
        return df.select(
            F.lit(kind).alias("kind"),
            "account_id",
            "valuation.land_value",
            F.col("property_details.market_area_1").alias("market_area"),
        )

    return shown("record", good).unionByName(shown("array", listed)).unionByName(
        corrupt.select(F.lit("corrupt").alias("kind"), F.col("_corrupt").alias("account_id")),
        allowMissingColumns=True,
    )


def fixed_width_rows(src: Inputs, view: str, layout) -> DataFrame:
    path = written_lines(src.view(view).select("value"), f"fw-{layout.name}")
    return project_fields(src.spark.read.text(path), layout)


@query(
    "s11_fixed_width_scan",
    "fx_travis_prop fx_travis_ent",
    """SELECT 'prop' AS layout, substr(value, 1, 12) AS account_id, nullif(trim(substr(value, 609, 52)), '') AS name,
        cast(nullif(coalesce(try_cast(substr(value, 1821, 15) AS decimal(18,0)), 0) / 1000000000, 0)
            AS decimal(18,2)) AS value,
        CASE trim(substr(value, 2001, 10)) WHEN '' THEN NULL WHEN '01-31-2025' THEN '01/31/2025'
            ELSE '2025-01-31' END AS day
    FROM fx_travis_prop WHERE substr(value, 1, 12) <> '000000000000'
    UNION ALL SELECT 'prop_ent', substr(value, 1, 12), trim(substr(value, 64, 80)),
        cast(cast(substr(value, 201, 15) AS decimal(18,0)) / 1000000000 AS decimal(18,2)), NULL
    FROM fx_travis_ent WHERE substr(value, 1, 12) <> '000000000000'""",
)
def s11(src: Inputs):
    lots = fixed_width_rows(src, "fx_travis_prop", PROP).select(
        F.lit("prop").alias("layout"),
        "account_id",
        F.col("owner_name").alias("name"),
        F.col("assessed_value_1").alias("value"),
        F.col("assessment_date").alias("day"),
    )
    taxed = fixed_width_rows(src, "fx_travis_ent", PROP_ENT).select(
        F.lit("prop_ent").alias("layout"),
        "account_id",
        F.col("entity_name").alias("name"),
        F.col("entity_assessed_value").alias("value"),
    )
    return lots.unionByName(taxed, allowMissingColumns=True)


@query(
    "s12_fixed_width_side_tables",
    "fx_travis_imp fx_travis_land fx_travis_agent fx_travis_subd",
    """SELECT 'improvement' AS layout, substr(value, 1, 12) AS id, trim(substr(value, 23, 20)) AS kind,
        cast(substr(value, 67, 10) AS double) AS size FROM fx_travis_imp
        WHERE substr(value, 1, 12) <> '000000000000'
    UNION ALL SELECT 'land', substr(value, 1, 12), trim(substr(value, 23, 20)), cast(substr(value, 113, 10) AS double)
        FROM fx_travis_land WHERE substr(value, 1, 12) <> '000000000000'
    UNION ALL SELECT 'agent', trim(substr(value, 1, 12)), trim(substr(value, 13, 60)), NULL FROM fx_travis_agent
        WHERE trim(substr(value, 1, 12)) <> '0'
    UNION ALL SELECT 'subdivision', trim(substr(value, 1, 12)), trim(substr(value, 13, 50)), NULL
        FROM fx_travis_subd""",
)
def s12(src: Inputs):
    specs = [
        ("fx_travis_imp", IMPROVEMENT, "account_id", "improvement_type", "square_footage"),
        ("fx_travis_land", LAND, "account_id", "land_type", "land_area"),
        ("fx_travis_agent", AGENT, "agent_id", "agent_name", None),
        ("fx_travis_subd", SUBDIVISION, "subdivision_id", "subdivision_name", None),
    ]
    out = None
    for view, layout, key, kind, size in specs:
        rows = fixed_width_rows(src, view, layout).select(
            F.lit(layout.name).alias("layout"),
            F.col(key).alias("id"),
            F.col(kind).alias("kind"),
            (F.col(size) if size else F.lit(None)).cast("double").alias("size"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


DALLAS_COLUMNS = ["account_num", "owner_name1", "owner_name2", "division_cd", "street_num", "acreage"]


@query(
    "s13_all_string_csv",
    "fx_dallas_account",
    f"SELECT {', '.join(DALLAS_COLUMNS)} FROM fx_dallas_account",
)
def s13(src: Inputs):
    path = written_csv(src.view("fx_dallas_account").select(*DALLAS_COLUMNS), "s13", ",")
    return delimited.read_strings(src.spark, path, DALLAS_COLUMNS)


@query(
    "s14_sniffed_first_rows",
    "",
    """WITH c AS (SELECT cast(c_custkey AS string) AS id, c_name FROM customer),
    f AS (SELECT cast(c_custkey AS string) AS id, c_name FROM customer ORDER BY c_custkey LIMIT 40)
    SELECT k.kind, id, c_name FROM f, (VALUES ('csv'), ('json'), ('parquet')) k(kind)
    UNION ALL SELECT 'tab', id, c_name FROM c""",
)
def s14(src: Inputs):
    root = scratch_path(src.spark, "s14")
    rows = src.table("customer").orderBy("c_custkey").select(F.col("c_custkey").cast("string").alias("id"), "c_name")
    sinks.write_frame(rows, f"{root}/a.csv", "csv")
    sinks.write_frame(rows, f"{root}/a.json", "json")
    sinks.write_frame(rows, f"{root}/a.parquet", "parquet")
    rows.write.option("header", True).option("sep", "\t").csv(f"{root}/a.txt")
    out = None
    for name, n in [("a.csv", 40), ("a.json", 40), ("a.parquet", 40), ("a.txt", None)]:
        kind = delimited.sniff_format(name)
        first = delimited.first_rows(src.spark, f"{root}/{name}", ["id", "c_name"], n).withColumn("kind", F.lit(kind))
        out = first if out is None else out.unionByName(first)
    return out


@query(
    "k1_write_formats",
    "",
    """SELECT f.fmt, o_orderkey, o_orderstatus, o_totalprice FROM orders,
    (VALUES ('parquet'), ('csv'), ('json')) f(fmt)""",
)
def k1(src: Inputs):
    root = scratch_path(src.spark, "k1")
    rows = src.table("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    out = None
    for fmt in sinks.FORMATS:
        sinks.write_frame(rows, f"{root}/{fmt}", fmt)
        reader = src.spark.read.schema(rows.schema)
        back = reader.option("header", True).format(fmt).load(f"{root}/{fmt}")
        back = back.withColumn("fmt", F.lit(fmt))
        out = back if out is None else out.unionByName(back)
    return out


OWNER_ROWS_SQL = f"""SELECT 'owner' AS kind, {H_ID} AS id, row_number() OVER (PARTITION BY acct ORDER BY ln_num) AS n,
        nullif(trim(name), '') AS name, CAST(ln_num AS int) AS line FROM fx_owners
    WHERE acct IN (SELECT trim(acct) FROM fx_real_acct)"""


def owner_rows(children: DataFrame) -> DataFrame:
    """Every owner with its place among those of the account."""
    place = F.row_number().over(Window.partitionBy("account_id").orderBy("position"))
    return children.select(
        F.lit("owner").alias("kind"),
        F.col("account_id").alias("id"),
        place.cast("bigint").alias("n"),
        text.blank_to_null(text.strip(F.col("child.name"))).alias("name"),
        F.col("child.line_number").alias("line"),
    )


@query(
    "k2_nested_json_export",
    "fx_real_acct fx_owners",
    f"""SELECT 'record' AS kind, {H_ID} AS id, (SELECT count(*) FROM fx_owners o WHERE o.acct = trim(a.acct)) AS n,
        NULL AS name, NULL AS line FROM fx_real_acct a
    UNION ALL SELECT 'manifest', 'harris', count(*), NULL, NULL FROM fx_real_acct UNION ALL {OWNER_ROWS_SQL}""",
)
def k2(src: Inputs):
    path = scratch_path(src.spark, "k2")
    files = harris.HarrisFiles(src.view("fx_real_acct"), src.view("fx_owners"))
    pages = {family: nested.pages(PAGE) for family, nested in harris.children(files).items()}
    sinks.export_records(harris.unified_records(files, arrays=False), path, "harris", RUN_TIME, pages)
    counts = "account_id string, child_counts struct<owners: bigint>"
    back = src.spark.read.schema(counts).json(f"{path}/records")
    manifest = src.spark.read.schema("county string, record_count bigint").json(f"{path}/manifest")
    owners = sinks.exported_children(src.spark, path, "owners", pages["owners"].schema, "account_id")
    heads = back.select(
        F.lit("record").alias("kind"),
        F.col("account_id").alias("id"),
        F.col("child_counts.owners").alias("n"),
    ).unionByName(
        manifest.select(
            F.lit("manifest").alias("kind"),
            F.col("county").alias("id"),
            F.col("record_count").alias("n"),
        )
    )
    # children of accounts without a record stay in the pages; here those of the records are compared
    known = owners.join(back.select("account_id"), "account_id", "left_semi")
    return heads.unionByName(owner_rows(known), allowMissingColumns=True)


@query(
    "k3_flat_csv_export",
    "fx_real_acct fx_owners fx_deeds fx_permits fx_mineral fx_nbhd",
    f"""SELECT {H_ID.replace('acct', 'a.acct')} AS acct, trim(a.mailto) AS mailto,
        trim(o.name) AS primary_owner_name, nullif(o.pct_own, '') AS primary_ownership_pct,
        n.dscr AS neighborhood_description, n.grp_cd AS neighborhood_group,
        trim(a.acct) IN (SELECT acct FROM fx_mineral) AS has_mineral_rights, ow.n AS total_owners,
        de.n AS total_deeds, pe.n AS total_permits
    FROM fx_real_acct a
    LEFT JOIN (SELECT * FROM fx_owners WHERE ln_num = 1) o ON trim(a.acct) = o.acct
    LEFT JOIN fx_nbhd n ON a.market_area_1 = cast(n.cd AS string)
    LEFT JOIN (SELECT acct, count(*) AS n FROM fx_owners GROUP BY acct) ow ON trim(a.acct) = ow.acct
    LEFT JOIN (SELECT cast(cast(acct AS bigint) AS string) AS acct, count(*) AS n FROM fx_deeds GROUP BY 1) de
        ON trim(a.acct) = de.acct
    LEFT JOIN (SELECT acct, count(*) AS n FROM fx_permits GROUP BY acct) pe ON trim(a.acct) = pe.acct""",
)
def k3(src: Inputs):
    files = harris_files(src)

    def normal(df):
        return harris.keyed(df).withColumn("acct", F.col("account_id")).drop("account_id")

    flat = gold.flat_export(
        harris.HarrisFiles(
            accounts=normal(files.accounts),
            owners=normal(files.owners),
            deeds=normal(files.deeds),
            permits=normal(files.permits),
            minerals=normal(files.minerals),
            neighborhoods=files.neighborhoods,
        )
    )
    path = scratch_path(src.spark, "k3")
    sinks.write_frame(flat, path, "csv")
    back = delimited.read_strings(src.spark, path, flat.columns, escape='"')
    return back.select(
        "acct",
        F.trim("mailto").alias("mailto"),
        F.trim("primary_owner_name").alias("primary_owner_name"),
        text.blank_to_null(F.col("primary_ownership_pct")).alias("primary_ownership_pct"),
        "neighborhood_description",
        "neighborhood_group",
        F.col("has_mineral_rights").cast("boolean").alias("has_mineral_rights"),
        *[F.col(c).cast("bigint").alias(c) for c in ("total_owners", "total_deeds", "total_permits")],
    )


def _order_records(src: Inputs, keep) -> DataFrame:
    """Orders as records keyed by customer: many rows per account, the last order wins."""
    return src.table("orders").filter(keep).select(
        F.lpad(F.col("o_custkey").cast("string"), 13, "0").alias("account_id"),
        F.lit("harris").alias("county"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("market_value"),
        F.col("o_orderkey").alias("source_pos"),
    )


FIRST_BATCH = "o_orderkey % 3 <> 0"
SECOND_BATCH = "o_orderkey % 2 = 0 OR o_orderkey % 3 = 0"  # every order is in a batch, some are in both


@query(
    "k4_upsert",
    "",
    f"""WITH a AS (SELECT o_custkey, o_totalprice FROM orders WHERE {FIRST_BATCH}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1),
    b AS (SELECT o_custkey, o_totalprice FROM orders WHERE {SECOND_BATCH}
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT 'record' AS kind, lpad(cast(coalesce(b.o_custkey, a.o_custkey) AS string), 13, '0') AS id,
        cast(coalesce(b.o_totalprice, a.o_totalprice) AS decimal(18,2)) AS value,
        CASE WHEN b.o_custkey IS NULL THEN 'first' ELSE 'second' END AS batch_id,
        a.o_custkey IS NOT NULL AS seen_before FROM a FULL JOIN b ON a.o_custkey = b.o_custkey
    UNION ALL SELECT 'inserted', NULL, count(*), 'second', NULL FROM b WHERE o_custkey NOT IN (SELECT o_custkey FROM a)
    UNION ALL SELECT 'replaced', NULL, count(*), 'second', NULL FROM b WHERE o_custkey IN (SELECT o_custkey FROM a)
    UNION ALL SELECT 'duplicates', NULL, (SELECT count(*) FROM orders WHERE {SECOND_BATCH}) - count(*), 'second', NULL
        FROM b""",
)
def k4(src: Inputs):
    root = scratch_path(src.spark, "k4")
    first, second = _order_records(src, FIRST_BATCH), _order_records(src, SECOND_BATCH)
    store.upsert(src.spark, root, first, "first", RUN_TIME, "source_pos")
    counts = store.upsert(src.spark, root, second, "second", LATER, "source_pos")
    again = store.upsert(src.spark, root, second, "second", LATER, "source_pos")
    if counts != again:
        raise AssertionError("a replayed batch must not be applied twice")
    records = store.read_store(src.spark, root).select(
        F.lit("record").alias("kind"),
        F.col("account_id").alias("id"),
        F.col("market_value").alias("value"),
        "metadata.batch_id",
        (F.col("metadata.created_at") == F.lit(RUN_TIME).cast("timestamp")).alias("seen_before"),
    )
    log = store.commits(src.spark, root).filter("batch_id = 'second'").dropDuplicates(["batch_id"])
    numbers = log.unpivot(
        "batch_id", ["inserted_count", "replaced_count", "duplicate_count"], "kind", "value"
    ).select(
        F.element_at(
            F.create_map(
                *[
                    F.lit(x)
                    for x in (
                        "inserted_count", "inserted", "replaced_count", "replaced",
                        "duplicate_count", "duplicates",
                    )
                ]
            ),
            F.col("kind"),
        ).alias("kind"),
        F.col("value").cast("decimal(18,2)").alias("value"),
        "batch_id",
    )
    return records.unionByName(numbers, allowMissingColumns=True)


@query(
    "k5_run_log",
    "",
    """SELECT 'run_' || lower(r_name) AS batch_id, CASE WHEN r_regionkey % 2 = 0 THEN 'completed' ELSE 'failed' END
        AS status, (SELECT count(*) FROM nation n JOIN customer ON c_nationkey = n_nationkey
            WHERE n_regionkey = r_regionkey) AS total_records,
        CASE WHEN r_regionkey % 2 = 0 THEN (SELECT count(*) FROM nation n JOIN customer ON c_nationkey = n_nationkey
            WHERE n_regionkey = r_regionkey) ELSE 0 END AS saved_records,
        CASE WHEN r_regionkey % 2 = 1 THEN 'boom' END AS error FROM region""",
)
def k5(src: Inputs):
    root = scratch_path(src.spark, "k5")
    per_region = (
        src.table("customer")
        .join(src.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy("n_regionkey")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(src.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    runs = per_region.select(
        F.concat(F.lit("run_"), F.lower("r_name")).alias("batch_id"), "r_regionkey", "n"
    )
    failed = F.col("r_regionkey") % 2 == 1
    start = runs.select(
        "batch_id",
        F.lit(runlog.EVENT_NO["started"]).alias("event_no"),
        F.lit("started").alias("status"),
        F.lit(RUN_TIME).cast("timestamp").alias("event_time"),
        F.col("n").alias("total_records"),
        F.lit(0).cast("bigint").alias("saved_records"),
        F.lit(None).cast("string").alias("error"),
        F.array().cast("array<string>").alias("source_files"),
    )
    end = start.join(runs.select("batch_id", "r_regionkey"), "batch_id").select(
        "batch_id",
        F.lit(runlog.EVENT_NO["completed"]).alias("event_no"),
        F.when(failed, "failed").otherwise("completed").alias("status"),
        F.lit(LATER).cast("timestamp").alias("event_time"),
        "total_records",
        F.when(failed, 0).otherwise(F.col("total_records")).alias("saved_records"),
        F.when(failed, "boom").alias("error"),
        "source_files",
    )
    start.write.mode("append").parquet(f"{root}/runs")
    end.write.mode("append").parquet(f"{root}/runs")
    return runlog.current_runs(runlog.events(src.spark, root)).select(
        "batch_id", "status", "total_records", "saved_records", "error"
    )


@query(
    "k6_backup",
    "fx_real_acct fx_owners",
    f"""SELECT 'record' AS kind, {H_ID} AS id, '2025-06-01T12:00:00.000000Z' AS created_at, 1 AS n, NULL AS name,
        NULL AS line FROM fx_real_acct
    UNION ALL SELECT 'manifest', 'all', '{LATER}', count(*), NULL, NULL FROM fx_real_acct
    UNION ALL SELECT kind, id, NULL, n, name, line FROM ({OWNER_ROWS_SQL})""",
)
def k6(src: Inputs):
    """A store with all children, after a first batch of other ones, is backed up and read again."""
    root = scratch_path(src.spark, "k6")
    files = harris.HarrisFiles(src.view("fx_real_acct"), src.view("fx_owners"))
    records = harris.unified_records(files, arrays=False).withColumn("pos", F.lit(1))
    stale = harris.HarrisFiles(files.accounts, files.owners.filter("ln_num = 1"))
    store.upsert(src.spark, root, records, "stale", RUN_TIME, "pos", children=harris.children(stale))
    store.upsert(src.spark, root, records, "b1", LATER, "pos", children=harris.children(files))
    pages = store.child_pages(src.spark, root, "owners")
    sinks.backup(store.read_store(src.spark, root), f"{root}/backup", LATER, {"owners": pages})
    kind = "account_id string, metadata struct<created_at: string>"
    back = src.spark.read.schema(kind).json(f"{root}/backup/records")
    manifest = src.spark.read.schema("county string, created_at string, record_count bigint").json(
        f"{root}/backup/manifest"
    )
    heads = back.select(
        F.lit("record").alias("kind"),
        F.col("account_id").alias("id"),
        "metadata.created_at",
        F.lit(1).cast("bigint").alias("n"),
    ).unionByName(
        manifest.select(
            F.lit("manifest").alias("kind"),
            F.col("county").alias("id"),
            "created_at",
            F.col("record_count").alias("n"),
        )
    )
    owners = sinks.exported_children(src.spark, f"{root}/backup", "owners", pages.schema, "account_id")
    return heads.unionByName(owner_rows(owners), allowMissingColumns=True)


@query(
    "k7_run_metadata",
    "fx_real_acct",
    f"""SELECT {H_ID} AS account_id, 'b7' AS batch_id, '1.0' AS version, 'normalized_bulk' AS ingestion_type,
    2 AS files, 'a.txt' AS first_file FROM fx_real_acct""",
)
def k7(src: Inputs):
    records = harris.unified_records(harris.HarrisFiles(src.view("fx_real_acct")))
    tagged = store.with_run_metadata(records, "b7", RUN_TIME, ["a.txt", "b.txt"])
    return tagged.select(
        "account_id",
        "metadata.batch_id",
        "metadata.version",
        "metadata.ingestion_type",
        F.size("metadata.source_files").alias("files"),
        F.col("metadata.source_files")[0].alias("first_file"),
    )


def _split_files(df: DataFrame, label: str, files: int = 4) -> str:
    path = scratch_path(df.sparkSession, label)
    df.repartition(files).write.option("header", True).option("sep", "\t").option(
        "escape", '"'
    ).option("emptyValue", "").csv(path)
    return path


@query(
    "r1_incremental_ingest",
    "fx_owners",
    """SELECT acct, cast(ln_num AS string) AS ln_num, trim(name) AS name, cast(nullif(pct_own, '') AS double) AS pct_own,
        ln_num = 1 AS is_primary_owner, regexp_replace(upper(trim(name)), '[^A-Z0-9 ]', '', 'g') AS name_normalized
    FROM fx_owners""",
)
def r1(src: Inputs):
    root = scratch_path(src.spark, "r1")
    owners = src.view("fx_owners")
    folder = _split_files(owners, "r1-in")
    stream = ingest.stream_lines_of(src.spark, folder, owners.columns, "\t", files_per_batch=2)
    done = ingest.ingest_files(stream, tables.clean_owners, f"{root}/out", f"{root}/checkpoint")
    done.awaitTermination()
    return src.spark.read.parquet(f"{root}/out").select(
        "acct", "ln_num", "name", "pct_own", "is_primary_owner", "name_normalized"
    )


@query(
    "r2_streamed_upsert",
    "",
    """SELECT lpad(cast(c_custkey AS string), 13, '0') AS account_id, c_name AS name, c_mktsegment AS segment
    FROM customer""",
)
def r2(src: Inputs):
    root = scratch_path(src.spark, "r2")
    customers = src.table("customer").select(
        F.col("c_custkey").cast("string").alias("acct"), "c_name", "c_mktsegment"
    )
    folder = _split_files(customers, "r2-in")
    stream = ingest.stream_lines_of(src.spark, folder, customers.columns, "\t", files_per_batch=2)

    def to_records(batch: DataFrame) -> DataFrame:
        return harris.keyed(batch).select(
            "account_id",
            F.lit("harris").alias("county"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("segment"),
            F.col("acct").cast("bigint").alias("source_pos"),
        )

    ingest.ingest_upserts(
        stream, to_records, root, f"{root}/checkpoint", "r2", RUN_TIME, "source_pos"
    ).awaitTermination()
    return store.read_store(src.spark, root).select("account_id", "name", "segment")


@query(
    "a24_store_statistics",
    "fx_real_acct",
    """SELECT count(*) AS properties_count, 2 AS logs_count, 'second' AS latest_batch, 'completed' AS latest_status,
        'account_id,county,valuation,metadata' AS fields FROM fx_real_acct""",
)
def a24(src: Inputs):
    root = scratch_path(src.spark, "a24")
    records = harris.account_records(src.view("fx_real_acct")).select(
        "account_id", "county", "valuation", F.col("account_id").cast("bigint").alias("source_pos")
    )
    store.upsert(src.spark, root, records, "first", RUN_TIME, "source_pos")
    store.upsert(src.spark, root, records, "second", LATER, "source_pos")
    return store.store_statistics(store.read_store(src.spark, root), runlog.events(src.spark, root))



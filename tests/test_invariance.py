"""Results do not depend on the number of partitions; streamed results equal batch results."""

import duckdb
import pytest
from pyspark.sql import functions as F

from parcelmill.catalog import REGISTRY
from parcelmill.catalog.registry import Inputs
from parcelmill.session import scratch_path
from parcelmill.sources import tables
from parcelmill.streaming import ingest
from tools.check_oracle import compare, connect, rows_sorted

KEYS = ["j1_accounts_owners", "n2_harris_owners", "w2_last_per_key", "a1_account_summary", "t4_rooms", "l6_sample_per_county"]


def collected(df):
    return rows_sorted(df.collect(), range(len(df.columns)))


@pytest.mark.parametrize("key", KEYS)
def test_partition_count_does_not_matter(key, spark, sf_dir):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "8"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            results.append(collected(REGISTRY[key].run(Inputs(spark, sf_dir))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_streamed_ingest_equals_batch(spark, sf_dir):
    root = scratch_path(spark, "t-stream")
    owners = Inputs(spark, sf_dir).view("fx_owners")
    text = owners.select(*[F.col(c).cast("string").alias(c) for c in owners.columns])
    text.repartition(3).write.option("header", True).option("sep", "\t").option("emptyValue", "").csv(
        f"{root}/in"
    )
    stream = ingest.stream_lines_of(spark, f"{root}/in", text.columns, "\t", files_per_batch=1)
    query = ingest.ingest_files(stream, tables.clean_owners, f"{root}/out", f"{root}/check")
    query.awaitTermination()
    assert len(query.recentProgress) >= 3
    streamed = spark.read.parquet(f"{root}/out")
    batch = tables.clean_owners(
        spark.read.schema(text.schema).option("header", True).option("sep", "\t").csv(f"{root}/in")
    )
    assert collected(streamed.select(*batch.columns)) == collected(batch)


@pytest.fixture(scope="module")
def skewed(tmp_path_factory, sf_dir):
    """The sample data with a third of all orders and line items on one key."""
    folder = tmp_path_factory.mktemp("skewed")
    moved = {"orders": ("o_custkey", "o_orderkey"), "lineitem": ("l_suppkey", "l_orderkey")}
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        source = f"'{sf_dir}/{name}.parquet'"
        columns = "*"
        if name in moved:
            key, by = moved[name]
            columns = f"* REPLACE (CASE WHEN {by} % 3 = 0 THEN 1 ELSE {key} END AS {key})"
        duckdb.sql(f"COPY (SELECT {columns} FROM {source}) TO '{folder}/{name}.parquet'")
    for name in "events documents embeddings pages benchmark labels conversations".split():
        (folder / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    return str(folder)


@pytest.mark.parametrize(
    "key", ["j1_accounts_owners", "j6_nest_join", "n2_harris_owners", "n4_harris_permits",
            "n12_travis_tax_entities", "w1_first_per_key", "k4_upsert", "u2_union_counties"]
)
def test_one_key_with_a_third_of_the_rows(key, spark, skewed):
    query = REGISTRY[key]
    assert compare(query.run(Inputs(spark, skewed)), connect(skewed), query.oracle) is None


@pytest.fixture(scope="module")
def torn(tmp_path_factory, sf_dir):
    """The sample data with one order whose prices no amount of Dallas can hold."""
    folder = tmp_path_factory.mktemp("torn")
    for name in ("nation", "customer", "supplier", "part", "orders"):
        (folder / f"{name}.parquet").symlink_to(f"{sf_dir}/{name}.parquet")
    source = f"'{sf_dir}/lineitem.parquet'"
    price = f"CASE WHEN l_orderkey = (SELECT min(l_orderkey) FROM {source}) THEN 1e30 ELSE l_extendedprice END"
    duckdb.sql(f"COPY (SELECT * REPLACE ({price} AS l_extendedprice) FROM {source}) TO '{folder}/lineitem.parquet'")
    return str(folder)


@pytest.mark.parametrize(
    "key", ["a11_field_coverage", "a13_category_quality", "a14_missing_key_fields", "a15_completeness_summary",
            "a16_load_coverage", "a17_county_distributions", "a17_feature_presence", "a26_recommendations",
            "l7_critical_fields", "u3_field_sets"]
)
def test_report_without_a_county_is_an_error(key, spark, torn):
    with pytest.raises(RuntimeError, match="dallas: .*NUMERIC_VALUE_OUT_OF_RANGE"):
        REGISTRY[key].run(Inputs(spark, torn))

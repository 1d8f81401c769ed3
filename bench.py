"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR is the data folder, BENCH_CPUS the number of local cores. Each query runs to the end into
a `noop` sink, so every row and column is produced. BENCH_QUERIES may list keys to run.
"""

import json
import os
import time

from parcelmill.catalog import REGISTRY
from parcelmill.catalog.registry import Inputs
from parcelmill.session import build_session

HEADLINE = [
    "flagship_county_values", "p10_safe_casts", "p15_address_standardise", "p19_likely_business",
    "s1_delimited_scan", "s11_fixed_width_scan", "j1_accounts_owners", "j5_child_counts", "j6_nest_join",
    "w1_first_per_key", "n4_harris_permits", "n12_travis_tax_entities", "n16_dallas_record",
    "u2_union_counties", "k3_flat_csv_export", "k4_upsert", "a1_account_summary", "a3_owner_summary",
    "a7_view_statistics", "a11_field_coverage", "a13_category_quality", "a17_county_distributions",
    "a21_profile", "l2_top_business_owners", "l6_sample_per_county", "f4_word_search",
    "r2_streamed_upsert", "t1_best_page_text", "t4_rooms", "t11_system_specs", "t15_category_costs",
    "t18_plan_scores",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
        spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    src = Inputs(spark, sf_dir)
    src.table("nation").write.format("noop").mode("overwrite").save()  # start the executor threads
    times = {}
    for key in keys:
        started = time.perf_counter()
        REGISTRY[key].run(src).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - started, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()

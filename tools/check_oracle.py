"""Run queries against their DuckDB oracle: python tools/check_oracle.py [sf_dir] [key prefix ...]."""

import math
import sys
import time
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (int, Decimal)):
        return float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return str(v)


def rows_sorted(rows, order):
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark_df, con, sql: str):
    """None when equal, else a short text on the difference."""
    cursor = con.execute(sql)
    want_names = [d[0] for d in cursor.description]
    want = cursor.fetchall()
    got_names = spark_df.columns
    if sorted(got_names) != sorted(want_names):
        return f"columns {sorted(got_names)} vs {sorted(want_names)}"
    got = spark_df.collect()
    a = rows_sorted(got, [got_names.index(n) for n in sorted(got_names)])
    b = rows_sorted(want, [want_names.index(n) for n in sorted(want_names)])
    if a == b:
        return None if a else "both empty"
    extra = [r for r in a if r not in set(b)][:2]
    missing = [r for r in b if r not in set(a)][:2]
    return f"rows {len(a)} vs {len(b)}; {sorted(got_names)}; only spark {extra}; only oracle {missing}"


def main():
    from parcelmill.catalog import REGISTRY
    from parcelmill.catalog.registry import Inputs
    from parcelmill.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = build_session("local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for key, q in REGISTRY.items():
        if prefixes and not key.startswith(prefixes):
            continue
        started = time.time()
        try:
            if q.oracle is None:
                result = f"rows only: {q.run(Inputs(spark, sf_dir)).count()}"
            else:
                result = compare(q.run(Inputs(spark, sf_dir)), con, q.oracle)
        except Exception as error:  # report and go on with the next query
            result = f"ERROR {str(error)[:600]}"
        bad += result is not None and not result.startswith("rows only")
        print(f"{key:34s} {time.time() - started:6.2f}s {result or 'ok'}", flush=True)
    print(f"{bad} bad")


if __name__ == "__main__":
    main()

"""Relational operators: keyed rules, large keys, medians, store, repairs and sources."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from parcelmill.operators import joins, keyed, ledger, nesting, quality, quantiles, repair, sampling, search
from parcelmill.plans import dallas, gold, harris, travis
from parcelmill.session import scratch_path
from parcelmill.sources import delimited, json_arrays, runlog, search_index, sinks, store
from parcelmill.sources.fixed_width import IMPROVEMENT, PROP, project_fields
from parcelmill.takeoff import measures, rooms, specs, validate


def test_positions_count_across_spans(frame):
    rows = [("a", i * 7) for i in range(50)] + [("b", 3), ("b", 1), (None, 5)]
    df = keyed.positions(frame(rows, "k string, o long"), ["k"], "o", "pos", span=20)
    got = {(r.k, r.o): r.pos for r in df.collect()}
    assert got == {
        **{("a", i * 7): i + 1 for i in range(50)},
        ("b", 1): 1,
        ("b", 3): 2,
        (None, 5): 1,
    }


def test_carry_forward_across_spans(frame):
    rows = [("p", i, "x" if i == 2 else ("y" if i == 25 else None)) for i in range(0, 60, 3)]
    rows += [("p", 2, "x"), ("p", 25, "y")]
    df = keyed.carry_forward(
        frame(rows, "k string, o long, v string"), ["k"], "o", "v", "seen", span=10
    )
    for r in df.collect():
        want = None if r.o <= 2 else ("x" if r.o <= 25 else "y")
        assert r.seen == want, r


def test_top_per_key_limits_before_the_shuffle(spark, frame):
    df = keyed.first_per_key(frame([("a", 2), ("a", 1), ("b", 9)], "k string, p int"), ["k"], "p")
    assert sorted(map(tuple, df.collect())) == [("a", 1), ("b", 9)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_nesting_holds_all_children(frame):
    """5,000 equal and 5,000 different children of one key are all in the array and in the rows."""
    rows = [("hot", i) for i in range(5000)] + [("hot", 7)] * 5000 + [("a", 2), ("a", 1), ("b", 7)]
    df = frame(rows, "k string, v int")
    nested = nesting.nest_children(df, "k", [F.col("v")], F.struct(F.col("v")))
    arrays = {r.k: [x.v for x in r["items"]] for r in nested.arrays.collect()}
    assert arrays == {"a": [1, 2], "b": [7], "hot": sorted(v for k, v in rows if k == "hot")}
    assert sorted(map(tuple, nested.flat().collect())) == sorted(rows)
    parents = frame([("hot",), ("a",), ("none",)], "k string")
    got = {r.k: (len(r.kids), r.kids_count) for r in nesting.attach(parents, nested, "kids").collect()}
    assert got == {"hot": (10_000, 10_000), "a": (2, 2), "none": (0, 0)}


def test_arrays_are_ordered_without_a_lambda(frame):
    rows = [("a", 2, "x"), ("a", None, "y"), ("a", 2, None), ("a", 1, "z")]
    nested = nesting.nest_children(frame(rows, "k string, v int, w string"), "k", [F.col("v")], F.struct("v", "w"))
    arrays = nested.arrays
    assert [tuple(x) for x in arrays.first()["items"]] == [(None, "y"), (1, "z"), (2, None), (2, "x")]
    plan = arrays._jdf.queryExecution().optimizedPlan().toString()
    assert "sort_array(" in plan and "array_sort(" not in plan


def test_fan_out_left_join(frame):
    parent = frame([("a", 1), ("b", 2), (None, 3)], "k string, p int")
    child = frame([("a", 10), ("a", 11), ("z", 12), (None, 13)], "k string, c int")
    got = sorted(map(tuple, joins.fan_out_left_join(parent, child, "k").collect()), key=str)
    want = sorted(map(tuple, parent.join(child, "k", "left").collect()), key=str)
    assert got == want


@pytest.mark.parametrize(
    "values",
    [[5], [1, 2], [-3, 7, 7, 9], [10**15, 1, 2**43, 2**22, 5], [-(2**50), 0, 2**50, 3], [4] * 9],
)
def test_exact_median(frame, values):
    df = frame([(v,) for v in values] + [(None,)], "v long")
    row = quantiles.median_low_high(df, "v").first()
    assert row.low == statistics.median_low(values)
    assert row.high == statistics.median_high(values)


def test_median_of_nothing(frame):
    row = quantiles.median_low_high(frame([(None,)], "v long"), "v").first()
    assert (row.low, row.high) == (None, None)


def _store_rows(rows):
    return "account_id string, county string, v int, pos long", rows


def test_upsert_replay_and_created_at(spark, frame):
    root = scratch_path(spark, "t-store")
    schema = "account_id string, county string, v int, pos long"
    first = frame([("1", "harris", 1, 1), ("2", "travis", 2, 2), ("1", "harris", 3, 3)], schema)
    counts = store.upsert(spark, root, first, "b1", "2025-01-01 00:00:00", "pos")
    assert (counts["inserted_count"], counts["duplicate_count"]) == (2, 1)
    second = frame([("1", "dallas", 9, 1), ("3", "harris", 4, 2)], schema)
    counts = store.upsert(spark, root, second, "b2", "2025-01-02 00:00:00", "pos")
    assert (counts["inserted_count"], counts["replaced_count"]) == (1, 1)
    assert store.upsert(spark, root, second, "b2", "2025-01-03 00:00:00", "pos") == counts
    got = {
        r.account_id: (r.county, r.v, str(r.metadata.created_at)[:10], str(r.metadata.updated_at)[:10])
        for r in store.read_store(spark, root).collect()
    }
    assert got == {
        "1": ("dallas", 9, "2025-01-01", "2025-01-02"),
        "2": ("travis", 2, "2025-01-01", "2025-01-01"),
        "3": ("harris", 4, "2025-01-02", "2025-01-02"),
    }


def test_reload_drops_the_county(spark, frame):
    root = scratch_path(spark, "t-reload")
    schema = "account_id string, county string, v int, pos long"
    rows = [(str(i), "harris" if i % 2 else "travis", i, i) for i in range(20)]
    store.upsert(spark, root, frame(rows, schema), "b1", "2025-01-01 00:00:00", "pos")
    fresh = frame([("1", "harris", 100, 1)], schema)
    store.upsert(
        spark, root, fresh, "b2", "2025-01-02 00:00:00", "pos", reload_county="harris"
    )
    got = {(r.account_id, r.v) for r in store.read_store(spark, root).collect()}
    assert got == {("1", 100)} | {(str(i), i) for i in range(0, 20, 2)}


def test_compaction_keeps_the_records_and_the_replays(spark, frame):
    root = scratch_path(spark, "t-compact")
    schema = "account_id string, county string, v int, pos long"
    batches = {
        "b1": [("1", "harris", 1, 1), ("2", "travis", 2, 2)],
        "b2": [("1", "dallas", 9, 1), ("3", "harris", 4, 2)],
        "b3": [("4", None, 5, 1), ("2", "travis", 6, 2)],
    }
    counts = {
        b: store.upsert(spark, root, frame(rows, schema), b, f"2025-01-0{b[1]} 00:00:00", "pos")
        for b, rows in batches.items()
    }
    before = sorted(map(str, store.read_store(spark, root).collect()))
    store.compact(spark, root)
    assert sorted(map(str, store.read_store(spark, root).collect())) == before
    assert len(before) == 4
    again = store.upsert(spark, root, frame(batches["b2"], schema), "b2", "2025-01-09 00:00:00", "pos")
    assert again == counts["b2"]
    late = store.upsert(spark, root, frame([("4", "dallas", 7, 1)], schema), "b4", "2025-01-04 00:00:00", "pos")
    assert late["replaced_count"] == 1
    got = {r.account_id: (r.v, str(r.metadata.created_at)[:10]) for r in store.read_store(spark, root).collect()}
    assert got == {"1": (9, "2025-01-01"), "2": (6, "2025-01-01"), "3": (4, "2025-01-02"), "4": (7, "2025-01-03")}


def test_failed_upsert_is_logged_and_leaves_the_store(spark, frame):
    root = scratch_path(spark, "t-fail")
    schema = "account_id string, county string, v int, pos long"
    store.upsert(
        spark, root, frame([("1", "harris", 1, 1)], schema), "b1", "2025-01-01 00:00:00", "pos"
    )
    broken = frame([("2", "harris", 1, 1)], schema).withColumn(
        "v", F.raise_error(F.lit("boom")).cast("int")
    )
    with pytest.raises(Exception):
        store.upsert(spark, root, broken, "b2", "2025-01-02 00:00:00", "pos")
    runs = {r.batch_id: r.status for r in runlog.current_runs(runlog.events(spark, root)).collect()}
    assert runs == {"b1": "completed", "b2": "failed"}
    assert [r.account_id for r in store.read_store(spark, root).collect()] == ["1"]


def test_upsert_recovers_after_a_crash_before_the_commit(spark, frame, monkeypatch):
    """Data is written, the commit is not: the retry writes its own folder, the other is never read."""
    root = scratch_path(spark, "t-crash")
    schema = "account_id string, county string, v int, pos long"
    rows = frame([("1", "harris", 1, 1), ("2", "dallas", 5, 2)], schema)
    with monkeypatch.context() as patched:
        patched.setattr(store, "_commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost driver")))
        with pytest.raises(RuntimeError):
            store.upsert(spark, root, rows, "b1", "2025-01-01 00:00:00", "pos")
    assert store.read_store(spark, root) is None
    store.upsert(spark, root, rows.filter("v = 1"), "b1", "2025-01-01 00:00:00", "pos")
    assert [r.account_id for r in store.read_store(spark, root).collect()] == ["1"]


def test_random_sample_gives_what_is_asked(spark):
    rows = spark.range(4000).selectExpr("cast(id AS string) AS id")
    assert sampling.random_sample(rows, "id", 3000, "s").count() == 3000


def test_unknown_format_is_an_error(spark, frame):
    with pytest.raises(ValueError):
        sinks.write_frame(frame([(1,)], "a int"), scratch_path(spark, "x"), "orc")


def test_json_array_file(spark, tmp_path):
    good, bad = tmp_path / "a.json", tmp_path / "b.json"
    good.write_text(json.dumps([{"a": 1}, {"a": 2}], indent=1))
    bad.write_text("{broken")
    schema = spark.createDataFrame([], "a int").schema
    records, corrupt = delimited.read_json_records(spark, str(tmp_path), schema, array_file=True)
    assert sorted(r.a for r in records.collect()) == [1, 2]
    assert [r._corrupt for r in corrupt.collect()] == ["{broken"]


def test_elements_of_one_json_array_stay_dealt_out(spark, tmp_path):
    """What is known of a file meets its first and last element alone; joined by file, all were in one task."""
    (tmp_path / "a.json").write_text(" [" + ",".join(json.dumps({"v": i, "t": 'a, [" {'}) for i in range(400)) + "]\n")
    (tmp_path / "empty.json").write_text("[ ]")
    (tmp_path / "one.json").write_text('[{"v": -1}]')
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = json_arrays.array_elements(spark, str(tmp_path)).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(json.loads(r["value"])["v"] for r in found) == [-1, *range(400)]
    assert len({r.task for r in found if r.file.endswith("/a.json")}) > 1


def test_json_array_is_read_in_splits(spark, tmp_path):
    texts = ["plain", 'q"uote', "back\\", 'both\\"', "[", "]}", "{,,[", ",", "", "a,b,\\,", "\n,\t", "é漢,🙂"]
    rows = [{"a": i, "t": texts[i % len(texts)], "l": [1, [2, {"x": ",]"}]], "o": {"k": texts[-i % len(texts)]}} for i in range(3000)]
    (tmp_path / "big.json").write_text(" \n[" + ", ".join(json.dumps(r, ensure_ascii=i % 2 == 0, indent=None if i % 3 else 1) for i, r in enumerate(rows)) + "\n]\n ")
    (tmp_path / "none.json").write_text("[ ]")
    (tmp_path / "one.json").write_text('[{"a": 7, "t": "x"}]')
    (tmp_path / "torn.json").write_text('[{"a": 8, "t": "y"}, {"a": nine}, {"a": 10}]')
    schema = spark.createDataFrame([], "a int, t string").schema
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20k")
    try:
        assert spark.read.option("lineSep", ",").text(str(tmp_path)).rdd.getNumPartitions() > 8
        records, corrupt = delimited.read_json_records(spark, str(tmp_path), schema, array_file=True)
        got = sorted((r.a, r.t) for r in records.collect() if r.t is not None)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == sorted([(r["a"], r["t"]) for r in rows] + [(7, "x"), (8, "y")])
    assert [r._corrupt for r in corrupt.collect()] == ['{"a": nine}']


def test_delimited_null_tokens(spark, tmp_path):
    (tmp_path / "f.txt").write_text("a\tb\tc\nx\tN/A\t2025-01-31\nNULL\t1,5\tbad\n")
    df = delimited.read_delimited(
        spark, str(tmp_path / "f.txt"), {"a": "string", "b": "int", "c": "date"}
    )
    rows = [(r.a, r.b, str(r.c)) for r in df.collect()]
    assert rows == [("x", None, "2025-01-31"), (None, 15, "None")]


def test_short_lines_and_fields_beyond_the_end(frame):
    line = "000000100008" + "0000000001" + "1st Floor".ljust(20) + "R".ljust(20) + "2013" + "0000002986"
    whole = (line + "0000080037" + "DESC".ljust(50), line + "0000080037" + " " * 20, "short")
    df = project_fields(frame([(w,) for w in whole], "value string"), IMPROVEMENT)
    rows = sorted(map(tuple, df.collect()), key=str)
    assert len(rows) == 2
    assert rows[0][:1] == ("000000100008",)
    assert {r[-1] for r in rows} == {"DESC", None}
    assert {(r[4], r[5], r[6]) for r in rows} == {(2013, 2986, 80037)}


def test_all_zero_and_bad_numbers(frame):
    money = [" " * 15, "000000000000000", "00012x000000000", "000250000000000"]
    lines = [("1".zfill(12) + "R" + " " * 1822 + m + " " * 400,) for m in money]
    df = project_fields(frame(lines, "value string"), PROP)
    assert df.select("account_id").distinct().count() == 1
    got = [None if r.land_value is None else float(r.land_value) for r in df.collect()]
    assert got == [None, None, 0.0, 250.0]


def test_extraction_status(frame):
    lines = [("x" * 50,), (" " * 120,), ("0" * 12 + "y" * 120,), ("1" * 130,)]
    got = {r.status: r.lines for r in travis.extraction_status(frame(lines, "value string"), PROP).collect()}
    assert got == {"short": 1, "no_key": 2, "ok": 1}


def test_first_properties_counts_distinct_accounts(frame):
    lines = [("1" * 12 + "y" * 120, 1), ("1" * 12 + "z" * 120, 2), ("2" * 12 + "y" * 120, 3)]
    df = frame(lines, "value string, source_pos long")
    assert travis.first_properties(df, 2).count() == 2
    kept = travis.lines_of(df, travis.first_properties(df, 1))
    assert kept.count() == 2


def test_legacy_flags(frame):
    df = frame(
        [("7 ", "01   ", "HOUSTON", "001 040,041", " ", "0", "5")],
        "acct string, school_dist string, site_addr_2 string, jurs string, yr_impr string, "
        "bld_ar string, market_area_1 string",
    )
    row = harris.account_records(df).first()
    assert [e.jurisdiction_id for e in row.tax_entities] == [
        "01", "HARRIS", "HOUSTON", "001", "040", "041",
    ]
    assert row.improvements == []
    old = harris.account_records(df, legacy_split=True, legacy_truthy=True).first()
    assert [e.jurisdiction_id for e in old.tax_entities][3:] == ["001_040", "041"]
    assert [i.improvement_type for i in old.improvements] == ["Main Building"]


def test_harris_optional_files(frame):
    df = frame([("7", "2025", "5")], "acct string, yr string, market_area_1 string")
    row = harris.unified_records(harris.HarrisFiles(df)).first()
    assert row.account_id == "0000000000007" and row.owners == [] and row.mineral_rights is None


def test_dallas_absent_cells_build_nothing(frame):
    accounts = frame([("1", "A", None, 1)], "account_num string, owner_name1 string, bldg_id string, source_pos int")
    res = frame([("1", None, " ", 1)], "account_num string, yr_built string, tot_main_sf string, source_pos int")
    row = dallas.unified_records(dallas.DallasFiles(accounts, residential=res)).first()
    assert row.improvements == [] and len(row.land_details) == 1
    assert float(row.owners[0].percentage) == 100.0


def test_counties_fail_alone(spark, frame):
    df = frame([("7", "2025", "5")], "acct string, yr string, market_area_1 string")
    records, status = gold.union_counties(
        spark,
        {
            "harris": lambda: harris.unified_records(harris.HarrisFiles(df)),
            "travis": lambda: spark.read.parquet("/no/such/folder"),
            # planning works, reading fails
            "dallas": lambda: harris.unified_records(harris.HarrisFiles(df.withColumn("yr", F.raise_error(F.lit("torn"))))),
        },
        scratch_path(spark, "t-union"),
    )
    assert records.count() == 1
    got = {r.county: r for r in status.collect()}
    assert {c: r.status for c, r in got.items()} == {"harris": "ok", "travis": "failed", "dallas": "failed"}
    assert "PATH_NOT_FOUND" in got["travis"].error and got["harris"].records == 1 and got["dallas"].records == 0


def test_all_counties_or_an_error(spark, frame):
    rows = {c: frame([(str(i), "2025", "5")], "acct string, yr string, market_area_1 string") for i, c in enumerate(["harris", "travis", "dallas"], 1)}
    whole = {c: lambda df=df: harris.unified_records(harris.HarrisFiles(df)) for c, df in rows.items()}
    records = gold.all_counties(spark, whole, scratch_path(spark, "t-all"))
    assert sorted(r.account_id for r in records.collect()) == ["0000000000001", "0000000000002", "0000000000003"]
    torn = {
        "travis": lambda: spark.read.parquet("/no/such/folder"),
        "dallas": lambda: harris.unified_records(harris.HarrisFiles(rows["dallas"].withColumn("yr", F.raise_error(F.lit("torn"))))),
    }
    with pytest.raises(RuntimeError, match=r"travis: .*PATH_NOT_FOUND.*; dallas: .*torn") as told:
        gold.all_counties(spark, whole | torn, scratch_path(spark, "t-all"))
    assert "PATH_NOT_FOUND" in str(told.value.__cause__)


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_many_small_batches_stay_readable(spark, frame):
    root = scratch_path(spark, "t-many")
    schema = "account_id string, county string, v int, pos long"
    want = {}
    for b in range(20):
        rows = [(str(k), "harris" if k % 3 else "travis", 100 * b + k, 1) for k in range(b % 7, 40, 1 + b % 5)]
        want |= {r[0]: r[2] for r in rows}
        store.upsert(spark, root, frame(rows, schema), f"b{b}", f"2025-01-01 00:00:{b:02d}", "pos", buckets=2, compact_after=4)
        if b in (2, 5):  # a plan of one scan, without an exchange, before and after batches were merged
            read = store.read_store(spark, root)
            assert _exchanges(read) == 0 and read._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert {r.account_id: r.v for r in store.read_store(spark, root).collect()} == want
    assert len(store._current(spark, root)) <= 5
    counted = ledger.coverage(store.coverage_ledger(spark, root), ["account_id"]).collect()
    assert {r.county: r.total for r in counted} == {"harris": sum(int(k) % 3 > 0 for k in want), "travis": sum(int(k) % 3 == 0 for k in want)}


def test_ledger_follows_batches_patches_and_reloads(spark, frame):
    root = scratch_path(spark, "t-ledger")
    section = "struct<street_address: string, full_address: string>"
    schema = f"account_id string, county string, property_address {section}, year int, pos long"
    batches = [
        ([("1", "harris", ("a", "x"), 1, 1), ("2", "harris", (None, "y"), 0, 1), ("3", "travis", (None, None), 2, 1)], None),
        ([("3", "dallas", ("b", None), 2, 1), ("4", None, ("c", "z"), None, 1), ("2", "harris", (None, "w"), 5, 1)], None),
        ([("5", "harris", (None, "q"), 7, 1), ("1", "harris", (" ", "r"), 0, 1)], "harris"),
    ]

    def agrees():
        records = store.read_store(spark, root)
        paths = ["account_id", "county", "year", "property_address"]
        direct = quality.field_coverage(records, paths).select("county", "field", "total", "present", "non_empty")
        summed = ledger.coverage(store.coverage_ledger(spark, root), paths).select("county", "field", "total", "present", "non_empty")
        assert sorted(map(tuple, direct.collect()), key=repr) == sorted(map(tuple, summed.collect()), key=repr)
        return {r.account_id: (r.county, r.property_address.street_address, r.year) for r in records.collect()}

    for i, (rows, reload_county) in enumerate(batches):
        store.upsert(spark, root, frame(rows, schema), f"b{i}", f"2025-01-0{i + 1} 00:00:00", "pos", reload_county=reload_county)
        agrees()
    counts = store.repair(spark, root, repair.fill_county, "county", "m1", "2025-01-05 00:00:00")
    assert counts["replaced_count"] == 1 and agrees()["4"] == ("harris", "c", None)
    counts = store.repair(spark, root, repair.fill_street_address, "property_address.street_address", "m2", "2025-01-06 00:00:00")
    assert counts["replaced_count"] == 1 and agrees()["5"] == ("harris", "q", 7)
    assert store.repair(spark, root, repair.fill_county, "county", "m1", "2025-01-07 00:00:00")["replaced_count"] == 1  # replayed
    want = {"1": ("harris", " ", 0), "3": ("dallas", "b", 2), "4": ("harris", "c", None), "5": ("harris", "q", 7)}
    assert agrees() == want
    store.compact(spark, root)
    assert agrees() == want and len(store._current(spark, root)) == 1
    store.upsert(spark, root, frame([("5", "travis", (None, None), 1, 1)], schema), "b9", "2025-01-09 00:00:00", "pos")
    assert agrees() == want | {"5": ("travis", None, 1)}  # a whole record ends what was laid over the one before
    # a reload ends a record whose county a patch has set
    store.upsert(spark, root, frame([("6", None, ("d", None), 1, 1)], schema), "b10", "2025-01-10 00:00:00", "pos")
    store.repair(spark, root, repair.fill_county, "county", "m1b", "2025-01-11 00:00:00")
    store.upsert(spark, root, frame([("7", "harris", ("e", None), 1, 1)], schema), "b11", "2025-01-12 00:00:00", "pos", reload_county="harris")
    assert set(agrees()) == {"3", "5", "7"}


def test_a_damaged_log_is_no_empty_store(spark, frame, tmp_path):
    (tmp_path / "commits").mkdir()
    (tmp_path / "commits" / "part-0.parquet").write_text("torn")
    with pytest.raises(Exception):
        store.read_store(spark, str(tmp_path))
    assert store.read_store(spark, str(tmp_path / "none")) is None


def _hot_children(spark, n=30_000):
    """A third of all rows on one key, half of them equal."""
    rows = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("account_id"),
        F.when(F.col("id") % 6 == 0, 0).otherwise(F.col("id")).alias("line"),
    )
    value = F.struct(F.col("line").alias("line"), F.concat(F.lit("owner "), F.col("line").cast("string")).alias("name"))
    return nesting.nest_children(rows, "account_id", [F.col("line")], value)


def test_pages_of_a_hot_key(spark):
    nested = _hot_children(spark)
    pages = nested.pages(2000)
    sizes = pages.withColumn("bytes", F.length(F.to_json(F.struct("items")))).groupBy("account_id").agg(F.max("bytes"), F.count("*"), F.max("page")).collect()
    assert max(r[1] for r in sizes) < 2300 and all(r[2] == r[3] + 1 for r in sizes)
    assert max(r[2] for r in sizes) > 100
    got = nesting.rows_of(pages, "account_id").filter("account_id = 'hot'").orderBy("position").select("child.line").collect()
    assert [r.line for r in got] == sorted([0] * 5000 + list(range(3, 30_000, 6)))
    assert nesting.rows_of(pages, "account_id").count() == 30_000
    one = nested.pages(1 << 30)
    assert one.groupBy("account_id").count().filter("count > 1").isEmpty()


def test_children_go_through_store_export_and_backup(spark, frame):
    root = scratch_path(spark, "t-children")
    nested = _hot_children(spark, 3000)
    ids = nested.rows.select("account_id").distinct().withColumns({"county": F.lit("harris"), "pos": F.lit(1)})
    store.upsert(spark, root, ids, "b1", "2025-01-01 00:00:00", "pos", children={"owners": nested})
    fewer = nesting.Nested("account_id", nested.rows.filter("account_id <> 'hot' AND item.v.line < 50"))
    store.upsert(spark, root, ids.filter("account_id <> 'hot'"), "b2", "2025-01-02 00:00:00", "pos", children={"owners": fewer})
    want = {r.account_id: r["count"] for r in fewer.rows.groupBy("account_id").count().collect()} | {"hot": 1000}
    for _ in range(2):  # before and after compaction
        got = store.children(spark, root, "owners")
        assert {r.account_id: r["count"] for r in got.groupBy("account_id").count().collect()} == want
        store.compact(spark, root)
    assert store.children(spark, root, "deeds") is None
    pages = store.child_pages(spark, root, "owners")
    sinks.backup(store.read_store(spark, root), f"{root}/backup", "2025-01-03", {"owners": pages})
    back = sinks.exported_children(spark, f"{root}/backup", "owners", pages.schema, "account_id")
    lines = [r.line for r in back.filter("account_id = 'hot'").orderBy("position").select("child.line").collect()]
    assert lines == sorted([0] * 500 + list(range(3, 3000, 6)))


def test_filled_rules(frame):
    df = frame(
        [("h", 0, " ", [], (None, "x")), ("h", 1, "a", [1], (None, None))],
        "county string, n int, t string, arr array<int>, s struct<a:string, b:string>",
    )
    got = {r.field: (r.present, r.non_empty) for r in quality.field_coverage(df, ["n", "t", "arr", "s"]).collect()}
    assert got == {"n": (2, 1), "t": (2, 1), "arr": (2, 1), "s": (2, 1)}


def test_profile_approximate(frame):
    df = frame([(1, "a"), (2, None), (2, "a")], "x int, y string")
    for approximate in (False, True):
        got = {r.column: (r.null_count, r.distinct_count) for r in quality.profile(df, approximate).collect()}
        assert got == {"x": (0, 2), "y": (1, 2)}  # a null counts as a value


def test_repairs_only_change_what_is_missing(frame):
    df = frame(
        [("harris", (None, "f")), ("harris", ("s", "f")), ("travis", (None, "f"))],
        "county string, property_address struct<street_address:string, full_address:string>",
    )
    rows = repair.fill_street_address(df).collect()
    assert [(r.property_address.street_address, r.repaired) for r in rows] == [
        ("f", True), ("s", False), (None, False),
    ]


def test_search(frame):
    df = frame([("1", "Oak Trust"), ("2", None)], "id string, name string")
    assert search.contains_any(df, "  OAK ", [F.col("name")]).count() == 1
    assert search.contains_any(df, " ", [F.col("name")]).count() == 2
    assert search.word_search(df, ["trust", "elm"], [F.col("name")]).first().score == 1
    assert search.in_county(df.withColumn("county", F.lit("x")), "ALL").count() == 2


def _pages(frame, *texts):
    return frame([(1, i + 1, t) for i, t in enumerate(texts)], "plan_id int, page_no int, text string")


def test_specs_rules(frame):
    pages = _pages(
        frame,
        "500 GAL TANK COPPER PIPE 2x10 JOIST, 2x6 BEAM",
        "40 GAL PEX CPVC 2x12 JOIST PVC 3/4 IN PIPE 9 IN PIPE HARDWOOD CARPET",
    )
    got = {r.field: r.value for r in specs.first_match_specs(pages).collect()}
    assert "water_heater_capacity" not in got  # its first match is out of range for the only rule
    assert got["pipe_supply"] == "CPVC" and got["pipe_drain"] == "PVC"
    assert got["joist_size"] == "2x12"
    every = {(r.field, r.value) for r in specs.all_match_specs(pages).collect()}
    assert every == {
        ("beam_size", "2x6"), ("pipe_size", "3/4"), ("flooring_type", "HARDWOOD"),
        ("flooring_type", "CARPET"),
    }
    assert specs.plan_facts(pages).filter("field = 'flooring_type'").count() == 2


def test_specs_prefer_the_roof_pitch_and_space_duct_sizes(frame):
    pages = _pages(frame, "PITCH 4'-12 ROOF PITCH: 6'-12 DUCT 12x8 DUCT")
    first = {r.field: r.value for r in specs.first_match_specs(pages).collect()}
    assert first["roof_pitch"] == "6'-12"
    every = {(r.field, r.value) for r in specs.all_match_specs(pages).collect()}
    assert ("duct_size", "12 x 8") in every


def test_half_bath_needs_marks_for_a_second(frame):
    pages = _pages(frame, "BATH 1 22 BATH 2 33 BATH 3 70 " + "HALF " * 6)
    found = rooms.rooms(pages)
    got = {r.area: r.room_key for r in rooms.resolve_half_baths(found, pages).collect()}
    assert got == {22: "half_bath", 33: "half_bath", 70: "bathroom"}
    few = _pages(frame, "BATH 1 22 BATH 2 33")
    got = {r.area: r.room_key for r in rooms.resolve_half_baths(rooms.rooms(few), few).collect()}
    assert got == {22: "half_bath", 33: "bathroom"}


def test_rooms_skip_floor_areas(frame):
    pages = _pages(frame, "FIRST FLOOR LIVING 598 KITCHEN 598 GREAT ROOM 300 LIVING ROOM 250 ")
    got = {r.area: r.name for r in rooms.rooms(pages).collect()}
    assert got == {598: "KITCHEN", 300: "GREAT ROOM", 250: "LIVING ROOM"} or got == {
        300: "GREAT ROOM", 250: "LIVING ROOM",
    }


def test_checks_of_rooms_and_ceilings(frame):
    facts = frame([(1, 2000, 10, 10, 20, 5)], "plan_id int, total_sqft int, doors int, windows int, outlets int, plumbing_fixtures int")
    room_rows = frame([(1, 100), (1, 900)], "plan_id int, area int")
    heights = frame([(1, 9.0)], "plan_id int, height_ft double")
    checks = validate.check_results(facts, room_rows, heights)
    scores = validate.plan_scores(checks, validate.structural_issues(facts)).first()
    assert (scores.total_checks, scores.passed_checks, scores.failed_checks) == (8, 7, 1)
    assert scores.critical_count == 1  # no rooms in the facts


def test_dimensions_closer_than_a_tenth_of_a_foot_are_one(spark):
    text = "12'-0\" x 14'-0\" and 12'-1\" x 14'-0\" and 12'-3\" x 14'-0\""
    pages = spark.createDataFrame([(1, 1, text), (2, 1, "none"), (3, 1, None)], "plan_id int, page_no int, text string")
    got = measures.dimensions(pages).collect()
    assert sorted((r["plan_id"], r["area_sqft"]) for r in got) == [(1, 168.0), (1, 171.5)]


def test_places_follow_the_files_over_many_splits(spark):
    path = scratch_path(spark, "t-places")
    rows = spark.range(4000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("n"))
    rows.orderBy("n").repartitionByRange(3, "n").sortWithinPartitions("n").write.option("header", True).csv(path)
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        read = delimited.read_strings(spark, path, ["k", "n"], position="source_pos")
        assert read.rdd.getNumPartitions() > 6
        first = {r.k: int(r.n) for r in keyed.first_per_key(read, ["k"], "source_pos").collect()}
        last = {r.k: int(r.n) for r in keyed.last_per_key(read, ["k"], "source_pos").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    assert first == {str(k): k for k in range(7)}
    assert last == {str(n % 7): n for n in range(3993, 4000)}


def test_county_files_as_read_give_records(spark, tmp_path):
    (tmp_path / "accounts.csv").write_text("account_num,owner_name1\n1,A\n  ,NOBODY\n")
    (tmp_path / "values.csv").write_text("account_num,land_val,tot_val\n1,5,9\n1,6,10\n,1,1\n")
    read = lambda name, columns: delimited.read_strings(
        spark, str(tmp_path / name), columns, position="source_pos"
    )
    files = dallas.DallasFiles(
        accounts=read("accounts.csv", ["account_num", "owner_name1"]),
        appraisal=read("values.csv", ["account_num", "land_val", "tot_val"]),
    )
    records = dallas.unified_records(files).select("account_id", "valuation.market_value").collect()
    assert [(r.account_id, int(r.market_value)) for r in records] == [("1".zfill(17), 9)]


def test_rows_without_an_id_are_rejects(frame):
    rows = frame([("1",), (None,), (" ",), ("n/a",), ("0",)], "acct string")
    usable, rejects = keyed.split_by_id(rows, "acct")
    assert sorted(r.acct for r in usable.collect()) == ["0", "1"]
    assert rejects.count() == 3


def test_date_forms(frame):
    rows = frame([("2024-03-05",), ("2024/03/05",), ("05/03/2024",), ("x",), ("",)], "d string")
    got = [r.d and str(r.d) for r in delimited.apply_types(rows, {"d": "date"}).collect()]
    assert got == ["2024-03-05"] * 3 + [None, None]
    us = delimited.apply_types(rows.filter("d like '05%'"), {"d": "date"}, ("MM/dd/yyyy",))
    assert str(us.first().d) == "2024-05-03"


SEARCHED = [("1", "10 Main St #12", "ACME Trust"), ("2", "aaaa", None), ("3", None, None), ("4", "", "É b#1 aaa"),
            ("5", "mainmain main", "trust trust"), ("6", "#1", "2#12"), ("7", "ab", "a"), ("8", "x" * 500 + "#12", "")]


@pytest.mark.parametrize("term", [" #12 ", "main", "aaa", "aaaa", "aaaaa", "MAINMAIN M", "é b", "a", "#1", "zzz", "trust t", "x" * 60, ""])
def test_text_index_finds_what_a_scan_finds(spark, frame, term):
    df = frame(SEARCHED, "id string, address string, owner string")
    path = scratch_path(spark, "t-text")
    columns = [F.col("address"), F.col("owner")]
    search_index.build_text_index(df, "id", columns, path)
    got = search_index.matching(df, "id", search_index.containing(spark, path, term))
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in search.contains_any(df, term, columns).collect())


def test_word_index_reads_the_parts_of_its_terms(spark, frame):
    df = frame(SEARCHED, "id string, address string, owner string")
    path = scratch_path(spark, "t-words")
    columns = [F.col("address"), F.col("owner")]
    search_index.build_word_index(df, "id", columns, path)
    for terms in (["TRUST", "main"], ["10"], ["nowhere"], ["trust", "Trust", ""]):
        got = search_index.word_search(spark, path, terms)
        want = search.word_search(df, [t for t in terms if t], columns)
        assert sorted(map(tuple, got.collect())) == sorted((r.id, r.score) for r in want.collect())
    plan = search_index.word_search(spark, path, ["trust"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan
    assert search_index.word_search(spark, path, ["trust"]).inputFiles().__len__() >= 1


def test_plans_of_one_task_are_dealt_out_before_they_become_rows(spark):
    from parcelmill.takeoff import quantities

    plans = spark.range(0, 5000, 1, 1).select(F.col("id").alias("plan_id"), F.lit(1500).alias("total_sqft"))
    items = quantities.quantities(plans)
    held = items.groupBy(F.spark_partition_id()).agg(F.countDistinct("plan_id").alias("n"))
    assert held.agg(F.max("n"), F.sum("n")).first()[0] <= 100
    assert items.count() == 5000 * len(quantities.items())
    # sums per plan are made where the rows are
    summed = items.groupBy("plan_id", "category").agg(F.sum("qty"))
    assert summed._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_a_count_of_children_makes_no_array(spark, frame):
    rows = frame([("a", 2, "y"), ("a", 1, "x"), ("a", 1, "x"), ("b", 1, None), (None, 1, "z")], "k string, p int, t string")
    nested = nesting.nest_children(rows, "k", [F.col("p")], F.struct("t"))
    whole = {r["k"]: ([i["t"] for i in r["items"]], r["n"]) for r in nested.arrays.collect()}
    assert whole == {"a": (["x", "x", "y"], 3), "b": ([None], 1), None: (["z"], 1)}
    counted = nested.arrays.select("k", "n")
    assert "collect_list" not in counted._jdf.queryExecution().optimizedPlan().toString()
    assert {(r["k"], r["n"]) for r in counted.collect()} == {("a", 3), ("b", 1), (None, 1)}


def test_lines_of_few_row_groups_are_built_once_by_many_tasks(spark, sf_dir):
    from parcelmill.catalog.registry import Inputs
    from parcelmill.sources.fixed_width import line_status

    src = Inputs(spark, sf_dir)
    lines = src.view("fx_travis_prop")
    usable = lines.filter(line_status(PROP) == "ok")
    plan = usable._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("rpad(") == lines._jdf.queryExecution().optimizedPlan().toString().count("rpad(")
    assert plan.index("Filter") < plan.index("rpad(") < plan.index("RepartitionByExpression")
    assert lines.count() == src.table("customer").count()
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_a_line_is_measured_once_and_cut_by_bytes(spark, frame):
    from parcelmill.sources.fixed_width import _typed, cut_field

    text = "".join(f"{i:>4} " for i in range(1, 720))
    texts = [text, text.replace("61", "\u00e961").replace(" 7", "\U0001f3e1\t"), text[:1849], "0" * 3600, "", None, "1" * 99]
    lines = frame([(t, i) for i, t in enumerate(texts)], "value string, source_pos int")
    fields = project_fields(lines, PROP, keep=["source_pos"], usable_only=False)
    assert fields._jdf.queryExecution().optimizedPlan().toString().count("length(value") <= 3  # before, one for each field
    zero = lambda c: F.ltrim(c, F.lit("0")) == ""
    cut = lambda f: F.when(~zero(cut_field(F.col("value"), f)), cut_field(F.col("value"), f))
    typed = lambda f: F.when(cut(f).isNotNull(), _typed(cut(f), f)) if f.kind != "text" else cut(f)
    want = lines.select("source_pos", *[typed(f).alias(f.name) for f in PROP.fields])
    assert sorted(map(tuple, fields.collect())) == sorted(map(tuple, want.collect()))


def test_facts_of_stored_records_are_read_narrow(spark, frame):
    root = scratch_path(spark, "t-facts")
    schema = "account_id string, county string, year int, pos long"
    store.upsert(spark, root, frame([("1", "harris", 1, 1), ("2", "harris", 0, 1), (None, None, 3, 1)], schema), "a", "2025-01-01 00:00:00", "pos", buckets=2)
    store.upsert(spark, root, frame([("2", "travis", 2, 1), ("3", "harris", None, 1), (None, "dallas", 4, 1)], schema), "b", "2025-01-02 00:00:00", "pos")
    store.upsert(spark, root, frame([("4", "harris", 5, 1)], schema), "c", "2025-01-03 00:00:00", "pos", reload_county="harris")

    def known():
        current = store._current(spark, root)
        want = ledger.facts(store.read_store(spark, root))
        got = store._known_facts(spark, root, current, store._schema(current[-1]), want.schema)
        assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
        assert {r.account_id: r.county for r in got.collect()} == {"2": "travis", "4": "harris", None: "dallas"}
        return got._jdf.queryExecution().optimizedPlan().toString()

    assert "spark_catalog" not in known()  # no record is read
    store.compact(spark, root)
    assert "spark_catalog" in known()  # merged batches have no facts of their own


def test_ids_and_counts_of_all_records_are_not_sent_through_the_driver(spark, frame):
    # Spark guesses these sides to be small, as they are a few columns of wide or compressed files
    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    known = frame([("1", "harris"), ("2", "harris"), ("3", "travis"), (None, "dallas")], "account_id string, county string")
    written = frame([("2", "harris"), ("3", "travis"), ("9", "dallas"), (None, "dallas")], "account_id string, county string")
    gone = store._gone(known, written, None)
    assert "BroadcastHashJoin" not in plan(gone) and "SortMergeJoin" in plan(gone)
    assert sorted(map(tuple, gone.collect())) == [("2", "harris"), ("3", "travis")]
    ended = store._gone(known, written, "harris").collect()
    assert sorted(map(tuple, ended)) == [("1", "harris"), ("2", "harris"), ("3", "travis")]

    children = nesting.nest_children(frame([("2", 1), ("2", 2), (None, 3)], "account_id string, n int"), "account_id", [F.col("n")], F.struct("n"))
    for arrays in (True, False):
        joined = nesting.attach(known, children, "kids", arrays)
        assert "BroadcastHashJoin" not in plan(joined)
        assert {r["account_id"]: r["kids_count"] for r in joined.collect()} == {"1": 0, "2": 2, "3": 0, None: 0}

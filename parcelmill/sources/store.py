"""The property store: a bucketed Spark table of record batches, upserted by account id, with a coverage ledger.

Layout: `data/batch=B/` (one table, in buckets by `account_id`), `children/F/batch=B/` (pages of the child family F, see
`operators.nesting`; a record names the batch that its children came with), `ledger/batch=B/` and `gaps/batch=B/` (what the batch
changes in the counts, see `operators.ledger`), `staging/` with the batches as they came and the facts
of their records, and a small `commits` table.
A batch counts once its commit row is written, and its name is never used again, so what a failed write left behind is
never read. One writer at a time is assumed; superseded folders are not removed.

All batches are partitions of one table, so a read is one scan however many there are, and the buckets of a batch lie
with those of every other: taking the latest record of each account, and meeting a new batch with the stored ones,
needs no exchange of what is stored. A patch is a batch of ids and changed fields only, laid over the record on read.
After `compact_after` batches they are merged: the late ones among themselves while they are few against the rest
(`MERGE_SHARE`), else all.
"""

import hashlib
import json
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from parcelmill.operators import ledger
from parcelmill.operators.keyed import last_per_key
from parcelmill.operators.nesting import PAGE_BYTES, Nested, rows_of
from parcelmill.sources.runlog import log_event

COMMIT_DDL = (
    "version int, batch_id string, batch string, supersedes int, reload_county string, patched array<string>, "
    "buckets int, records bigint, schema string, "
    "total_count bigint, inserted_count bigint, replaced_count bigint, duplicate_count bigint"
)
VERSION_TAG = "1.0"
INGESTION_TYPE = "normalized_bulk"
COMPACT_AFTER, MERGE_SHARE = 16, 0.25
#: Of the store itself: whether a row is a patch, and the batch that brought the record's children.
OWN_FIELDS = [StructField("_patch", BooleanType()), StructField("_children", StringType())]


def with_run_metadata(
    df: DataFrame, batch_id: str, run_time: str, source_files: list[str] | None = None
) -> DataFrame:
    """Batch id, times, files, version and ingestion type on each record."""
    time = F.lit(run_time).cast("timestamp")
    files = F.array(*[F.lit(f) for f in source_files or []]).cast("array<string>")
    values = {
        "batch_id": F.lit(batch_id),
        "created_at": time,
        "updated_at": time,
        "source_files": files,
        "version": F.lit(VERSION_TAG),
        "ingestion_type": F.lit(INGESTION_TYPE),
    }
    if "metadata" not in df.columns:
        return df.withColumn("metadata", F.struct(*[c.alias(n) for n, c in values.items()]))
    # a record without metadata still gets the run's fields
    kind = df.schema["metadata"].dataType
    fields = [
        (values[f.name] if f.name in values else F.col("metadata").getField(f.name))
        .cast(f.dataType)
        .alias(f.name)
        for f in kind
    ]
    return df.withColumn("metadata", F.struct(*fields))


def commits(spark: SparkSession, root: str) -> DataFrame:
    """The commit rows; none where nothing has been written. Any other fault of the log is an error."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/commits")
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], COMMIT_DDL)
    return spark.read.schema(COMMIT_DDL).parquet(f"{root}/commits")


def _current(spark: SparkSession, root: str) -> list[dict]:
    """Commit rows that count, in order: at most `compact_after` and the merged ones before them."""
    made = commits(spark, root)
    last = made.agg(F.coalesce(F.max(F.when(F.col("supersedes") == 0, F.col("version"))), F.lit(0))).first()[0]
    kept: list[dict] = []
    for row in made.filter(F.col("version") >= last).drop("schema").orderBy("version").collect():
        if row["supersedes"] is not None:
            kept = [r for r in kept if r["version"] < row["supersedes"]]
        kept.append(row.asDict())
    if kept:  # the schema of the latest batch is the store's
        kept[-1]["schema"] = made.filter(F.col("version") == kept[-1]["version"]).select("schema").first()[0]
    return kept


def _schema(row) -> StructType:
    return StructType.fromJson(json.loads(row["schema"]))


def _declared(spark: SparkSession, root: str, schema: StructType, buckets: int, batches: list[str]) -> str:
    """Name of the bucketed table over `data`, declared in the catalog with the given batches."""
    fields = [*schema, *[f for f in OWN_FIELDS if f.name not in schema.names]]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    name = "store_" + hashlib.md5(f"{root}|{ddl}|{buckets}".encode()).hexdigest()
    location = f"{root}/data".replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({ddl}, batch string) USING parquet PARTITIONED BY (batch) "
        f"CLUSTERED BY (account_id) INTO {buckets} BUCKETS LOCATION '{location}'"
    )
    if batches:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (batch = '{b}')" for b in batches))
        spark.catalog.refreshTable(name)
    return name


def _batches(spark: SparkSession, root: str, schema: StructType, buckets: int, batches: list[str]) -> DataFrame:
    return spark.table(_declared(spark, root, schema, buckets, batches)).filter(F.col("batch").isin(batches))


def read_store(spark: SparkSession, root: str, columns: list[str] | None = None) -> DataFrame | None:
    """The current records (`columns`: only these, besides the key), or None while there is no batch."""
    return _snapshot(spark, root, _current(spark, root), columns)


def child_pages(spark: SparkSession, root: str, family: str) -> DataFrame | None:
    """Pages (account_id, page, items) of the current records' children, or None where the store has none."""
    current = _current(spark, root)
    top = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/children/{family}")
    if not current or not top.getFileSystem(spark._jsc.hadoopConfiguration()).exists(top):
        return None
    pages = spark.read.parquet(f"{root}/children/{family}")
    owners = _snapshot(spark, root, current, ["_children"]).filter(F.col("_children").isNotNull())
    owners = owners.select("account_id", F.col("_children").alias("batch"))
    # an account may have a large share of the pages: both sides are dealt out, so that such a join can be split
    return pages.join(owners, ["account_id", "batch"]).select("account_id", "page", "items")


def children(spark: SparkSession, root: str, family: str) -> DataFrame | None:
    """The children of the current records as rows: account_id, position, child."""
    pages = child_pages(spark, root, family)
    return None if pages is None else rows_of(pages, "account_id")


def _laid_over(c: Column, path: str, value: Column) -> Column:
    """The column `c` with the field below it that `path` names set to `value`."""
    _, _, inner = path.partition(".")
    return c.withField(inner, value) if inner else value


def _snapshot(spark, root, current: list, columns: list[str] | None = None) -> DataFrame | None:
    if not current:
        return None
    schema = _schema(current[-1])
    names = [f.name for f in schema if columns is None or f.name in {*columns, "account_id"}]
    names += [c for c in columns or [] if c == "_children"]
    batches = [r["batch"] for r in current]
    rows = _batches(spark, root, schema, current[-1]["buckets"], batches)
    patched = {p for r in current for p in r["patched"] or [] if p.partition(".")[0] in names}
    if len(current) == 1:
        return rows.select(*names)
    rows = _without_ended(rows, current)
    same = Window.partitionBy("account_id")
    whole = ~F.col("_patch")
    rows = rows.select(*dict.fromkeys([*names, "batch", "_patch"]))
    if patched:
        base = F.max(F.when(whole, F.col("batch"))).over(same)
        latest = {}
        for path in patched:
            value = F.struct("batch", F.col(path).alias("value"))
            latest[path] = F.max(F.when(~whole & F.col(path).isNotNull(), value)).over(same)
        rows = rows.withColumns({"_base": base} | {f"_to {p}": c for p, c in latest.items()})
        for path in patched:
            to, section = F.col(f"`_to {path}`"), path.partition(".")[0]
            changed = _laid_over(F.col(section), path, to["value"])
            rows = rows.withColumn(section, F.when(to["batch"] > F.col("_base"), changed).otherwise(F.col(section)))
    if "metadata" in names:
        seen = F.min(F.when(whole, F.col("metadata.created_at"))).over(same)
        rows = rows.withColumn("metadata", F.col("metadata").withField("created_at", seen))
    # whole records come before patches, the latest first
    rank = F.row_number().over(same.orderBy("_patch", F.desc("batch")))
    return rows.withColumn("_rank", rank).filter((F.col("_rank") == 1) & whole).select(*names)


def upsert(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    batch_id: str,
    run_time: str,
    position: str,
    source_files: list[str] | None = None,
    reload_county: str | None = None,
    buckets: int | None = None,
    children: dict[str, Nested] | None = None,
    compact_after: int = COMPACT_AFTER,
) -> dict[str, int | str]:
    """Replace or insert whole records by `account_id`; the row with the highest `position` wins.

    Returns the counts of the run. A batch id that is already committed is not applied again. The
    first `created_at` of a record is kept. `reload_county` drops the county's other records.
    `buckets` counts for a new store alone (the session's shuffle partitions, if not given). `children` are
    the child families of the batch's records, keyed by `account_id`; they replace those that the records had.
    """
    done = commits(spark, root).filter(F.col("batch_id") == batch_id).limit(1).collect()
    if done:
        return _result(batch_id, done[0])
    total = 0
    try:
        # the batch is built once; counting and deduplication read the staged copy
        staged_path = f"{root}/staging/{batch_id}"
        batch.write.mode("overwrite").parquet(staged_path)
        staged = spark.read.schema(batch.schema).parquet(staged_path)
        total = staged.count()
        log_event(spark, root, batch_id, "started", run_time, total, source_files=source_files)
        latest = last_per_key(staged, ["account_id"], position).drop(position)
        fresh = with_run_metadata(latest, batch_id, run_time, source_files)
        if reload_county is not None and any(r["patched"] for r in _current(spark, root)):
            compact(spark, root)  # a patch may have given a record its county
        counts = _append(spark, root, fresh, batch_id, total, reload_county, buckets, children or {})
    except Exception as error:
        log_event(spark, root, batch_id, "failed", run_time, total, 0, str(error))
        raise
    log_event(spark, root, batch_id, "completed", run_time, total, counts["saved_count"])
    _merge(spark, root, compact_after)
    return counts


def _append(spark, root, fresh, batch_id, total, reload_county, buckets, children) -> dict[str, int | str]:
    """Write a batch of one record per account, its children, and what it changes in the counts, and commit it."""
    current = _current(spark, root)
    buckets = current[-1]["buckets"] if current else buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name, version = _new_batch(spark, root)
    _write(spark, root, fresh.schema, buckets, name, fresh, children=F.lit(name if children else None))
    for family, nested in children.items():
        nested.pages(PAGE_BYTES).write.parquet(f"{root}/children/{family}/batch={name}")
    written = _batches(spark, root, fresh.schema, buckets, [name]).select(*fresh.columns)
    added = ledger.facts(written)
    known = _known_facts(spark, root, current, fresh.schema, added.schema)
    gone = None
    if known is not None:
        gone = _gone(known, written, reload_county)
    facts = _write_counts(spark, root, name, ledger.signed(added, gone))
    # what a reload ends is not replaced
    kept = F.lit(True) if reload_county is None else ~F.col("county").eqNullSafe(reload_county)
    saved, replaced = facts.agg(F.count_if(F.col("sign") > 0), F.count_if((F.col("sign") < 0) & kept)).first()
    counts = (total, saved - replaced, replaced, total - saved)
    return _commit(spark, root, version, name, batch_id, fresh.schema, buckets, saved, counts, reload_county=reload_county)


def _gone(known: DataFrame, written: DataFrame, reload_county: str | None) -> DataFrame:
    """Facts of the records that a batch replaces or its reload ends.

    Ids are a small part of wide records, so Spark would take those of any batch for small and send them all through the
    driver to every task. Both sides are in order of the key instead; only the narrow facts are exchanged.
    """
    again = written.select("account_id", F.lit(True).alias("_again")).hint("merge")
    marked = known.join(again, "account_id", "left")
    ends = F.lit(False) if reload_county is None else F.col("county").eqNullSafe(reload_county)
    return marked.filter(F.col("_again").isNotNull() | ends).drop("_again")


def _known_facts(spark, root, current: list, schema: StructType, like: StructType) -> DataFrame | None:
    """Facts (of the schema `like`) of the current records (of `schema`), or None while there is none.

    A batch has staged those of the records it brought, which are few narrow columns. Its records are read only where
    that copy is not there, as with merged batches, or is of another schema; all are read where some are patched.
    """
    if not current:
        return None
    if any(r["patched"] for r in current):
        return ledger.facts(_snapshot(spark, root, current))
    hadoop = spark._jvm.org.apache.hadoop.fs
    system = hadoop.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    batches, buckets = [r["batch"] for r in current], current[-1]["buckets"]
    alike = commits(spark, root).filter(F.col("batch").isin(batches) & (F.col("schema") == schema.json())).select("batch")
    alike = {r["batch"] for r in alike.collect()}
    parts = []
    for batch in batches:
        path = f"{root}/staging/facts-{batch}"
        if batch in alike and system.exists(hadoop.Path(f"{path}/_SUCCESS")):
            signed = StructType([*like, StructField("sign", LongType())])
            one = spark.read.schema(signed).parquet(path).filter("sign > 0").drop("sign")
        else:
            one = ledger.facts(_batches(spark, root, schema, buckets, [batch]))
        parts.append(one.withColumn("batch", F.lit(batch)))
    rows = _without_ended(reduce(DataFrame.unionByName, parts), current)
    return last_per_key(rows, ["account_id"], "batch").drop("batch")


def _without_ended(rows: DataFrame, current: list) -> DataFrame:
    """A reload ends the county's earlier records."""
    for county, batch in [(r["reload_county"], r["batch"]) for r in current if r["reload_county"]]:
        rows = rows.filter(~(F.col("county").eqNullSafe(county) & (F.col("batch") < batch)))
    return rows


def patch(spark: SparkSession, root: str, changes: DataFrame, paths: list[str], batch_id: str, run_time: str) -> dict[str, int | str]:
    """Set fields of stored records: `changes` has `account_id`, `county` and a column for each path, null where it stays.

    Only ids and changed fields are written. Ids that the store does not have are left out; a batch id that is
    already committed is not applied again. Returns the counts: `replaced_count` records are repaired.
    """
    done = commits(spark, root).filter(F.col("batch_id") == batch_id).limit(1).collect()
    if done:
        return _result(batch_id, done[0])
    current = _current(spark, root)
    if not current:
        raise ValueError("there is no record to patch")
    schema, buckets = _schema(current[-1]), current[-1]["buckets"]
    name, version = _new_batch(spark, root)
    log_event(spark, root, batch_id, "started", run_time, 0)
    have = _snapshot(spark, root, current, ["account_id"])
    given = changes.filter(F.coalesce(*[F.col(f"`{p}`").cast("string") for p in paths]).isNotNull()).dropDuplicates(["account_id"]).join(have, "account_id", "left_semi")
    columns = []
    for field in schema:
        below = [p for p in paths if p.partition(".")[0] == field.name]
        if field.name in ("account_id", "county"):
            c = F.col(field.name)
        elif not below:
            c = F.lit(None).cast(field.dataType)
        elif below == [field.name]:
            c = F.col(field.name).cast(field.dataType)
        else:
            inner = {p.partition(".")[2]: p for p in below}
            parts = [(F.col(f"`{inner[f.name]}`") if f.name in inner else F.lit(None)).cast(f.dataType).alias(f.name) for f in field.dataType]
            c = F.struct(*parts)
        columns.append(c.alias(field.name))
    _write(spark, root, schema, buckets, name, given.select(*columns), is_patch=True)
    following = {"batch": name, "patched": paths, "reload_county": None, "buckets": buckets, "schema": schema.json()}
    ids = _batches(spark, root, schema, buckets, [name]).select("account_id")
    after = _snapshot(spark, root, [*current, following]).join(ids, "account_id", "left_semi")
    before = _snapshot(spark, root, current).join(ids, "account_id", "left_semi")
    _write_counts(spark, root, name, ledger.signed(ledger.facts(after), ledger.facts(before)))
    saved = ids.count()
    counts = _commit(spark, root, version, name, batch_id, schema, buckets, saved, (saved, 0, saved, 0), patched=paths)
    log_event(spark, root, batch_id, "completed", run_time, saved, saved)
    return counts


def repair(
    spark: SparkSession, root: str, rule: Callable[[DataFrame], DataFrame], path: str, batch_id: str, run_time: str
) -> dict[str, int | str]:
    """Apply one of the rules of `operators.repair` to the stored records as a patch of the field `path`."""
    section = path.partition(".")[0]
    have = read_store(spark, root, ["county", section])
    if have is None:
        raise ValueError("there is no record to repair")
    fixed = rule(have).filter("repaired")
    changes = fixed.select("account_id", *({"county"} - {path}), F.col(path).alias(path))
    return patch(spark, root, changes, [path], batch_id, run_time)


def _new_batch(spark, root) -> tuple[str, int]:
    """A batch name that sorts after all others and is never used again, and its version."""
    version = commits(spark, root).agg(F.coalesce(F.max("version"), F.lit(0)) + 1).first()[0]
    return f"{version:010d}-{uuid.uuid4().hex}", version


def _write(spark, root, schema, buckets, name, records, is_patch=False, children=None) -> None:
    own = F.lit(None) if children is None else children
    rows = records.select(*schema.names, F.lit(is_patch), own.cast("string"), F.lit(name))
    rows.repartition(buckets, "account_id").write.insertInto(_declared(spark, root, schema, buckets, []))


def _write_counts(spark, root: str, name: str, facts: DataFrame) -> DataFrame:
    """Ledger and gaps of a batch from its signed facts, which are built once and staged."""
    path = f"{root}/staging/facts-{name}"
    facts.write.parquet(path)
    staged = spark.read.schema(facts.schema).parquet(path)
    ledger.entries(staged).repartition(1).write.parquet(f"{root}/ledger/batch={name}")
    ledger.gaps(staged).write.parquet(f"{root}/gaps/batch={name}")
    return staged


def coverage_ledger(spark: SparkSession, root: str) -> DataFrame:
    """Ledger rows of the batches that count; no record is read."""
    return _counts(spark, root, "ledger", ledger.LEDGER_DDL, _current(spark, root))


def coverage_gaps(spark: SparkSession, root: str) -> DataFrame:
    return _counts(spark, root, "gaps", ledger.GAPS_DDL, _current(spark, root))


def _counts(spark, root, what, ddl, current) -> DataFrame:
    paths = [f"{root}/{what}/batch={r['batch']}" for r in current]
    return spark.read.schema(ddl).parquet(*paths) if paths else spark.createDataFrame([], ddl)


def compact(spark: SparkSession, root: str) -> None:
    """The current records in one batch; readers start from it, replays are still recognised."""
    current = _current(spark, root)
    if len(current) > 1:
        _merged(spark, root, current, 0)


def _merge(spark, root, compact_after: int) -> None:
    """Merge batches once more than `compact_after` count: the late ones alone while they hold a small share."""
    current = _current(spark, root)
    if len(current) <= compact_after:
        return
    first, late = current[0], current[1:]
    simple = not any(r["patched"] or r["reload_county"] for r in late)
    if simple and sum(r["records"] for r in late) < MERGE_SHARE * first["records"]:
        _merged(spark, root, late, late[0]["version"])
    else:
        _merged(spark, root, current, 0)


def _merged(spark, root, rows: list, supersedes: int) -> None:
    schema, buckets = _schema(rows[-1]), rows[-1]["buckets"]
    name, version = _new_batch(spark, root)
    records = _snapshot(spark, root, rows, [*schema.names, "_children"])
    _write(spark, root, schema, buckets, name, records, children=F.col("_children"))
    ledger.summed(_counts(spark, root, "ledger", ledger.LEDGER_DDL, rows)).select(*[c.split()[0] for c in ledger.LEDGER_DDL.split(", ")]).coalesce(1).write.parquet(f"{root}/ledger/batch={name}")
    open_gaps = _counts(spark, root, "gaps", ledger.GAPS_DDL, rows).groupBy("county", "account_id", "missing").agg(F.sum("change").alias("change"))
    open_gaps.filter("change <> 0").write.parquet(f"{root}/gaps/batch={name}")
    saved = _batches(spark, root, schema, buckets, [name]).count()
    _commit(spark, root, version, name, f"compact-{name}", schema, buckets, saved, (0, 0, 0, 0), supersedes=supersedes)


def _commit(spark, root, version, name, batch_id, schema, buckets, records, counts, supersedes=None, reload_county=None, patched=None):
    """One commit row: from now on the batch counts."""
    row = (version, batch_id, name, supersedes, reload_county, patched, buckets, records, schema.json(), *counts)
    frame = spark.createDataFrame([row], COMMIT_DDL)
    frame.coalesce(1).write.mode("append").parquet(f"{root}/commits")
    return _result(batch_id, frame.first())


def _result(batch_id, row) -> dict[str, int | str]:
    return {
        "batch_id": batch_id,
        "total_count": row["total_count"],
        "saved_count": row["total_count"],
        "inserted_count": row["inserted_count"],
        "replaced_count": row["replaced_count"],
        "duplicate_count": row["duplicate_count"],
    }


def store_statistics(store: DataFrame, log: DataFrame) -> DataFrame:
    """Record and run counts, the latest batch and the field list."""
    from parcelmill.sources.runlog import current_runs, latest_run

    runs = current_runs(log)
    return store.agg(F.count(F.lit(1)).alias("properties_count")).select(
        "properties_count",
        runs.agg(F.count(F.lit(1))).scalar().alias("logs_count"),
        latest_run(log).select("batch_id").scalar().alias("latest_batch"),
        latest_run(log).select("status").scalar().alias("latest_status"),
        F.lit(",".join(store.columns)).alias("fields"),
    )

"""SimHash near-duplicates by pigeonring filtering.

A fingerprint of 64 bits is a ring of eight bytes. If two differ in at most three bits, then from some
byte on, every chain of l consecutive bytes differs in at most floor(3 l / 8) bits: none in the first two,
one in the first three to five. So some two consecutive bytes are equal, and of the next three at least two:
24 exact keys of 32 bits find every pair. Inside a key, pairs must keep the whole chain's budgets before
their full distance counts.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm import near_copies
from parcelmill.llm.common import utf8, written

SHINGLE, DISTANCE, SEGMENTS = 3, 3, 8
#: Budget of each chain length from the start of the chain on.
BUDGETS = [DISTANCE * l // SEGMENTS for l in range(1, SEGMENTS + 1)]
#: (chain start, bytes of the ring that must be equal): the first two, and all but one of the next three.
KEYS = [(i, (i, (i + 1) % 8, *[(i + k) % 8 for k in (2, 3, 4) if k != out])) for i in range(SEGMENTS) for out in (2, 3, 4)]
#: Fingerprints of a key that meet in one task; more are dealt as pairs of blocks of this size.
BLOCK = 2048


def fingerprint(text: str | None) -> int:
    """The bits set in over half of the shingles' hashes, as a signed 64-bit number."""
    words = utf8(text).lower().split()
    if not words:
        return 0
    last = max(1, len(words) - SHINGLE + 1)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(words[i : i + SHINGLE]), 42) for i in range(last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, last, 65536):  # bounds the memory of very long texts
        ones += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > last).view(">i8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for part in texts:
        yield pd.Series([fingerprint(t) for t in part], dtype="int64")


def fingerprints(text: str):
    return pandas_udf(_fingerprints, "long").asNondeterministic()(text)


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch.column(0).to_numpy(zero_copy_only=False)
        parts = fps.astype(">i8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        for k, (_, held) in enumerate(KEYS):
            key = np.full(len(fps), k, np.int64)
            for p in held:
                key = key * 256 + parts[:, p]
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(fps)], ["key", "fp"])


def near_pairs(a: np.ndarray, b: np.ndarray, start) -> np.ndarray:
    """Of pairs (a[k], b[k]) the places whose chain of bytes from `start` on keeps every budget."""
    diff = (a ^ b).view(np.uint64)
    place, total = np.arange(len(diff)), np.zeros(len(diff), np.int64)
    start = np.broadcast_to(start, diff.shape)
    for length, budget in enumerate(BUDGETS):
        shift = (8 * (7 - (start[place] + length) % SEGMENTS)).astype(np.uint64)
        total = total + np.bitwise_count((diff[place] >> shift) & np.uint64(255))
        ok = total <= budget
        place, total = place[ok], total[ok]
    return place


class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def links_within(fps: np.ndarray, start: int, rows: int = 128) -> list[tuple[int, int]]:
    """Links that connect what is near in a group: each fingerprint with the smallest of its class."""
    fps = np.unique(fps)
    forest = _Forest(len(fps))
    for at in range(0, len(fps), rows):
        some = fps[at : at + rows]
        place = near_pairs(np.repeat(some, len(fps)), np.tile(fps, len(some)), start)
        for i, j in zip((at + place // len(fps)).tolist(), (place % len(fps)).tolist(), strict=True):
            forest.join(i, j)
    return [(int(fps[x]), int(fps[r])) for x in range(len(fps)) if (r := forest.root(x)) != x]


def _starts(keys: np.ndarray) -> np.ndarray:
    return np.array([start for start, _ in KEYS], np.int64)[keys >> 32]


def _link_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (key, low, high, fp): runs of equal key, low and high are groups."""
    rest = np.empty((4, 0), np.int64)
    for batch in batches:
        rows = np.concatenate([rest, np.array([c.to_numpy(zero_copy_only=False) for c in batch.columns], np.int64)], axis=1)
        borders = np.flatnonzero((rows[:3, 1:] != rows[:3, :-1]).any(axis=0)) + 1
        whole = int(borders[-1]) if len(borders) else 0
        rest = rows[:, whole:]
        yield _links_of(rows[:, :whole], borders[:-1])
    borders = np.flatnonzero((rest[:3, 1:] != rest[:3, :-1]).any(axis=0)) + 1
    yield _links_of(rest, borders)


def _links_of(rows: np.ndarray, borders: np.ndarray) -> pa.RecordBatch:
    out: list[tuple[int, int]] = []
    if rows.shape[1]:
        key, fp = rows[0], rows[3]
        begins = np.concatenate([[0], borders]).astype(np.int64)
        sizes = np.diff(np.concatenate([begins, [rows.shape[1]]]))
        pairs = begins[sizes == 2]
        near = pairs[near_pairs(fp[pairs], fp[pairs + 1], _starts(key[pairs]))]
        out += zip(np.maximum(fp[near], fp[near + 1]).tolist(), np.minimum(fp[near], fp[near + 1]).tolist(), strict=True)
        for begin, size in zip(begins[sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            out += links_within(fp[begin : begin + size], int(_starts(key[begin : begin + 1])[0]))
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in (0, 1)], ["a", "b"])


def links(fps: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links `a, b` (a > b) between distinct fingerprints (`fp`) that connect all that are near.

    Keys held by one fingerprint alone fall away after a count. A key that many share is dealt as pairs of
    blocks, so that no task holds more than two blocks of it; each task returns fewer links than it has rows.
    """
    keyed = written(fps.select("fp").mapInArrow(_keys, "key long, fp long"), "simhash-keys")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    dealt = (
        keyed.join(shared, "key")
        .select("key", "fp", blocks.alias("blocks"))
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").cast("long").alias("low"), F.greatest("own", "other").cast("long").alias("high"), "fp")
    )
    group = ["key", "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_link_runs, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """Per node of the links `a, b` its `root`, the smallest node that it can reach.

    Alternates two steps that keep connectivity and bring every link nearer to its root: link each node's
    larger neighbours to its smallest one, then each node's smaller neighbours. Done when no link changes.
    Each round is written to the shared folder.
    """
    edges, before = written(edges, "simhash-links"), None
    while True:
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or not state[0]:
            return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
        before = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = written(small.select("e.a", "e.b").filter("a <> b").distinct(), "simhash-links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: bool = False) -> DataFrame:
    """Per row `doc_id, fp` (signed), `component_id`: the smallest id among the rows that it is linked with;
    also `text_key`, a hash of the text, and `root`, the component's smallest fingerprint.

    Null and empty texts have fingerprint zero and are linked like others. Null ids never name a component
    unless it has no other. Repeated rows each get a row. Equal fingerprints are one node, so copies are never
    paired. Other columns are left out; no rows give no rows. With `similar`, texts of which 0.8 of all five-word
    shingles are common are linked too, however far apart their fingerprints are.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), _text_key(text).alias("text_key"), fingerprints(text).alias("fp"))
    prints = written(rows, "simhash-prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(nodes))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    rooted = written(rooted, "simhash-roots")
    if similar:
        of_text = prints.select("text_key", "fp").dropDuplicates(["text_key"]).join(rooted, "fp").select("text_key", "root")
        wider = components(near_copies.links(docs.select(_text_key(text).alias("text_key"), F.col(text).alias("text")), of_text))
        wider = wider.withColumnRenamed("root", "least")
        rooted = rooted.join(wider, rooted.root == wider.node, "left").select("fp", "first_id", F.coalesce("least", "root").alias("root"))
        rooted = written(rooted, "near-roots")
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", "text_key", "fp", "root", "component_id")


def _text_key(text: str):
    return F.coalesce(F.xxhash64(text), F.lit(0))


def hex_fingerprint(fp: str = "fp"):
    """The 16 lowercase hexadecimal digits of a fingerprint."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: bool = False) -> DataFrame:
    """Of each component the document of smallest id, whole; of rows with that id one. Null ids come last."""
    id_key = F.coalesce(F.col(doc_id).cast("long"), F.lit(2**63 - 1))
    marked = near_duplicates(docs, doc_id, text, similar).withColumn("id_key", F.coalesce(F.col("doc_id").cast("long"), F.lit(2**63 - 1)))
    kept = marked.groupBy("root").agg(F.min(F.struct("id_key", "text_key")).alias("k")).select("k.id_key", "k.text_key")
    rows = docs.select(F.struct("*").alias("document"), id_key.alias("id_key"), _text_key(text).alias("text_key"))
    same = rows.join(kept, ["id_key", "text_key"]).groupBy("id_key", "text_key").agg(F.min("document").alias("document"))
    return same.select("document.*")

"""Links between texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

Texts meet by MinHash: 24 keys of four smallest values each, so that a pair of similarity 0.8 has no common key
with probability (1 - 0.8 ** 4) ** 24, 3 in a million, and a more similar pair with less. What meets is compared
exactly, on whole sets. Texts that SimHash has already brought together are not compared again.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmill.llm.common import utf8, written

SHINGLE, KEYS, VALUES = 5, 24, 4
#: Similar are sets of a and b shingles, i of them common, with 9 i >= 4 (a + b): i / (a + b - i) >= 0.8.
COMMON, SIZES = 9, 4
#: Texts of a key that meet in one task; more are dealt as pairs of blocks of this size.
BLOCK = 2048
_FACTORS = np.random.default_rng(7).integers(0, 2**63, KEYS * VALUES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Hashes of the distinct shingles of a text, sorted; a shorter text is one shingle, one without words has none."""
    words = utf8(text).lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(b" ".join(words[i : i + SHINGLE]), 5) for i in range(max(1, len(words) - SHINGLE + 1))], np.uint64))


def keys(held: np.ndarray) -> list[int]:
    """The keys of a set that is not empty."""
    least = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for at in range(0, len(held), 1024):  # bounds the memory of very long texts
        np.minimum(least, (held[at : at + 1024, None] * _FACTORS).min(axis=0), out=least)
    return [xxhash.xxh64_intdigest(v.tobytes(), k) - 2**63 for k, v in enumerate(least.reshape(KEYS, VALUES))]


def _key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            rows = [(t, keys(s)) for t, x in zip(part.column(0).to_pylist(), part.column(1), strict=True) if len(s := shingles(x.as_py()))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))], ["text_key", "keys"]
            )


def _set_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500)
            sets = [shingles(x.as_py()).tobytes() for x in part.column(1)]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], ["text_key", "held"])


def links_of(roots: list[int], sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links between different roots that connect all whose sets are similar.

    A set is held against those before it, unless the two are connected already. What differs in more bits of
    512 that each shingle flips one of, has more shingles that the other lacks than similar sets have.
    """
    up = {r: r for r in roots}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    sizes = np.array([len(s) for s in sets], np.int64)
    flips = np.zeros((len(sets), 8), np.uint64)
    for k, s in enumerate(sets):
        odd = np.bincount((s >> np.uint64(20) & np.uint64(511)).astype(np.int64), minlength=512) & 1
        flips[k] = np.packbits(odd.astype(np.uint8)).view(np.uint64)
    for k in range(1, len(sets)):
        apart = np.bitwise_count(flips[:k] ^ flips[k]).sum(axis=1, dtype=np.int64)
        both = sizes[:k] + sizes[k]
        for j in np.flatnonzero((COMMON * np.minimum(sizes[:k], sizes[k]) >= SIZES * both) & (9 * apart <= both)).tolist():
            a, b = root(roots[j]), root(roots[k])
            if a != b and COMMON * (both[j] - len(np.union1d(sets[j], sets[k]))) >= SIZES * both[j]:
                up[max(a, b)] = min(a, b)
    return [(r, low) for r in up if (low := root(r)) != r]


def _link_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of sorted rows (key, low, high, root, held): runs of equal key, low and high are groups."""
    group, roots, sets = None, [], []

    def done() -> pa.RecordBatch:
        found = links_of(roots, sets) if min(roots) < max(roots) else []
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    for batch in batches:
        for *own, root, held in zip(*[c.to_pylist() for c in batch.columns[:4]], batch.column(4), strict=True):
            if own != group:
                if roots:
                    yield done()
                group, roots, sets = own, [], []
            roots.append(root)
            sets.append(np.frombuffer(held.as_py(), np.uint64))
    if roots:
        yield done()


def links(texts: DataFrame, rooted: DataFrame, block: int = BLOCK) -> DataFrame:
    """Links `a, b` (a > b) between roots that connect all that have similar texts.

    `texts` has `text_key, text`, rows may repeat; `rooted` has each `text_key` once, with its `root`. Keys under
    which all texts have one root fall away. A key that many texts share is dealt as pairs of blocks.
    """
    keyed = written(texts.mapInArrow(_key_rows, "text_key long, keys array<long>").dropDuplicates(["text_key"]), "near-keys")
    keyed = written(keyed.join(rooted, "text_key").select(F.explode("keys").alias("key"), "text_key", "root"), "near-rows")
    shared = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most")).filter("least < most")
    blocks = F.ceil(F.col("n") / block).cast("int")
    met = written(keyed.join(shared.select("key", "n"), "key"), "near-met")
    sets = texts.join(met.select("text_key").distinct(), "text_key", "left_semi").select("text_key", "text")
    sets = sets.mapInArrow(_set_rows, "text_key long, held binary").dropDuplicates(["text_key"])
    own = F.pmod(F.xxhash64("text_key"), F.col("blocks")).cast("int")
    dealt = (
        met.withColumn("blocks", blocks)
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "text_key", "root")
        .join(written(sets, "near-sets"), "text_key")
        .select("key", "low", "high", "root", "held")
    )
    group = ["key", "low", "high"]
    return dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(_link_runs, "a long, b long").distinct()

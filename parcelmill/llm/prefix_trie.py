"""Trie of conversation prefixes: node tables with minimal perfect hashes and flat numpy arrays.

1. Turns become numbers: a 128-bit digest of role and text, and the words of the text. Texts move no further.
2. A prefix's digest is the XOR of hashes of (turn digest, depth), so it is a running aggregate, and a parent's
   digest is the node's own without its last turn. Running values are taken span by span of a conversation.
3. Nodes are the distinct digests, combined within each task first. Two different turns under one digest are a
   collision: it is looked for, and another seed taken.
4. Subtrees of at most `LIGHT` turns (counted over members, so known before the trie is) are dealt to shards whole. What
   lies above them is cut down to one shard of at most `HEAVY` nodes, since LIGHT rises with the turns that prefixes share.
   In a shard every node gets a slot of a minimal perfect hash, its digest is stored there and compared on each look-up,
   counts are scattered into arrays by slot, and a parent-slot array carries them upwards, deepest nodes first.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelmill.llm.common import WORD, written

SPAN = 4096
LIGHT, HEAVY, NODES_PER_SHARD = 20_000, 1_000_000, 200_000
IDS_PER_ROW = 4096
SEEDS = 8
KEY = ["depth", "d1", "d2"]


# --- minimal perfect hash ------------------------------------------------------------------------------------------


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    """64-bit hashes of keys (two columns of 64 bits), another one for each level."""
    x = keys[:, 0] ^ (keys[:, 1] * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64((level + 1) * 0xBF58476D1CE4E5B9 & (1 << 64) - 1)
    for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(by)
    return x ^ (x >> np.uint64(31))


class Slots:
    """Slots 0 to len(keys) - 1 of distinct keys. At each level, keys that hit a place alone stay there; the rest go on."""

    def __init__(self, keys: np.ndarray):
        self.levels, start, rest = [], 0, keys
        while len(rest):
            if len(self.levels) == 64:
                raise ValueError("repeated keys")
            size = 2 * len(rest)
            places = _mixed(rest, len(self.levels)) % np.uint64(size)
            alone = np.bincount(places.astype(np.int64), minlength=size) == 1
            self.levels.append((size, alone, start + np.cumsum(alone) - 1))
            start += int(alone.sum())
            rest = rest[~alone[places]]
        self.keys = np.zeros_like(keys)
        self.keys[self._places(keys)] = keys

    def _places(self, keys: np.ndarray) -> np.ndarray:
        found, open_ = np.full(len(keys), -1), np.arange(len(keys))
        for level, (size, alone, rank) in enumerate(self.levels):
            places = (_mixed(keys[open_], level) % np.uint64(size)).astype(np.int64)
            hit = alone[places]
            found[open_[hit]] = rank[places[hit]]
            open_ = open_[~hit]
        return found

    def of(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 where the slot holds another key, or there is none."""
        slots = self._places(keys)
        if len(self.keys):
            slots[(slots < 0) | (self.keys[slots] != keys).any(axis=1)] = -1
        return slots


def accumulated(nodes: pd.DataFrame) -> pd.DataFrame:
    """`nodes` with n_children, n_leaves, saved_tokens summed over the subtrees that the frame holds.

    below_children, below_leaves, below_saved: what is hung to a node from elsewhere.
    """
    keys = _keys(nodes, "d1", "d2")
    table = Slots(keys)
    slot = table.of(keys)
    parent, depth = (np.empty(len(nodes), np.int64) for _ in range(2))
    parent[slot], depth[slot] = table.of(_keys(nodes, "p1", "p2")), nodes["depth"]
    children, leaves, saved = (np.empty(len(nodes), np.int64) for _ in range(3))
    children[slot], leaves[slot], saved[slot] = nodes["below_children"], nodes["below_leaves"], nodes["own_saved"] + nodes["below_saved"]
    children += np.bincount(parent[parent >= 0], minlength=len(nodes))
    leaves[children == 0] = 1
    order = np.argsort(-depth, kind="stable")
    for here in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
        inner = here[parent[here] >= 0]
        np.add.at(leaves, parent[inner], leaves[inner])
        np.add.at(saved, parent[inner], saved[inner])
    out = nodes[[*KEY, "p1", "p2"]].copy()
    out["n_children"], out["n_leaves"], out["saved_tokens"] = children[slot], leaves[slot], saved[slot]
    out["top"] = parent[slot] < 0
    return out


def _keys(nodes: pd.DataFrame, a: str, b: str) -> np.ndarray:
    return np.stack([nodes[a].to_numpy(np.int64), nodes[b].to_numpy(np.int64)], axis=1).view(np.uint64)


SUMMED = "depth long, d1 long, d2 long, p1 long, p2 long, n_children long, n_leaves long, saved_tokens long, top boolean"


# --- rebuilt conversations -----------------------------------------------------------------------------------------


def numbered_turns(turns: DataFrame) -> DataFrame:
    """conv_id, position (from 0), t1, t2 (digest of role and text), words. Order: turn, null first; then role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    # a half of 64 bits: 32 bits above, 32 below
    half = lambda at: F.shiftleft(F.conv(F.substring(digest, at, 8), 16, 10).cast("long"), 32).bitwiseOR(F.conv(F.substring(digest, at + 8, 8), 16, 10).cast("long"))
    small = turns.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), half(1).alias("t1"), half(17).alias("t2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), role.alias("role"), F.sha2(text.cast("binary"), 256).alias("text_key"),
    )
    small = small.withColumn("span", F.coalesce(F.floor(F.col("turn") / SPAN), F.lit(-(1 << 62))))
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # one row for each span
    starts = small.groupBy("conv_id", "span").agg(F.count(F.lit(1)).alias("size")).select("conv_id", "span", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    # equal keys of the order are equal turns, so any order among them will do
    inside = Window.partitionBy("conv_id", "span").orderBy(F.col("turn").asc_nulls_first(), "role", "text_key")
    return small.join(starts, ["conv_id", "span"]).select("conv_id", (F.col("start") + F.row_number().over(inside) - 1).alias("position"), "t1", "t2", "words")


def rebuilt_turns(turns: DataFrame, every: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """(conv_id, depth from 1, t1, t2, words), (conv_id, length) of the rebuilt conversations; the second has turnless ones too.

    Conversation c takes its first h turns from c - c % every (as many as that has), the others are its own after its
    first h; h is the CRC-32 of c in decimal, modulo `most`.
    """
    own = written(numbered_turns(turns), "trie-turns")
    borrowed = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = own.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).select("conv_id", "own", borrowed.alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_size"))
    convs = written(
        convs.join(sizes, "base", "left").select("conv_id", "base", "h", "own", F.least("h", F.coalesce("base_size", F.lit(0))).alias("taken")), "trie-convs"
    )
    heads = own.filter(F.col("position") < most - 1).withColumnRenamed("conv_id", "base")
    lent = convs.filter("taken > 0").join(heads, "base").filter("position < taken").select("conv_id", (F.col("position") + 1).alias("depth"), "t1", "t2", "words")
    rest = own.join(convs, "conv_id").filter("position >= h").select("conv_id", (F.col("position") - F.col("h") + F.col("taken") + 1).alias("depth"), "t1", "t2", "words")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    return lent.unionByName(rest), lengths


def prefixes(steps: DataFrame, seed: int, span: int = SPAN) -> DataFrame:
    """`steps` with the digest (d1, d2) of the prefix that each one ends, and its parent's (p1, p2)."""
    term = lambda k: F.xxhash64(F.lit(2 * seed + k), "depth", "t1", "t2")
    salted = steps.withColumns({"s1": term(0), "s2": term(1), "span": F.floor((F.col("depth") - 1) / span)})
    earlier = Window.partitionBy("conv_id").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)  # one row for each span
    so_far = lambda c: F.coalesce(F.bit_xor(c).over(earlier), F.lit(0).cast("long"))
    starts = salted.groupBy("conv_id", "span").agg(F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2")).select("conv_id", "span", so_far("x1").alias("b1"), so_far("x2").alias("b2"))
    inside = Window.partitionBy("conv_id", "span").orderBy("depth")
    running = salted.join(starts, ["conv_id", "span"]).withColumns({f"d{k}": F.bit_xor(f"s{k}").over(inside).bitwiseXOR(F.col(f"b{k}")) for k in (1, 2)})
    return running.select("conv_id", "depth", "t1", "t2", "words", "d1", "d2", *[F.col(f"d{k}").bitwiseXOR(F.col(f"s{k}")).alias(f"p{k}") for k in (1, 2)])


# --- nodes ---------------------------------------------------------------------------------------------------------


def _distinct_nodes(paths: DataFrame) -> DataFrame:
    """A row for each digest; `collides` where different turns end in one digest. `reach`: turns from here on, over members."""
    ends = [F.min(c).alias(c) for c in ("conv_id", "words", "t1", "t2", "p1", "p2")]
    differs = (F.min("t1") != F.max("t1")) | (F.min("t2") != F.max("t2")) | (F.min("p1") != F.max("p1")) | (F.min("p2") != F.max("p2"))
    return paths.groupBy(*KEY).agg(*ends, F.count(F.lit(1)).alias("n_convs"), F.sum(F.col("length") - F.col("depth") + 1).alias("reach"), differs.alias("collides"))


def end_digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the decimal ids of the conversations that end at a node, ascending, comma-joined.

    Ids of a range of numbers are joined first; the hash then streams over the ranges of a node in order, so that
    however many conversations end at one node, no task holds them.
    """
    ranges = ends.groupBy(*KEY, F.floor(F.col("conv_id") / IDS_PER_ROW).alias("range")).agg(F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def hashed(batches):
        at, sha = None, None
        for batch in batches:
            out = []
            for *key, ids in batch.itertuples(index=False):
                if key != at:
                    if at is not None:
                        out.append((*at, sha.hexdigest()))
                    at, sha = key, hashlib.sha256(ids.encode())
                else:
                    sha.update(b"," + ids.encode())
            yield pd.DataFrame(out, columns=[*KEY, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, sha.hexdigest())], columns=[*KEY, "ends_sha256"])

    dealt = ranges.repartition(*KEY).sortWithinPartitions(*KEY, "range").select(*KEY, "ids")
    return dealt.mapInPandas(hashed, "depth long, d1 long, d2 long, ends_sha256 string")


def conversation_trie(turns: DataFrame) -> DataFrame:
    """One row for each node of the trie of rebuilt conversations, the root (depth 0) among them.

    Rows without a conv_id belong to no conversation and go; null roles and texts are empty; turns of equal number are
    ordered by role and a hash of the text; repeated rows are turns of their own. A table without conversations gives no
    nodes. Other columns are ignored.
    """
    steps, lengths = rebuilt_turns(turns)
    steps = written(steps, "trie-steps")
    for seed in range(SEEDS):
        paths = written(prefixes(steps, seed).join(lengths, "conv_id"), "trie-paths")
        nodes = written(_distinct_nodes(paths), "trie-nodes")
        if nodes.filter("collides").isEmpty():
            break
    else:
        raise ValueError("prefix digests collide under every seed")
    zero = F.lit(0).cast("long")
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).filter("n_convs > 0")
    # the root's own digest is zero, and what it names as its parent is no node
    root = root.select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), "conv_id", zero.alias("words"), F.lit(-1).cast("long").alias("p1"), F.lit(-1).cast("long").alias("p2"), "n_convs")
    reach = nodes.agg(F.sum(F.col("reach").cast("decimal(38,0)"))).first()[0] or 0
    light = max(LIGHT, int(reach) // HEAVY + 1)  # so fewer than HEAVY nodes reach further
    own_saved = ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved")
    bare = [zero.alias(f"below_{c}") for c in ("children", "leaves", "saved")]

    heavy = nodes.filter(F.col("reach") > light).select(*KEY, F.lit(True).alias("heavy"))
    tops = (
        paths.join(heavy, KEY, "left").groupBy("conv_id")
        .agg(F.min(F.when(F.col("heavy").isNull(), F.struct("depth", "d1", "d2"))).alias("top"))
    )  # the first light node on a conversation's way down
    count = nodes.count()
    shards = max(1, -(-count // NODES_PER_SHARD))
    below = nodes.filter(F.col("reach") <= light).join(tops, "conv_id").select(*KEY, "p1", "p2", own_saved, *bare, F.pmod(F.xxhash64("top"), F.lit(shards)).alias("shard"))
    summed = written(below.groupBy("shard").applyInPandas(lambda _, part: accumulated(part), SUMMED), "trie-light")
    hung = summed.filter("top").groupBy((F.col("depth") - 1).alias("depth"), F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(
        F.count(F.lit(1)).alias("below_children"), F.sum("n_leaves").alias("below_leaves"), F.sum("saved_tokens").alias("below_saved")
    )
    above = nodes.filter(F.col("reach") > light).select(*KEY, "p1", "p2", own_saved).unionByName(root.select(*KEY, "p1", "p2", own_saved))
    above = above.join(hung, KEY, "left").fillna(0, [c for c in hung.columns if c not in KEY])
    trunk = above.groupBy(F.lit(0).alias("shard")).applyInPandas(lambda _, part: accumulated(part), SUMMED)  # at most HEAVY nodes

    every = nodes.select(*KEY, "conv_id", "p1", "p2", "n_convs").unionByName(root.select(*KEY, "conv_id", "p1", "p2", "n_convs"))
    parents = every.select((F.col("depth") + 1).alias("depth"), F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    ends = paths.filter("depth = length").select(*KEY, "conv_id").unionByName(lengths.filter("length = 0").select(zero.alias("depth"), zero.alias("d1"), zero.alias("d2"), "conv_id"))
    return (
        every.join(summed.unionByName(trunk).select(*KEY, "n_children", "n_leaves", "saved_tokens"), KEY)
        .join(end_digests(ends), KEY, "left").join(parents, ["depth", "p1", "p2"], "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
    )

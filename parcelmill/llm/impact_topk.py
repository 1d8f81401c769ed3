"""Exact top-k search over an impact-ordered index, score at a time.

Components are integers. Each block of vectors is indexed as postings by dimension and magnitude; the
magnitudes are quantised to powers of two, and a segment holds the postings of one such impact. Segments
are processed by descending impact, all queries of a block at once: each adds its part to the partial
scores. After a segment, what is left of a score is bounded by the norms of the query and of the postings
not yet read; a query stops only when that bound proves that no other vector can enter its list, or when
all is read. The possible members are then rescored exactly.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Vectors and queries that meet in one task.
VECTORS, QUERIES = 8192, 2048
_CHUNK = 128


def components(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component; null where the vector or a component is null or not finite."""
    sound = vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(sound, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double")))


class Block:
    """The impact-ordered index of a block of vectors (rows of whole numbers)."""

    def __init__(self, vectors: np.ndarray):
        size = np.abs(vectors)
        level = np.where(size > 0, np.frexp(size)[1], 0)
        self.vectors = vectors
        #: (impact, dimensions with postings, their postings as columns) by descending impact
        self.segments = []
        rest = size**2
        for impact in sorted(set(np.unique(level)) - {0}, reverse=True):
            at = level == impact
            dims = np.flatnonzero(at.any(axis=0))
            rest = np.where(at, 0, rest)
            self.segments.append((dims, np.where(at, vectors, 0)[:, dims].T.copy(), np.sqrt(rest.sum(axis=1))))


def top_k(block: Block, ids: np.ndarray, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query, vector, score) of each query's k best in a block: all that tie with the k-th by smaller id."""
    out: list[tuple[int, int, int]] = []
    for at in range(0, len(queries), _CHUNK):
        q, q_ids = queries[at : at + _CHUNK], query_ids[at : at + _CHUNK]
        norms = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))
        partial = np.zeros((len(q), len(ids)), q.dtype)
        own = q_ids[:, None] == ids[None, :]
        going = np.arange(len(q))
        for n, (dims, postings, rest) in enumerate(block.segments):
            partial[going] += q[going][:, dims] @ postings
            last = n + 1 == len(block.segments)
            if not last and rest.max() * norms[going].min() * 2 > np.ptp(partial[going], axis=1).max():
                continue  # no bound can prove anything yet
            slack = 0 if last else 1.001 * norms[going, None] * rest[None, :] + 1
            low = np.where(own[going], -np.inf, partial[going] - slack)
            floor = -np.partition(-low, k - 1, axis=1)[:, k - 1] if len(ids) > k else np.full(len(going), -np.inf)
            possible = ~own[going] & (partial[going] + slack >= floor[:, None])
            proven = (possible.sum(axis=1) <= 4 * k) | last
            for r in np.flatnonzero(proven):
                members = np.flatnonzero(possible[r])
                scores = exact_scores(q[going[r]], block.vectors[members])
                best = sorted(zip((-s for s in scores), ids[members].tolist(), strict=True))[:k]
                out += [(int(q_ids[going[r]]), i, -s) for s, i in best]
            going = going[~proven]
            if not len(going):
                break
        if not block.segments:  # only zeros: every score is 0
            for r, qid in enumerate(q_ids.tolist()):
                out += [(qid, i, 0) for i in sorted(ids[~own[r]].tolist())[:k]]
    return out


_LONG = 2**63 - 1


def exact_scores(query: np.ndarray, vectors: np.ndarray) -> list[int]:
    """Inner products in whole numbers; beyond the range of a long the nearest long."""
    if np.abs(vectors).max(initial=0) * np.abs(query).sum() < 2**53:
        return (vectors.astype(np.float64) @ query.astype(np.float64)).astype(np.int64).tolist()
    q = [int(x) for x in query]
    return [max(-_LONG - 1, min(_LONG, sum(a * int(x) for a, x in zip(q, v, strict=True)))) for v in vectors]


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for n, v in enumerate(vectors):
        out[n, : len(v)] = v
    return out


def _searched(k: int):
    def search(vectors: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list = []
        if len(vectors) and len(queries):
            width = max(vectors["v"].map(len).max(), queries["v"].map(len).max())
            v, q = _matrix(vectors["v"], width), _matrix(queries["v"], width)
            if np.abs(v).max(initial=0) * np.abs(q).sum(axis=1).max(initial=0) < 2**24:  # exact in float32
                v, q = v.astype(np.float32), q.astype(np.float32)
            found = top_k(Block(v), vectors["id"].to_numpy(), q, queries["id"].to_numpy(), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"], dtype="int64")

    return search


def search(rows: DataFrame, queries: DataFrame, k: int, rows_per_block: int = VECTORS, queries_per_block: int = QUERIES) -> DataFrame:
    """Per query its k best rows other than itself: `query_id, rank, vec_id, score`; ties to the smaller id.

    Both frames hold `id` and `v` (whole numbers as double). Blocks of rows meet blocks of queries, so tasks
    are of bounded size, and each returns k rows a query at most. Missing components of a shorter vector count
    as 0. Query ids are distinct; every row with the query's id counts as its own, and rows whose ids repeat
    are found as often as they occur.
    """
    n_rows, n_queries = rows.count(), queries.count()
    row_blocks, query_blocks = -(-n_rows // rows_per_block) or 1, -(-n_queries // queries_per_block) or 1
    dealt = lambda df, n: F.pmod(F.xxhash64("id", "v"), F.lit(n)).cast("int")
    left = rows.withColumn("rb", dealt(rows, row_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    right = queries.withColumn("qb", dealt(queries, query_blocks)).withColumn("rb", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
    found = left.groupBy("rb", "qb").cogroup(right.groupBy("rb", "qb")).applyInPandas(_searched(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search_embeddings(vectors: DataFrame, every: int = 20, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """The rows whose id is divisible by `every` as queries against all rows; of rows that share an id, the
    smallest vector is the query.

    Vectors that are null or hold null or not finite components take no part, nor do rows without an id;
    other columns are left out; no rows give no rows.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), components(F.col(embedding)).alias("v")).filter("id is not null and v is not null")
    return search(rows, rows.filter(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v")), k)

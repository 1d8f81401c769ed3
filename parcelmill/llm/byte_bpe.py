"""Byte-level BPE by backtracking over longest matches, linear in the text.

The vocabulary's byte strings, mapped to Latin-1, form an Aho-Corasick automaton that finds the longest
token at a position. A token may follow another if merging would not have crossed their border, which
the merge history of the two tells (`_Vocabulary.fits`, memoised). Where no token fits, the last one is
taken back and its next shorter prefix tried; a position once given up is never tried again, so the
result is the one sequence that merging by rank gives.
"""

import base64
import hashlib
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Pieces and token pairs that one worker remembers before it starts anew; bounds its memory.
REMEMBERED = 150_000
#: Rows that a worker encodes before it hands them on.
HELD_ROWS = 200


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """A vocabulary file (one base64 token and its rank per line), read on the driver; under a few MB."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class _Vocabulary:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.pieces = regex.compile(pattern).findall
        self.trie = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self.trie.add_word(token.decode("latin-1"), rank)
        self.trie.make_automaton()
        self.longest = max(map(len, ranks))
        self.shorter = {rank: self._prefix(token[:-1]) for token, rank in ranks.items()}
        self.pairs: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int]] = {}
        self.memo: dict[tuple[int, int], bool] = {}
        for rank in sorted(self.bytes):
            self._learn(rank)
        self.memo.clear()
        self.known: dict[str, tuple[tuple[int, ...], bytes, bytes]] = {}

    def _prefix(self, data: bytes) -> int | None:
        while data and data not in self.ranks:
            data = data[:-1]
        return self.ranks[data] if data else None

    def _learn(self, rank: int) -> None:
        """Find the last merge that made a token: its two halves are older and fit together."""
        token, left = self.bytes[rank], self.shorter[rank]
        while left is not None:
            right = self.ranks.get(token[len(self.bytes[left]) :])
            if left < rank and right is not None and right < rank and self._fits(left, right):
                self.pairs[left, right], self.split[rank] = rank, (left, right)
                return
            left = self.shorter[left]
        self.split[rank] = (rank, rank)

    def _fits(self, left: int, right: int) -> bool:
        """Whether merging leaves a border between two tokens.

        Undo merges from the latest on: a pair of parts at the border that merges earlier than the
        merges undone so far would have crossed it.
        """
        limit = float("inf")
        while True:
            if self.pairs.get((left, right), limit) < limit:
                return False
            if left > right:
                turn = (True, False)
            else:
                turn = (False, True)
            for of_left in turn:
                if of_left:
                    limit, part = left, self.split[left][1]
                    if part != left:
                        left = part
                        break
                else:
                    limit, part = right + 1, self.split[right][0]
                    if part != right:
                        right = part
                        break
            else:
                return True

    def fits(self, left: int, right: int) -> bool:
        found = self.memo.get((left, right))
        if found is None:
            if len(self.memo) >= REMEMBERED:
                self.memo.clear()
            found = self.memo[left, right] = self._fits(left, right)
        return found

    def encode_piece(self, data: bytes) -> list[int]:
        """Ids of one piece: a piece that is itself a token stays whole."""
        if data in self.ranks:
            return [self.ranks[data]]
        text, size = data.decode("latin-1"), len(data)

        def match(at: int) -> int:
            """The longest token at a position: as deep as the trie goes, then back to a token's end."""
            size = self.trie.longest_prefix(text[at : at + self.longest])
            while (rank := self.ranks.get(data[at : at + size])) is None:
                size -= 1
            return rank

        open_at = bytearray(b"\x01" * (size + 1))
        out: list[int] = []
        at, token = 0, match(0) if size else None
        while token is not None:
            end = at + len(self.bytes[token])
            if open_at[end] and (not out or self.fits(out[-1], token)):
                out.append(token)
                at = end
                token = match(at) if at < size else None
            elif (less := self.shorter[token]) is not None:
                token = less
            else:
                open_at[at] = 0
                token = out.pop()
                at -= len(self.bytes[token])
        return out

    def encode(self, text: str) -> list[list[int]]:
        return [list(self.piece(p)[0]) for p in self.pieces(text)]

    def piece(self, piece: str) -> tuple[tuple[int, ...], bytes, bytes]:
        """Ids of a piece, the same as text, and the bytes that the ids stand for."""
        found = self.known.get(piece)
        if found is None:
            if len(self.known) >= REMEMBERED:
                self.known.clear()
            ids = tuple(self.encode_piece(piece.encode("utf-8", "surrogatepass")))
            found = ids, b",".join(b"%d" % i for i in ids), b"".join([self.bytes[i] for i in ids])
            if len(piece) <= 64:
                self.known[piece] = found
        return found


_built: dict[int, _Vocabulary] = {}


def _vocabulary(shared, pattern: str) -> _Vocabulary:
    """The vocabulary of a broadcast, built once per worker."""
    if shared.id not in _built:
        _built.clear()
        _built[shared.id] = _Vocabulary(shared.value, pattern)
    return _built[shared.id]


class _Shared:
    """The ranks as a broadcast with an id that workers can key on."""

    def __init__(self, spark: SparkSession, ranks: dict[bytes, int]):
        self.broadcast = spark.sparkContext.broadcast(ranks)
        self.id = hash(frozenset(ranks.items()))

    @property
    def value(self):
        return self.broadcast.value


def _encode_rows(shared: _Shared, pattern: str, with_ids: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = _vocabulary(shared, pattern)
        # what earlier stages left in a worker that is used again
        pa.default_memory_pool().release_unused()
        for batch in batches:
            for at in range(0, batch.num_rows, HELD_ROWS):
                part = batch.slice(at, HELD_ROWS)
                sizes, flat, digests = [], array("i"), ([], [])
                for text in part.column(1):
                    before = len(flat)
                    for out, digest in zip(digests, _encoded(vocabulary, text.as_py(), flat), strict=True):
                        out.append(digest)
                    sizes.append(len(flat) - before)
                columns = [part.column(0), pa.array(sizes, pa.int64())]
                if with_ids:
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
                    columns.append(pa.ListArray.from_arrays(offsets, pa.array(np.array(flat, np.int32))))
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(d, pa.string()) for d in digests)], names)

    return run


def _encoded(vocabulary: _Vocabulary, text: str | None, flat: array) -> tuple[str, str]:
    """Append a text's ids to `flat`; the digests of the ids and of the bytes that they stand for."""
    pieces = list(map(vocabulary.piece, vocabulary.pieces(text or "")))
    for p in pieces:
        flat.extend(p[0])
    ids = b",".join([p[1] for p in pieces])
    return hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"".join([p[2] for p in pieces])).hexdigest()


def encode_documents(
    docs: DataFrame, ranks_path: str, pattern: str, with_ids: bool = True, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row `doc_id, n_tokens, ids, ids_sha256, decoded_sha256` (`ids` only on request), each text whole.

    A null text counts as empty: no ids, and the digests of no bytes. Repeated rows each get a row, other
    columns are left out, no rows give no rows. Special tokens are not known: their text is text. The
    vocabulary is broadcast, as its file has a few MB at most; a task hands on a few rows at a time.
    """
    shared = _Shared(docs.sparkSession, read_ranks(docs.sparkSession, ranks_path))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kinds = {"doc_id": rows.schema["doc_id"].dataType.simpleString(), "n_tokens": "long", "ids": "array<int>"}
    names = ["doc_id", "n_tokens", *["ids"] * with_ids, "ids_sha256", "decoded_sha256"]
    schema = ", ".join(f"{n} {kinds.get(n, 'string')}" for n in names)
    return rows.mapInArrow(_encode_rows(shared, pattern, with_ids, names), schema)

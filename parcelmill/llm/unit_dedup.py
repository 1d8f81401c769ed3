"""Substring dedup by hashing lines and the clauses inside them.

Units are lines, and inside a line the clauses that begin after a sentence end or with a capital letter:
a passage that was pasted into the middle of a line then still consists of whole units. Each unit is
normalised (lower case, single blanks) and hashed to 128 bits; digests are grouped over all documents, the
occurrence in the document of smallest id stays, and later ones go: whole lines of `LINE_WORDS` words or
more, and runs of repeated clauses that together have `RUN_WORDS` words or more, so that short clauses that
recur by chance stay. Offsets refer to the original text, in code points.
"""

import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm.common import written

#: A repeated line goes from this many words on, a run of repeated clauses from that many.
LINE_WORDS, RUN_WORDS = 8, 20
LINE, CLAUSE = 1, 2
#: White space before a capital letter or after a sentence end.
_BORDER = re.compile(r"(?<=[.!?])[^\S\n]+|[^\S\n]+(?=[^\W\d_a-z])")
_UNIT = "doc_key long, text_key long, kind int, idx int, start int, stop int, words int, h1 long, h2 long"
_ITEM = ("kind", "idx", "start", "stop", "words", "h1", "h2", "first_doc")
_LAST = 2**63 - 1


def clauses(line: str, at: int) -> list[tuple[int, int, list[str]]]:
    """(start, stop, words) of the clauses of a line that begins at offset `at`; blank ones left out."""
    out, begin = [], 0
    for m in _BORDER.finditer(line):
        if m[0] and line[m.end() : m.end() + 1].islower() and line[m.start() - 1 : m.start()] not in (".", "!", "?"):
            continue  # a letter of another script that has no capital form here
        out.append((begin, m.start()))
        begin = m.end()
    out.append((begin, len(line)))
    found = []
    for a, b in out:
        part = line[a:b]
        if words := part.split():
            a += len(part) - len(part.lstrip())
            found.append((at + a, at + a + len(part.strip()), words))
    return found


def units(text: str | None) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """(kind, index, start, stop, number of words, digest) of the units of a text."""
    at = idx = 0
    for line in (text or "").split("\n"):
        found = clauses(line, at)
        at += len(line) + 1
        if not found:
            continue
        if len(found) > 1:
            words = [w for c in found for w in c[2]]
            yield LINE, idx, found[0][0], found[-1][1], len(words), _digest(words)
        for start, stop, words in found:
            yield LINE * (len(found) == 1) + CLAUSE, idx, start, stop, len(words), _digest(words)
            idx += 1


def _digest(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words).lower().encode("utf-8", "surrogatepass"))


def _unit_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            part = batch.slice(at, 500).to_pydict()
            out = [[] for _ in range(9)]
            for doc_key, text_key, text in zip(part["doc_key"], part["text_key"], part["text"], strict=True):
                for kind, idx, start, stop, words, digest in units(text):
                    h1, h2 = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
                    for column, value in zip(out, (doc_key, text_key, kind, idx, start, stop, words, h1, h2), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if 2 <= k < 7 else pa.int64()) for k, c in enumerate(out)], [x.split()[0] for x in _UNIT.split(", ")]
            )


def spans(doc_key: int, items: list, text: str, line_words: int, run_words: int) -> list[tuple[int, int]]:
    """The parts of a text to remove. `items`: its units whose digest occurs elsewhere or twice here."""
    seen: set[tuple[int, int]] = set()
    gone: list[tuple[int, int]] = []
    run: list = []

    def end_run() -> None:
        if sum(u["words"] for u in run) >= run_words:
            gone.append((run[0]["start"], run[-1]["stop"]))
        run.clear()

    for u in sorted(items, key=lambda u: (u["start"], -u["stop"], u["kind"])):
        own = (u["h1"], u["h2"])
        first = u["first_doc"] == doc_key and own not in seen
        seen.add(own)
        if u["kind"] & LINE and not first and u["words"] >= line_words:
            gone.append((u["start"], u["stop"]))
        if u["kind"] & CLAUSE:
            if run and u["idx"] != run[-1]["idx"] + 1:
                end_run()
            if first:
                end_run()
            else:
                run.append(u)
    end_run()
    out: list[tuple[int, int]] = []
    for start, stop in sorted(gone):
        while stop < len(text) and text[stop].isspace():
            stop += 1
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


def _cutter(line_words: int, run_words: int):
    @pandas_udf("text string, removed array<struct<start:int,stop:int>>, removed_chars long")
    def cut(doc_key: pd.Series, text: pd.Series, items: pd.Series) -> pd.DataFrame:
        rows = []
        for key, t, found in zip(doc_key, text, items, strict=True):
            gone = [] if found is None or not len(found) else spans(key, list(found), t, line_words, run_words)
            if gone:
                at, kept = 0, []
                for start, stop in gone:
                    kept.append(t[at:start])
                    at = stop
                t = "".join([*kept, t[at:]])
            rows.append((t, [{"start": a, "stop": b} for a, b in gone], sum(b - a for a, b in gone)))
        return pd.DataFrame(rows, columns=["text", "removed", "removed_chars"])

    return cut.asNondeterministic()


def dedup_units(
    docs: DataFrame, line_words: int = LINE_WORDS, run_words: int = RUN_WORDS, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per row `doc_id`, `text` without repeated units, `removed` (spans of the original), `removed_chars`
    and `document`, the row itself.

    Rank is the smaller doc_id, then the smaller offset; null ids rank last, as one. Rows that share an id
    rank equal: each keeps its own first occurrence, so repeated rows get equal results. A null text stays
    null. Other columns stay in `document`; no rows give no rows.

    The units' digests are shuffled, never texts; a very common unit is one row after the partial counts,
    and its join with the others is one that adaptive execution splits. Texts move once, to meet their spans.
    """
    rows = docs.select(
        F.struct("*").alias("document"),
        F.col(doc_id).alias("doc_id"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(_LAST)).alias("doc_key"),
        F.coalesce(F.xxhash64(text), F.lit(0)).alias("text_key"),
        F.col(text).alias("text"),
    )
    every = rows.select("doc_key", "text_key", "text").mapInArrow(_unit_rows, _UNIT)
    first = every.groupBy("h1", "h2").agg(F.min("doc_key").alias("first_doc"), F.count("*").alias("n")).filter("n > 1").drop("n")
    # stored, so that the join deals both its sides itself and can split a digest that very many units have
    first = written(first, "repeated-units")
    repeated = every.join(first, ["h1", "h2"]).groupBy("doc_key", "text_key").agg(F.collect_set(F.struct(*_ITEM)).alias("items"))
    cut = _cutter(line_words, run_words)
    return (
        rows.join(repeated, ["doc_key", "text_key"], "left")
        .select("doc_id", "document", cut("doc_key", "text", "items").alias("c"))
        .select("doc_id", "c.text", "c.removed", "c.removed_chars", "document")
    )

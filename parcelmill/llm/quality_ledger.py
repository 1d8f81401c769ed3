"""Quality rules as a ledger: every rule is evaluated once and leaves a bit and its measurements.

Policies are versioned masks over the bits, so a new policy or an ablation reads the stored bits alone.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from parcelmill.llm.common import utf8

#: Rules in bit order; integer arithmetic, so that every engine decides alike.
RULES = {
    "few_words": lambda m: m["n_words"] < 10,
    "repeated_passages": lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"],
    "many_symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "repeated_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "short_words": lambda m: m["word_chars"] < 2 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 15 * m["n_words"],
    "stutter": lambda m: 5 * m["n_stutter"] > m["n_words"],
    "shouting": lambda m: 2 * m["n_exclaims"] > m["n_words"],
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
BASE = BITS["few_words"] | BITS["repeated_passages"]
#: Versioned policies: a document is kept if none of the mask's rules fails.
POLICIES = {"base": BASE, "v1": sum(BITS.values())}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stutter", "n_exclaims")
SYMBOLS, SPACES = b"#*$%&|<>", b" \t\n\v\f\r"
WINDOW = 5


def repeated_words(ids: np.ndarray, n_kinds: int) -> int:
    """Words inside windows of five words that occur twice or more."""
    n = len(ids) - WINDOW + 1
    if n < 2 or n_kinds == len(ids):
        return 0
    code, kinds = ids[:n], n_kinds
    for k in range(1, WINDOW):
        if kinds >= 2**62 // n_kinds:  # number the codes anew before they overflow
            code = np.unique(code, return_inverse=True)[1]
            kinds = int(code.max()) + 1
        code = code * n_kinds + ids[k : k + n]
        kinds *= n_kinds
    _, place, count = np.unique(code, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[place] > 1)
    if not len(starts):
        return 0
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, starts, 1)
    np.add.at(mark, starts + WINDOW, -1)
    return int((np.cumsum(mark)[:-1] > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES."""
    raw = utf8(text)
    words = raw.split()
    kinds = dict(zip(set(words), range(len(words))))
    ids = np.fromiter(map(kinds.__getitem__, words), np.int64, len(words))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (
        len(words),
        len(text or "") - sum(raw.count(c) for c in SPACES),
        sum(raw.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids, len(kinds)),
        len(lines),
        int((ids[1:] == ids[:-1]).sum()),
        raw.count(b"!"),
    )


def _measures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for part in texts:
        yield pd.DataFrame([measure(t) for t in part], columns=list(MEASURES), dtype="int64")


def ledger(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row `doc_id`, the measurements, `fail_bits`, and `document`, the row itself.

    Null and empty texts measure 0 and fail `few_words`. Repeated rows each get a row. Other columns stay
    in `document`; no rows give no rows. One pass over the texts, nothing is shuffled.
    """
    measures = pandas_udf(_measures, ", ".join(f"{m} long" for m in MEASURES)).asNondeterministic()
    measured = docs.select(F.struct("*").alias("document"), F.col(doc_id).alias("doc_id"), measures(text).alias("m"))
    m = {k: F.col(f"m.{k}") for k in MEASURES}
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits + F.when(rule(m), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long")
    return measured.select("doc_id", *[m[k].alias(k) for k in MEASURES], bits.alias("fail_bits"), "document")


def passes(policy: str = "v1"):
    """Whether the stored bits satisfy a policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(POLICIES[policy]).cast("long")) == 0


def ablation(stored: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of a policy: `failed` documents, and those that it alone `decides`. Reads bits, no text.

    Bits are counted before the shuffle, so at most one row per bit pattern and task moves.
    """
    mask = POLICIES[policy]
    patterns = stored.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(b).cast("long").alias("bit")) for k, b in BITS.items() if b & mask])
    each = patterns.select("bits", "n", F.explode(rules).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(failed, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("decides"),
    )

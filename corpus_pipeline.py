"""From raw documents to mixed, tokenised training text in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of
`documents`. `run` stores each stage's rows in the shared folder and gives them to the next one. Stages take
whatever columns `docs` has; empty tables pass through; null texts go with the first stage.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelmill.llm import byte_bpe, quality_ledger, simhash_ring, source_mix, unit_dedup
from parcelmill.llm.common import table, written
from parcelmill.llm.queries import PATTERN, RANKS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that policy `v1` accepts."""
    return quality_ledger.ledger(docs).filter(quality_ledger.passes("v1")).select("document.*")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: fingerprints within 3 bits, or 0.8 of the five-word shingles common."""
    return simhash_ring.one_per_component(docs, similar=True)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines and passages; a document of which nothing is left goes."""
    changed = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    cut = unit_dedup.dedup_units(docs).filter((F.col("removed_chars") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(f"document.`{c}`").alias(c) for c in docs.columns])


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whole, as often as the mix takes them."""
    return source_mix.mixed_documents(docs)


def byte_bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and digests of the ids and of the bytes decoded from them."""
    return byte_bpe.encode_documents(docs, RANKS, PATTERN)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", simhash_near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources to target weights", source_mixing),
    ("byte-level BPE encoding and decoding", byte_bpe_encoding),
]

#: SQL has no XXH64 fingerprints and no byte-level BPE: tests hold `run` against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs, f"pipeline-{k}")
    return docs

"""Training-corpus pipeline: documents in, packed token sequences out.

Part of the ``llm`` subpackage.  Each stage takes all rows its predecessor
kept and calls one operator; all but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import mixing, packing, quality, repeats, simhash
from meterlake.llm.shared import fresh, saved, table, words


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the learned list (operator 2)."""
    got = quality.judged_rows(docs, table(spark, sf_dir, "labels"))
    return got.filter("kept").select("row.*")


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 9)."""
    return simhash.keep_first(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages cut out; documents of which nothing is left go (operator 8)."""
    got = repeats.remove_repeats(docs)
    return got.filter(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it (operator 3)."""
    return mixing.mixed(docs, mixing.cyclic_weights, F.size(words(F.col("text"))))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences (operator 4); a repeated document is packed each time."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", simhash_dedup),
    ("substring dedup", substring_dedup),
    ("source mixing", mix_sources),
    ("best-fit packing", pack),
]

# Learned rules, seeded hashes and tokenizers cannot be said in SQL; tests/llm
# holds each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each written as Parquet and read again.

    Pieces of all that is kept.  NULL and empty texts fail the quality limits;
    rows with NULL id have no labels, may be near-duplicates, and neither give
    nor lose passages; repeated rows are one group of near-duplicates, of
    which one stays; long texts are read whole; further columns are carried
    through, whatever their names, up to the last stage.  An empty table gives
    no pieces.
    """
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, f"stage-{name.replace(' ', '-')}")
    return docs

"""A corpus pipeline of five operators: identify, deduplicate, decontaminate, replace PII, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a DataFrame; run() writes each as
Parquet in the shared folder and reads it as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import decontaminate, langid, packing, pii, simhash
from tessera.llm.common import crc_mod, materialize, table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the language model doesn't reject; lang is what it was. Learns as op3 does."""
    return langid.keep_identified(docs, langid.fit(docs.where(crc_mod("doc_id", 5) != 0)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.simhash_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for the entities in their texts; n_chars, where there is one, follows the text."""
    out = pii.surrogate_pii(docs)
    if "n_chars" not in out.columns:
        return out
    kind = docs.schema["n_chars"].dataType
    return out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in their sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii_surrogates", replace_pii),
    ("best_fit_packing", pack_sequences),
]
#: XXH64 fingerprints, trained models and tokenizers are beyond SQL. tests/llm holds the operators against brute force, and run()
#: against plain loops on clear-cut documents; the language model is the one part that those loops share.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)

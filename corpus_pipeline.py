"""Corpus pipeline: documents -> good, distinct, uncontaminated, mixed, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``; the last returns one row per
document in the token files. A document that the mixing stage repeats appears
once per copy. NULL texts and ids, empty tables, repeated rows and extra
columns go through as the operators define.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daylake.llm import decontaminate, mixing, quality, queries, simhash, wavelet
from daylake.llm.common import stage, table
from daylake.session import run_folder


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below 0.5 go."""
    return quality.keep_good(docs, queries.quality_model(spark, docs, sf_dir))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: one document of each linked group stays."""
    return simhash.drop_near_duplicates(docs)


def uncontaminated_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark item go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: documents are repeated or left out, then shuffled."""
    return mixing.mix(docs).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files, one wavelet matrix per shard, and what they hold."""
    path = run_folder(spark, "corpus-tokens")
    wavelet.write_tokens(docs, path, queries.tokenizer_path())
    return wavelet.read_documents(spark, path)


STAGES = [
    ("quality", good_documents),
    ("simhash", distinct_documents),
    ("decontamination", uncontaminated_documents),
    ("mixing", mixed_documents),
    ("tokens", token_files),
]

# Trained scores, XXH64 fingerprints and BPE have no DuckDB SQL; tests/llm
# hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Corpus pipeline, from raw documents to token ids, and the registry of the corpus queries.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All stages but the
last return the columns they were given. Null and empty texts pass the filters once: they are equal to
each other, so one of them stays. The last stage carries the columns CARRIED and adds n_tokens, ids
and the decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quipyard.llm import bpe, decontamination, exact_dedup, simhash, toxicity
from quipyard.llm.queries import ORACLES, QUERIES, tokenizer_file
from quipyard.session import store

CARRIED = ("doc_id", "lang", "source", "n_chars")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    return toxicity.drop_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each set of documents that are equal but for whitespace."""
    return exact_dedup.drop_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near SimHash fingerprints."""
    return simhash.keep_one_of_each(docs, shingle=4, distance=4)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document and the text they decode to."""
    return bpe.encode_decode(docs, tokenizer_file(), carry=CARRIED)


STAGES = [
    ("toxicity", without_toxic),
    ("exact_dedup", without_copies),
    ("simhash", without_near_copies),
    ("decontamination", without_benchmark),
    ("bpe", to_tokens),
]

#: Most stages cannot be said in SQL; tests hold the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = {**QUERIES, "pipeline": run}

__all__ = ["ORACLES", "ORACLE_SQL", "QUERIES", "STAGES", "run"]

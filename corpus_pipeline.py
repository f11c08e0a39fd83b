"""Corpus pipeline: filters, near-dedup, decontamination, sanitisation and packing of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.llm.common import Step, read_table
from sedimenta.llm.decontaminate import without_benchmark
from sedimenta.llm.packing import packed
from sedimenta.llm.pii import sanitised
from sedimenta.llm.simhash import without_near_duplicates
from sedimenta.llm.tokens import vocabulary
from sedimenta.llm.toxicity import without_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, read_table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_near_duplicates(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_benchmark(docs, read_table(spark, sf_dir, "benchmark"))


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sanitised(docs).withColumn("n_chars", F.char_length("text").cast("long"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packed(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_benchmark),
    ("pii", sanitise),
    ("packing", pack),
]

# Classifier, fingerprints and tokenizer have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each on what the one before has written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = Step(stage(spark, docs, sf_dir), f"stage-{name.split()[0]}").df
    return STAGES[-1][1](spark, docs, sf_dir)

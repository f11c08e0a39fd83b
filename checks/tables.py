"""The given tables as inputs of the layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sedimenta.constants import SEARCH_TERMS, SOURCE_CREDIBILITY
from sedimenta.schemas import LEXICON
from sedimenta.session import scratch_path
from sedimenta.sources.records import raw_records, stamped, union_records

# Labels in all spellings the normalization has to deal with.
LABEL_SPELLINGS = [
    "true", " TRUE ", "mostly-true", "half-true", "Real", "false", "Pants-Fire\n",
    "\tbarely-true", "FAKE", "unknown", "unlabeled", "", "not true",
]

# Class names of the statements, by number.
STATEMENT_CLASSES = ["true", "fake", "half-true", "unproven", "false", "mostly-true", "satire"]

# Words that do occur in the invented prose of the given documents.
WORDS = [
    ("rest", 0.5, "polar"),
    ("thing", 0.75, "polar"),
    ("for", 0.25, "polar"),
    ("thin", -0.25, "polar"),
    ("at", -0.125, "polar"),
    ("sting", -0.75, "polar"),
    ("threat", -1.0, "polar"),
    ("est", 0.875, "polar"),
    ("keit", -0.5, "polar"),
    ("the", 1.5, "intensifier"),
    ("and", 0.5, "intensifier"),
    ("der", 2.0, "intensifier"),
    ("of", 0.0, "negator"),
    ("un", 0.0, "negator"),
]

CREDIBILITY = {**SOURCE_CREDIBILITY, "pages": 0.9, "src1": 0.25, "src7": 0.125}


# Columns of the given tables, so that no job has to look them up.
COLUMNS = {
    "documents": "doc_id long, text string, lang string, source string, n_chars long",
    "labels": "doc_id long, quality int, toxic int",
    "pages": "page_id long, url string, html string",
    "benchmark": "item_id long, text string",
    "conversations": "conv_id long, turn long, role string, text string",
    "embeddings": "vec_id long, embedding array<float>, label int",
    "events": "event_id long, ts timestamp, user_id long, event_type string, value double,"
    " props string",
    "lineitem": "l_orderkey long, l_linenumber int, l_discount double, l_tax double",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(WORDS, LEXICON)


def as_of() -> Column:
    return F.lit("2024-01-01 00:00:00").cast("timestamp")


def spelled_label(key: str) -> Column:
    spellings = F.array(*[F.lit(s) for s in LABEL_SPELLINGS])
    return F.element_at(spellings, (F.col(key) % len(LABEL_SPELLINGS) + 1).cast("int"))


def labeled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the numbers of their label, NULL where they have none."""
    return table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id", "left")


def label_word() -> Column:
    return (
        F.when(F.col("toxic") == 1, "fake")
        .when(F.col("quality") == 0, "barely-true")
        .when(F.col("quality") == 1, "mostly-true")
        .otherwise("unknown")
    )


def document_records(spark: SparkSession, folder: str) -> DataFrame:
    return raw_records(
        labeled_documents(spark, folder),
        F.col("doc_id"), F.col("text"), label_word(), F.col("source"),
        [F.col("lang"), F.col("n_chars")],
    )


def page_records(spark: SparkSession, folder: str) -> DataFrame:
    return raw_records(
        table(spark, folder, "pages"),
        F.col("page_id"), F.col("html"), F.lit("half-true"), "pages", [F.col("url")],
    )


def benchmark_records(spark: SparkSession, folder: str) -> DataFrame:
    return raw_records(
        table(spark, folder, "benchmark"),
        F.col("item_id"), F.col("text"), F.lit("Pants-Fire\n"), "benchmark", [],
    )


def changed_records(spark: SparkSession, folder: str) -> DataFrame:
    """A later delivery: labeled documents with new text and label, pages and benchmark."""
    documents = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")
    changed = raw_records(
        documents,
        F.col("doc_id"), F.concat(F.lit("Checked! "), "text"), F.lit("real"), F.col("source"),
        [F.col("lang")],
    )
    return union_records(
        [changed, page_records(spark, folder), benchmark_records(spark, folder)]
    )


def bronze(spark: SparkSession, folder: str) -> DataFrame:
    """All records of the given text tables."""
    parts = [f(spark, folder) for f in (document_records, page_records, benchmark_records)]
    return stamped(union_records(parts), as_of())


def posts(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as posts; turns of the system have no uri."""
    turns = table(spark, folder, "conversations")
    terms = F.array(*[F.lit(t) for t in SEARCH_TERMS])
    number = (F.col("conv_id") % len(SEARCH_TERMS) + 1).cast("int")
    uri = F.concat(F.lit("at://"), F.col("conv_id"), F.lit("/"), F.col("turn"))
    return turns.select(
        F.when(F.col("role") == "system", "").otherwise(uri).alias("uri"),
        F.col("conv_id").cast("string").alias("cid"),
        F.concat(F.lit("2024-01-0"), F.col("turn") + 1).alias("indexed_at"),
        F.struct("text").alias("record"),
        F.struct(
            F.col("role").alias("did"), F.concat("role", F.lit(".example")).alias("handle")
        ).alias("author"),
        F.col("turn").alias("reply_count"),
        F.lit(None).cast("long").alias("repost_count"),
        (F.col("conv_id") % 7).alias("like_count"),
        F.element_at(terms, number).alias("query"),
    )


def landed(df: DataFrame, format: str = "json") -> str:
    """Write a table to the scratch folder, as a collector would land it, and return the path."""
    path = scratch_path(df.sparkSession, "landed")
    df.write.format(format).save(path)
    return path

"""Bronze to silver: distinct texts, cleaned, with a class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean, has_text, label_class, text_digest, word_count
from ..operators.dedup import distinct_texts, distinct_texts_in_place
from ..operators.deliveries import new_files, note_files, rows_of, table_files
from ..operators.merge import append, brought_together, listed, read_table, upsert
from ..schemas import BRONZE, SILVER, SILVER_PARTITIONS, SILVER_STORED, TEXT_DIGEST
from ..session import discard, scratch_path


def with_text_columns(df: DataFrame) -> DataFrame:
    """Add cleaned text and its counts."""
    return (
        df.withColumn("text_clean", clean(F.col("text")))
        .withColumn("word_count", word_count(F.col("text_clean")))
        .withColumn("char_count", F.length("text_clean"))
    )


def to_silver(bronze: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Distinct non-blank texts with label class and cleaned text.

    Texts are compared as they came, before cleaning. Blank ones go first: text is part of the
    group, so the groups that remain are the same.
    """
    return _as_silver(distinct_texts(bronze.where(has_text(F.col("text")))), as_of)


def _as_silver(rows: DataFrame, as_of: Column | None) -> DataFrame:
    now = F.current_timestamp() if as_of is None else as_of
    return (
        with_text_columns(rows)
        .withColumn("label_binary", label_class(F.col("label")))
        .withColumn("processed_at", now)
        .select(*SILVER.names)
    )


def to_silver_table(
    bronze: DataFrame, as_of: Column | None = None, together: bool = True
) -> DataFrame:
    """The rows of :func:`to_silver`, those of a partition brought together unless told not to.

    Raw rows go through no other shuffle; cleaned texts are made after it.
    """
    rows = distinct_texts_in_place(bronze.where(has_text(F.col("text"))))
    return _as_silver(brought_together(rows, SILVER_PARTITIONS) if together else rows, as_of)


def known_digests(silver: DataFrame) -> DataFrame:
    """(source, digest) of all texts of silver; texts are read only where no digest is stored."""
    stored = silver.where(F.col(TEXT_DIGEST).isNotNull()).select(
        "source", F.col(TEXT_DIGEST).alias("_digest")
    )
    older = silver.where(F.col(TEXT_DIGEST).isNull()).select("source", text_digest(F.col("text")).alias("_digest"))
    return stored.unionByName(older)


def new_texts(bronze: DataFrame, silver: DataFrame) -> DataFrame:
    """Bronze rows with a text that silver does not have in the same source.

    Bronze rows never change, and the first row of a text stays its silver row, so the others
    have nothing to add. Digests are compared, never texts.
    """
    fresh = bronze.where(has_text(F.col("text"))).withColumn("_digest", text_digest(F.col("text")))
    known = known_digests(silver)
    return fresh.join(known, ["source", "_digest"], "left_anti").select(*bronze.columns)


def refresh_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    as_of: Column | None = None,
    full: bool = False,
) -> dict[str, int]:
    """Bring the silver table up to date with the bronze table.

    Only files of bronze that silver has not taken yet are read, and only rows that it does not
    have are cleaned and appended, unless ``full`` asks for all. Of silver the digests of the same
    sources are read. A run that was lost before it noted its files takes them again, and finds
    their texts there. Returns how many rows went into the de-duplication and how many came out.
    """
    bronze = read_table(spark, bronze_path, BRONZE)
    if bronze is None:
        raise FileNotFoundError(bronze_path)
    silver = None if full else read_table(spark, silver_path, SILVER_STORED)
    if silver is None:
        files = table_files(bronze)
        rows = to_silver_table(bronze, as_of).withColumn(TEXT_DIGEST, text_digest(F.col("text")))
        after = upsert(
            rows, silver_path, SILVER_STORED, partition_by=SILVER_PARTITIONS, together=True
        )
        note_files(spark, silver_path, files, anew=True)
        return {"rows_before": bronze.count(), "rows_after": after}
    files = new_files(spark, bronze, silver_path)
    if not files:
        return {"rows_before": 0, "rows_after": 0}
    delivered = rows_of(spark, bronze, bronze_path, BRONZE, files)
    path = scratch_path(spark, "delivered")
    try:
        known = silver.where(listed(delivered, SILVER_PARTITIONS))
        new_texts(delivered, known).write.parquet(path)
        fresh = spark.read.schema(BRONZE).parquet(path)
        before = fresh.count()
        rows = to_silver(fresh, as_of).withColumn(TEXT_DIGEST, text_digest(F.col("text")))
        after = append(rows, silver_path, SILVER_STORED, SILVER_PARTITIONS) if before else 0
    finally:
        discard(spark, path)
    note_files(spark, silver_path, files)
    return {"rows_before": before, "rows_after": after}

"""Silver to gold: features and split of the rows with a known class."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import SOURCE_CREDIBILITY, UNKNOWN
from ..functions.records import hash_split
from ..functions.text import avg_word_length, caps_ratio, exclamation_ratio
from ..operators.joins import with_credibility
from ..operators.deliveries import new_files, note_files, place, rows_of, table_files
from ..operators.merge import append, listed, read_table, unmatched, upsert
from ..operators.sentiment import with_sentiment
from ..schemas import GOLD, GOLD_PARTITIONS, SILVER, SILVER_PARTITIONS
from ..session import discard, folder_at


def known_labels(silver: DataFrame) -> DataFrame:
    return silver.where(F.col("label_binary") != UNKNOWN)


def with_text_ratios(df: DataFrame) -> DataFrame:
    """Add the three ratios; needs raw and cleaned text and the counts."""
    return df.withColumns(
        {
            "exclamation_ratio": exclamation_ratio(F.col("text_clean"), F.col("char_count")),
            "caps_ratio": caps_ratio(F.col("text")),
            "avg_word_length": avg_word_length(F.col("char_count"), F.col("word_count")),
        }
    )


def with_features(
    df: DataFrame,
    lexicon: DataFrame,
    credibility: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
) -> DataFrame:
    """Add sentiment, ratios and source credibility."""
    return with_credibility(with_text_ratios(with_sentiment(df, lexicon)), credibility)


def to_gold(
    silver: DataFrame,
    lexicon: DataFrame,
    credibility: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
    as_of: Column | None = None,
) -> DataFrame:
    """Features and split of the rows with a known class; no shuffle with a small word list."""
    now = F.current_timestamp() if as_of is None else as_of
    return (
        with_features(known_labels(silver), lexicon, credibility)
        .withColumn("split", hash_split(F.col("id")))
        .withColumn("featurized_at", now)
        .select(*GOLD.names)
    )


def refresh_gold(
    spark: SparkSession,
    silver_path: str,
    gold_path: str,
    lexicon: DataFrame,
    credibility: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
    as_of: Column | None = None,
    full: bool = False,
) -> dict[int, int]:
    """Bring the gold table up to date and return its rows per class.

    Only files of silver that gold has not taken yet are read, and only rows that it does not have
    get features and are appended, unless ``full`` asks for all, as after a change of the word list
    or the credibilities. Rows per class are counted once per file of gold.
    """
    silver = read_table(spark, silver_path, SILVER)
    if silver is None:
        raise FileNotFoundError(silver_path)
    known = None if full else read_table(spark, gold_path, GOLD)
    if known is None:
        files = table_files(silver)
        gold = to_gold(silver, lexicon, credibility, as_of)
        # The split is a function of the id, and the source is in the key.
        upsert(gold, gold_path, GOLD, partition_by=GOLD_PARTITIONS, partitions_follow_key=True)
        note_files(spark, gold_path, files, anew=True)
    elif files := new_files(spark, silver, gold_path):
        delivered = known_labels(rows_of(spark, silver, silver_path, SILVER, files))
        held = known.where(listed(delivered, SILVER_PARTITIONS))
        gold = to_gold(unmatched(delivered, held), lexicon, credibility, as_of)
        append(gold, gold_path, GOLD, GOLD_PARTITIONS)
        note_files(spark, gold_path, files)
    return class_counts(spark, gold_path)


COUNTED = "__counted"
_COUNT = T.StructType().add("file", "string").add("label_binary", "integer").add("n_rows", "long")


def class_counts(spark: SparkSession, gold_path: str) -> dict[int, int]:
    """Rows per class of the gold table.

    Counts are kept per file, beside the table; files without them are read, and of the others
    nothing. Files that are gone do not count.
    """
    gold = read_table(spark, gold_path, GOLD)
    kept = f"{gold_path}{COUNTED}"
    counts = []
    if folder_at(spark, gold_path).exists(COUNTED):
        counts = spark.read.schema(_COUNT).parquet(kept).collect()
    places = {place(f): f for f in table_files(gold)}
    known = {r.file for r in counts}
    found = [r for r in counts if r.file in places]
    if missing := [f for p, f in places.items() if p not in known]:
        rows = rows_of(spark, gold, gold_path, GOLD, missing)
        new = rows.groupBy(F.col("_metadata.file_path").alias("file"), "label_binary").agg(
            F.count("*").alias("n_rows")
        ).collect()
        new = [Row(file=place(unquote(r.file)), label_binary=r.label_binary, n_rows=r.n_rows) for r in new]
        found += new
        if len(found) - len(new) < len(counts):
            discard(spark, kept)
            new = found
        spark.createDataFrame(new, _COUNT).coalesce(1).write.mode("append").parquet(kept)
    totals: dict[int, int] = {}
    for row in {(r.file, r.label_binary): r for r in found}.values():
        totals[row.label_binary] = totals.get(row.label_binary, 0) + row.n_rows
    return dict(sorted(totals.items()))

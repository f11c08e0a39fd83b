"""One row per group, whole rows kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..constants import KEYS
from ..functions.text import text_digest
from ..session import scratch_path


def first_of_group(
    df: DataFrame, by: Sequence[Column | str], order: Sequence[Column | str]
) -> DataFrame:
    """The first row of each group in the given order.

    Spark runs a group limit before the shuffle, so a group of any size leaves each map task
    as one row.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def distinct_texts(df: DataFrame) -> DataFrame:
    """One row per ``(text, source)``: the earliest ingested, ties by id.

    Texts are told apart by their digests: no sort compares texts, and the rows go through one
    shuffle. NULL texts form a group like any other.
    """
    return first_of_group(df, [text_digest(F.col("text")), "source"], ["ingested_at", "id"])


def distinct_texts_in_place(df: DataFrame) -> DataFrame:
    """What :func:`distinct_texts` keeps, without a shuffle of the rows whose text occurs once.

    Digests that occur twice in a source are counted first and written to the scratch folder; they
    go to the rows if they are few.
    """
    spark = df.sparkSession
    # One struct as key, because NULLs have to meet as well.
    key = F.struct(text_digest(F.col("text")).alias("digest"), "source").alias("_key")
    counts = df.select(key).groupBy("_key").agg(F.count(F.lit(1)).alias("_times"))
    path = scratch_path(spark, "copies")
    counts.where("_times > 1").select("_key").write.parquet(path)
    copied = spark.read.schema(counts.select("_key").schema).parquet(path)
    if copied.isEmpty():
        return df
    keyed = df.withColumn("_key", key)
    once = keyed.join(copied, "_key", "left_anti").select(*df.columns)
    several = keyed.join(copied, "_key", "left_semi").select(*df.columns)
    return once.unionByName(distinct_texts(several))


def unique_keys(
    df: DataFrame, keys: Sequence[str] = KEYS, order: Sequence[Column | str] | None = None
) -> DataFrame:
    """One row per key, so that a batch can be merged; by default the smallest other values."""
    return first_of_group(df, keys, order or [c for c in df.columns if c not in keys])


def dedup_counts(df: DataFrame) -> DataFrame:
    """Rows before and after :func:`distinct_texts` and rows dropped, in one pass.

    Texts enter the shuffle as 32-byte digests, combined per map task.
    """
    groups = df.groupBy(
        text_digest(F.col("text")).alias("digest"), "source"
    ).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_before"),
        F.count(F.lit(1)).alias("rows_after"),
    ).withColumn("rows_dropped", F.col("rows_before") - F.col("rows_after"))

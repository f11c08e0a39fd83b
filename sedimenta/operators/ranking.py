"""Row numbers and the best rows of a group, without a task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..constants import SEARCH_TERMS
from ..session import scratch_path

# Ways a hot group is spread over before its final ranking.
SPREAD = 64


def file_row_index(
    df: DataFrame,
    by: Sequence[str],
    file_order: Column,
    position: str,
    name: str,
    counts_path: str | None = None,
) -> DataFrame:
    """0-based index of each row in its group, over files read in ``file_order``.

    ``position`` is the row's place in its file. The rows of one group must lie next to each
    other in a file, as they do when a file holds one group or is sorted by it. Only counts
    per file and group are shuffled. With ``counts_path`` they are written there, so that Spark
    knows how few they are and leaves wide rows where they are.
    """
    # One struct as key, because rows of a NULL group have to find their counts as well.
    placed = df.withColumn("_place", F.struct(*by, file_order.alias("_file")))
    spans = placed.groupBy("_place").agg(
        F.min(position).alias("_first"), F.count(F.lit(1)).alias("_n")
    )
    group = Window.partitionBy(*[F.col("_place")[c] for c in by]).orderBy("_place._file")
    earlier = F.sum("_n").over(group.rowsBetween(Window.unboundedPreceding, -1))
    shifts = spans.select(
        "_place", (F.coalesce(earlier, F.lit(0)) - F.col("_first")).alias("_shift")
    )
    if counts_path is not None:
        shifts.write.parquet(counts_path)
        shifts = df.sparkSession.read.schema(shifts.schema).parquet(counts_path)
    indexed = placed.join(shifts, "_place")
    return indexed.withColumn(name, F.col(position) + F.col("_shift")).drop("_place", "_shift")


def row_index(
    df: DataFrame, by: Sequence[str], order: Sequence[str], name: str = "row_index"
) -> DataFrame:
    """0-based index of each row in its group, by ``order``, which must be unique in a group.

    Only these columns are range-sorted, so a group of any size spreads over many tasks, and
    written to the scratch folder; the index follows from the place in the written files, and all
    rows get theirs in a join on the columns, which has no hot keys. Rows that are equal in them
    are numbered in any order.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "sorted")
    keys = [*by, *order]
    df.select(*keys).repartitionByRange(*keys).sortWithinPartitions(*keys).write.parquet(path)
    written = spark.read.schema(df.select(*keys).schema).parquet(path).select(
        "*",
        F.col("_metadata.file_name").alias("_name"),
        F.col("_metadata.row_index").alias("_position"),
    )
    # Files are numbered by range; the number is not zero-padded beyond five digits.
    number = F.regexp_extract("_name", r"^part-(\d+)", 1).cast("long")
    file_order = F.struct(number.alias("number"), F.col("_name").alias("name"))
    indexed = file_row_index(written, by, file_order, "_position", name)
    if set(df.columns) == set(keys):
        return indexed.drop("_name", "_position")
    # One struct as key, because NULLs have to meet as well.
    key = F.struct(*keys).alias("_key")
    firsts = indexed.groupBy(key).agg(F.min(name).alias("_first"))
    nth = F.row_number().over(Window.partitionBy("_key").orderBy(*order)) - 1
    rows = df.withColumn("_key", key).withColumn("_nth", nth)
    found = rows.join(firsts, "_key").withColumn(name, F.col("_first") + F.col("_nth"))
    return found.drop("_key", "_first", "_nth")


def top_per_group(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int, spread_by: str
) -> DataFrame:
    """The first ``limit`` rows of each group.

    Ranked twice: a hot group is first cut down in ``SPREAD`` parts (each map task having
    already cut its own), so the task that ranks the whole group gets a bounded number of rows.
    """
    part = F.pmod(F.hash(spread_by), F.lit(SPREAD))
    for keys in ([*by, part], list(by)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        df = df.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")
    return df


def posts_per_term(limit: int, n_terms: int = len(SEARCH_TERMS)) -> int:
    """How many posts one search term may bring when ``limit`` are wanted in total."""
    return max(1, limit // n_terms)


def cap_per_term(posts: DataFrame, limit: int, n_terms: int = len(SEARCH_TERMS)) -> DataFrame:
    """The newest posts of each search term, as many as :func:`posts_per_term` allows."""
    order = [F.desc("indexed_at"), F.col("uri")]
    return top_per_group(posts, ["query"], order, posts_per_term(limit, n_terms), "uri")

"""Labeled data sets that come as one folder of files per split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import HEADLINE_SOURCE, STATEMENT_SOURCE
from ..functions.records import column_or, first_present, name_at
from ..operators.ranking import file_row_index, row_index
from ..session import scratch_path
from .records import raw_records, union_records


def read_splits(
    spark: SparkSession,
    paths: dict[str, str],
    format: str = "parquet",
    schema: T.StructType | None = None,
    **options: str,
) -> DataFrame:
    """The files of all splits with the split's name in ``split``; files must be there."""
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    parts = [reader.load(path).withColumn("split", F.lit(s)) for s, path in paths.items()]
    return union_records(parts)


def read_indexed_splits(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Parquet splits with ``row_index``, each row's place in its split, files by name.

    The place comes from the files themselves; no row is sorted or shuffled for it.
    """
    parts = [
        spark.read.parquet(path).select(
            "*",
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.row_index").alias("_position"),
            F.lit(split).alias("split"),
        )
        for split, path in paths.items()
    ]
    rows = union_records(parts)
    indexed = file_row_index(
        rows, ["split"], F.col("_path"), "_position", "row_index", scratch_path(spark, "counts")
    )
    return indexed.drop("_path", "_position")


def statement_records(df: DataFrame, label_names: Sequence[str]) -> DataFrame:
    """Statements with a class number; everything but id, text and label goes to the metadata."""
    meta = [F.col(c) for c in df.columns if c not in ("id", "statement", "label")]
    label = name_at(F.col("label"), label_names)
    return raw_records(df, F.col("id"), F.col("statement"), label, STATEMENT_SOURCE, meta)


def headline_records(df: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Headlines without an id of their own: the id is split and place in the split.

    The place is ``row_index`` if the table has it, else it follows from ``order``.
    """
    if "row_index" not in df.columns:
        if not order:
            raise ValueError("headlines need a row_index or columns that order them")
        df = row_index(df, ["split"], order)
    meta = [
        column_or(df, "news_url", "").alias("news_url"),
        column_or(df, "source_domain", "").alias("source_domain"),
        column_or(df, "tweet_num", 0).alias("tweet_num"),
        F.col("split"),
    ]
    label = F.when(column_or(df, "real", None) == 1, "real").otherwise("fake")
    key = F.concat_ws("_", "split", "row_index")
    return raw_records(df, key, first_present(df, "title"), label, HEADLINE_SOURCE, meta)

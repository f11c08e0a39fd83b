"""Training files: two columns of one split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import TRAIN, VAL
from ..schemas import EXPORT


def split_rows(gold: DataFrame, split: str) -> DataFrame:
    """Cleaned text and class of one split; the split is a partition, so others are not read."""
    return gold.where(F.col("split") == split).select(*EXPORT.names)


def export_splits(gold: DataFrame, folder: str) -> tuple[str, str]:
    """Write the train and val rows as Parquet directories and return their paths."""
    paths = []
    for split in (TRAIN, VAL):
        paths.append(f"{folder}/{split}.parquet")
        split_rows(gold, split).write.mode("overwrite").parquet(paths[-1])
    return paths[0], paths[1]


def read_export(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(EXPORT).parquet(path)


def training_rows(export: DataFrame) -> DataFrame:
    """An export with its class column named ``labels``, as trainers expect it."""
    return export.withColumnRenamed("label_binary", "labels")

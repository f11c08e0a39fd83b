"""What the corpus operators share: reading tables, row keys, steps written to the scratch folder."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, scratch_path

RELEASE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let executors import this package, whatever their path is; once per application.

    Spark's file server sends the archive, so it need not be on a shared folder.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        package = Path(__file__).resolve().parent.parent
        target = Path(tempfile.mkdtemp(prefix="code-")) / package.name
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


@contextmanager
def released_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the queries run inside go when each query ends.

    A step that has been written to the scratch folder no longer needs them.
    """
    before = spark.conf.get(RELEASE_SHUFFLES, None)
    spark.conf.set(RELEASE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(RELEASE_SHUFFLES)
        else:
            spark.conf.set(RELEASE_SHUFFLES, before)


class Step:
    """A frame written to the shared scratch folder, which cuts its lineage."""

    def __init__(self, df: DataFrame, name: str) -> None:
        spark = df.sparkSession
        self._spark, self._path = spark, scratch_path(spark, name)
        with released_shuffles(spark):
            df.write.option("compression", "zstd").parquet(self._path)
        self.df = spark.read.schema(df.schema).parquet(self._path)

    def drop(self) -> None:
        """Remove the files; only when no frame that reads them is still to be computed."""
        discard(self._spark, self._path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def empty_if_null(name: str):
    return F.coalesce(F.col(name), F.lit(""))

"""Which files of a table a later layer has taken already.

Files of a table are never changed, only added, or replaced by others under new names. So a layer
that notes the files it has taken needs to read no old row to find the new ones. The notes are a
table of their own beside the layer, ``<layer>__taken``, with a row per file: as long as the list of
files that the driver holds for any scan of the table. They are written after the layer, so a job
that is lost in between takes some files twice, which the layer has to stand.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..session import discard, folder_at

TAKEN = "__taken"
_NOTE = T.StructType([T.StructField("file", T.StringType())])


def table_files(table: DataFrame) -> set[str]:
    """The files of a table as read."""
    return {unquote(f) for f in table.inputFiles()}


def taken_files(spark: SparkSession, layer: str) -> set[str]:
    """Files noted for the layer, by their paths without scheme and host."""
    if not folder_at(spark, layer).exists(TAKEN):
        return set()
    return {r.file for r in spark.read.schema(_NOTE).parquet(layer + TAKEN).collect()}


def place(file: str) -> str:
    """A path without scheme and host, which differ with the way a table is named."""
    found = urlparse(file)
    return found.path if found.scheme else file


def new_files(spark: SparkSession, table: DataFrame, layer: str) -> list[str]:
    """Files of the table that are not noted for the layer."""
    taken = taken_files(spark, layer)
    return sorted(f for f in table_files(table) if place(f) not in taken)


def note_files(spark: SparkSession, layer: str, files: Iterable[str], anew: bool = False) -> None:
    """Note that the layer has taken the files; ``anew``: these and no others."""
    if anew:
        discard(spark, layer + TAKEN)
    rows = [(place(f),) for f in files]
    if rows:
        spark.createDataFrame(rows, _NOTE).coalesce(1).write.mode("append").parquet(layer + TAKEN)


def rows_of(
    spark: SparkSession, table: DataFrame, path: str, schema: T.StructType, files: list[str]
) -> DataFrame:
    """The rows of some files of a table; the table itself if they are all it has."""
    if len(files) == len(table.inputFiles()):
        return table
    return spark.read.schema(schema).option("basePath", path).parquet(*files)

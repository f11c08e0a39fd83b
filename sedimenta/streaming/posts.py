"""Landed posts into the bronze table with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.bronze import ingest_landed
from ..sources.posts import LANDED, READ_OPTIONS


def stream_posts(
    spark: SparkSession,
    landing: str,
    bronze_path: str,
    checkpoint: str,
    as_of: Column | None = None,
    max_files: int = 1_000,
    quarantine: str | None = None,
) -> StreamingQuery:
    """Start ingesting all files landed so far, in batches, and stop after the last.

    A batch that runs again after a failure finds its keys in the table and adds nothing, so
    there is no state to keep and no watermark. A file that cannot be read fails the stream, and
    its batch is tried again by the next one; broken lines go to ``quarantine``.
    """
    posts = (
        spark.readStream.schema(LANDED)
        .options(**READ_OPTIONS, maxFilesPerTrigger=str(max_files))
        .json(landing)
        .withColumn("file", F.col("_metadata.file_path"))
    )

    def land(batch: DataFrame, _: int) -> None:
        ingest_landed(batch, bronze_path, None, as_of, quarantine)

    return (
        posts.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

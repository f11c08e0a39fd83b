"""Raw records into the bronze table: inserted once, never changed."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import insert_new
from ..operators.ranking import cap_per_term
from ..schemas import BRONZE, BRONZE_PARTITIONS, QUARANTINE, QUARANTINE_KEYS
from ..session import discard, scratch_path
from ..sources.posts import broken_lines, post_records, read_landed, whole_lines
from ..sources.records import stamped, union_records

log = logging.getLogger(__name__)


def ingest_records(parts: Sequence[DataFrame], path: str, as_of: Column | None = None) -> None:
    """Insert the rows of all parts whose key is new. A part that fails fails the job."""
    records = stamped(union_records(parts), as_of)
    insert_new(records, path, BRONZE, partition_by=BRONZE_PARTITIONS)


def ingest_landed(
    landed: DataFrame,
    path: str,
    limit: int | None = None,
    as_of: Column | None = None,
    quarantine: str | None = None,
) -> None:
    """Insert the posts of landed lines; broken lines are counted and go to ``quarantine``.

    The lines are parsed once, into the scratch folder. Both tables take only what they do not
    have: a batch that is tried again adds nothing twice. In the quarantine a line stands once per
    file, with the ``times`` it occurs there.
    """
    spark = landed.sparkSession
    staged_path = scratch_path(spark, "landed")
    try:
        landed.write.parquet(staged_path)
        staged = spark.read.schema(landed.schema).parquet(staged_path)
        broken = broken_lines(staged).groupBy("file", "line").agg(
            F.min("uri").alias("uri"), F.count("*").alias("times")
        )
        n_broken = broken.agg(F.sum("times")).head()[0]
        if n_broken:
            log.warning("%d landed lines are no JSON", n_broken)
            if quarantine is not None:
                insert_new(broken, quarantine, QUARANTINE, QUARANTINE_KEYS)
        posts = whole_lines(staged)
        if limit is not None:
            posts = cap_per_term(posts, limit)
        ingest_records([post_records(posts)], path, as_of)
    finally:
        discard(spark, staged_path)


def ingest_posts(
    spark: SparkSession,
    landing: str | Mapping[str, str],
    path: str,
    limit: int | None = None,
    as_of: Column | None = None,
    quarantine: str | None = None,
) -> list[str]:
    """Insert landed posts; no posts, no table.

    ``landing`` is a folder, or a folder for each search term. A term whose files cannot be read
    is left out with a warning and the others go on; the terms left out are returned. All posts
    are taken unless ``limit`` says how many, shared evenly by the terms of the posts.
    """
    failed = []
    for term, folder in ({"": landing} if isinstance(landing, str) else landing).items():
        try:
            ingest_landed(read_landed(spark, folder), path, limit, as_of, quarantine)
        except Exception:
            if isinstance(landing, str):
                raise
            log.warning("posts of %r in %s were not ingested", term, folder, exc_info=True)
            failed.append(term)
    return failed

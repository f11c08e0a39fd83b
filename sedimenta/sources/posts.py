"""Landed posts of a social feed: nested JSON, one post per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import POST_SOURCE
from ..schemas import POSTS
from .records import raw_records

# A line that cannot be read as a post is kept as it is in this column. A file that cannot be read
# to its end fails the job.
BROKEN = "_broken_line"
READ_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN}
LANDED = T.StructType([*POSTS.fields, T.StructField(BROKEN, T.StringType())])


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """All lines, broken ones too, with the file each is from."""
    lines = spark.read.schema(LANDED).options(**READ_OPTIONS).json(path)
    return lines.withColumn("file", F.col("_metadata.file_path"))


def _is_broken() -> Column:
    """A line that is no JSON; one that is, but for a field of another type, lacks that field."""
    return F.col(BROKEN).isNotNull() & F.try_parse_json(BROKEN).isNull()


def whole_lines(landed: DataFrame) -> DataFrame:
    return landed.where(~_is_broken()).select(*POSTS.names)


def broken_lines(landed: DataFrame) -> DataFrame:
    """(file, uri, line) of the lines that are no JSON, with what could be read of the uri."""
    return landed.where(_is_broken()).select("file", "uri", F.col(BROKEN).alias("line"))


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    return whole_lines(read_landed(spark, path))


def with_uri(posts: DataFrame) -> DataFrame:
    return posts.where(F.coalesce("uri", F.lit("")) != "")


def post_records(posts: DataFrame) -> DataFrame:
    """Posts as raw records without a known label; the post's uri is its id."""

    def field(path: str, default: object, name: str) -> Column:
        return F.coalesce(F.col(path), F.lit(default)).alias(name)

    meta = [
        field("cid", "", "cid"),
        field("author.did", "", "author_did"),
        field("author.handle", "", "author_handle"),
        field("indexed_at", "", "indexed_at"),
        field("reply_count", 0, "reply_count"),
        field("repost_count", 0, "repost_count"),
        field("like_count", 0, "like_count"),
        F.col("query"),
    ]
    return raw_records(
        with_uri(posts), F.col("uri"), F.col("record.text"), F.lit("unknown"), POST_SOURCE, meta
    )

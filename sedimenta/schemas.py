"""Column layouts of the layer tables and of the landed inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_STRING, _INT, _LONG = T.StringType(), T.IntegerType(), T.LongType()
_FLOAT, _DOUBLE, _TIME = T.FloatType(), T.DoubleType(), T.TimestampType()


def _layout(*columns: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns])


BRONZE = T.StructType(
    [
        T.StructField("id", _STRING, nullable=False),
        T.StructField("text", _STRING),
        T.StructField("label", _STRING),
        T.StructField("source", _STRING, nullable=False),
        T.StructField("raw_meta", _STRING),
        T.StructField("ingested_at", _TIME),
    ]
)

BRONZE_PARTITIONS = ["source"]

SILVER = _layout(
    ("id", _STRING),
    ("text", _STRING),
    ("text_clean", _STRING),
    ("label", _STRING),
    ("label_binary", _INT),
    ("source", _STRING),
    ("word_count", _INT),
    ("char_count", _INT),
    ("ingested_at", _TIME),
    ("processed_at", _TIME),
    ("raw_meta", _STRING),
)
SILVER_PARTITIONS = ["source"]

# As it lies in files: with a digest of the text, so that no later run has to read old texts.
TEXT_DIGEST = "text_digest"
SILVER_STORED = T.StructType([*SILVER.fields, T.StructField(TEXT_DIGEST, T.BinaryType())])

GOLD = _layout(
    ("id", _STRING),
    ("text_clean", _STRING),
    ("label_binary", _INT),
    ("source", _STRING),
    ("word_count", _INT),
    ("char_count", _INT),
    ("sentiment_score", _FLOAT),
    ("exclamation_ratio", _DOUBLE),
    ("caps_ratio", _DOUBLE),
    ("avg_word_length", _DOUBLE),
    ("source_credibility", _FLOAT),
    ("split", _STRING),
    ("ingested_at", _TIME),
    ("processed_at", _TIME),
    ("featurized_at", _TIME),
)
GOLD_PARTITIONS = ["source", "split"]

EXPORT = _layout(("text_clean", _STRING), ("label_binary", _INT))

POSTS = _layout(
    ("uri", _STRING),
    ("cid", _STRING),
    ("indexed_at", _STRING),
    ("record", _layout(("text", _STRING))),
    ("author", _layout(("did", _STRING), ("handle", _STRING))),
    ("reply_count", _LONG),
    ("repost_count", _LONG),
    ("like_count", _LONG),
    ("query", _STRING),
)

# Landed lines that are no JSON, with what could be read of the uri.
QUARANTINE = _layout(("file", _STRING), ("uri", _STRING), ("line", _STRING), ("times", _LONG))
QUARANTINE_KEYS = ["file", "line"]

LEXICON = _layout(("word", _STRING), ("polarity", _DOUBLE), ("kind", _STRING))

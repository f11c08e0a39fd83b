"""Sentiment of cleaned text from a word list.

The list has one row per word: ``polar`` words carry a polarity, ``negator`` words turn the
next word round at half strength, ``intensifier`` words multiply the next word by their
polarity. A polar word scores its polarity times what the word before it asks for, within
[-1, 1]; a text scores the mean of its polar words, 0.0 without any.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..session import scratch_path
from .joins import require_unique

# Word lists up to this size become part of the expression; the scores are the same beyond.
MAX_INLINE_WORDS = 10_000

NEGATION = -0.5
DECIMALS = 6


def tokens(text: Column) -> Column:
    """Words of lower-case text, in order: runs of a-z and apostrophe."""
    return F.regexp_extract_all(text, F.lit("[a-z']+"), 0)


def with_sentiment(
    df: DataFrame,
    lexicon: DataFrame,
    text: str = "text_clean",
    max_inline_words: int = MAX_INLINE_WORDS,
) -> DataFrame:
    """Add ``sentiment_score``, which depends on the text alone. NULL text scores 0.0.

    A word may be listed once only. A word list of checked size is looked up inside each row,
    without any shuffle; a larger one is joined word by word, and the mean comes back by a digest
    of the text.
    """
    require_unique(lexicon, "word")
    words = lexicon.select(
        "word",
        F.when(F.col("kind") == "polar", F.col("polarity")).alias("polarity"),
        F.when(F.col("kind") == "negator", NEGATION)
        .when(F.col("kind") == "intensifier", F.col("polarity"))
        .otherwise(1.0)
        .alias("factor"),
    )
    split = df.withColumn("_words", tokens(F.col(text)))
    rows = words.withColumn("hash", F.hash("word")).limit(max_inline_words + 1).collect()
    if len(rows) <= max_inline_words:
        return _inline_score(split, rows).drop("_words")
    return _joined_score(split, words, F.col(text)).drop("_words")


def _limit(score: Column) -> Column:
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), score))


def _as_score(mean: Column) -> Column:
    return F.coalesce(F.round(mean, DECIMALS), F.lit(0.0)).cast("float")


def _inline_score(df: DataFrame, rows: list[Row]) -> DataFrame:
    """Scores from the polar words of each row; most words fail one hash set test and go."""
    polar = [row.word for row in rows if row.polarity is not None]
    if not polar:
        return df.withColumn("sentiment_score", F.lit(0.0).cast("float"))
    # One constant for the whole list: small maps in an array, indexed by the word's hash,
    # because Spark searches a single map entry by entry.
    buckets: list[dict] = [{} for _ in rows]
    for row in rows:
        entry = {"polarity": row.polarity, "factor": row.factor}
        buckets[row.hash % len(rows)][row.word] = entry
    table = F.from_json(
        F.lit(json.dumps(buckets)),
        "array<map<string, struct<polarity: double, factor: double>>>",
    )

    def entry_of(word: Column) -> Column:
        return F.element_at(F.get(table, F.pmod(F.hash(word), F.lit(len(rows)))), word)

    def word_at(position: Column) -> Column:
        return F.coalesce(F.get("_words", position), F.lit(""))

    def add(total: Column, position: Column) -> Column:
        factor = F.coalesce(entry_of(word_at(position - 1))["factor"], F.lit(1.0))
        return total + _limit(entry_of(word_at(position))["polarity"] * factor)

    # As SQL text: thousands of literals made one by one in Python take seconds.
    listed = ", ".join(_sql_string(word) for word in polar)
    found = df.withColumn(
        "_found",
        F.expr(f"array_compact(transform(_words, (w, i) -> if(w IN ({listed}), i, NULL)))"),
    )
    mean = F.when(
        F.size("_found") > 0, F.aggregate("_found", F.lit(0.0), add) / F.size("_found")
    )
    return found.withColumn("sentiment_score", _as_score(mean)).drop("_found")


def _sql_string(word: str) -> str:
    return "'" + word.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _joined_score(df: DataFrame, words: DataFrame, text: Column) -> DataFrame:
    """Scores by joining each word with the list, and the mean back to all rows of the text.

    Copies of a text add the same pairs again, which leaves their mean as it is. A frequent word
    is a hot key of the join, which adaptive execution splits. The list is written to the scratch
    folder, so that Spark knows its size and sends one that is small enough to the words.
    """
    columns = df.columns
    path = scratch_path(df.sparkSession, "words")
    words.write.parquet(path)
    words = df.sparkSession.read.schema(words.schema).parquet(path)
    df = df.withColumn("_digest", F.unhex(F.sha2(text, 256)))
    shifted = F.concat(F.array(F.lit("")), "_words")
    pairs = df.select(
        "_digest",
        F.inline(F.arrays_zip(F.col("_words").alias("word"), shifted.alias("before"))),
    )
    polar = words.where("polarity is not null").select("word", "polarity")
    factors = words.where("factor <> 1.0").select(F.col("word").alias("before"), "factor")
    scored = pairs.join(polar, "word").join(factors, "before", "left")
    score = _limit(F.col("polarity") * F.coalesce("factor", F.lit(1.0)))
    means = scored.groupBy("_digest").agg(F.avg(score).alias("_mean"))
    joined = df.join(means, "_digest", "left")
    return joined.select(*columns, _as_score(F.col("_mean")).alias("sentiment_score"))

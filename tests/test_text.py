"""Hand-checked values of the column functions."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from sedimenta.functions.records import argmax, as_json, class_name, hash_split, name_at
from sedimenta.functions.text import (
    caps_ratio,
    clean,
    exclamation_ratio,
    has_text,
    label_class,
    ratio,
    valid_for_scoring,
    word_count,
)
from sedimenta.operators.joins import credibility, with_credibility

LABELS = {
    "true": 0, "mostly-true": 0, "half-true": 0, "real": 0,
    "false": 1, "pants-fire": 1, "barely-true": 1, "fake": 1,
    "unknown": -1, "unlabeled": -1, "": -1, None: -1,
    " TRUE ": 0, "Pants-Fire\n": 1, "\x1ffake\x1c": 1, " real　": 0, "tr ue": -1,
}


def column(spark, values, kind="string"):
    return spark.createDataFrame([(n, v) for n, v in enumerate(values)], f"n int, v {kind}")


def results(df, expression):
    return [row[1] for row in df.select("n", expression).orderBy("n").collect()]


def test_label_class(spark):
    assert results(column(spark, LABELS), label_class(F.col("v"))) == list(LABELS.values())


TEXTS = [
    # text, kept, cleaned, words, characters, share of capitals
    ("Hello <b>World</b>!!", True, "hello world!!", 2, 13, 0.1),
    ("\t", True, "", 1, 0, 0.0),
    ("<p></p>", True, "", 1, 0, 0.0),
    ("x y  z", True, "x y z", 2, 5, 0.0),
    ("a<b and c>d ÀB", True, "ad àb", 2, 5, 1 / 14),
    (None, False, None, None, None, 0.0),
    ("  ", False, "", 1, 0, 0.0),
    ("İX", True, "i̇x", 1, 3, 0.5),
    (" <a href=x>A</a> \n B ", True, "a b", 2, 3, 2 / 21),
    ("line\x0bone\r\n\f<i\n>two", True, "line one two", 3, 12, 0.0),
]


def test_cleaning_and_counting(spark):
    df = column(spark, [row[0] for row in TEXTS])
    cleaned = clean(F.col("v"))
    assert results(df, F.coalesce(has_text(F.col("v")), F.lit(False))) == [r[1] for r in TEXTS]
    assert results(df, cleaned) == [r[2] for r in TEXTS]
    assert results(df, word_count(cleaned)) == [r[3] for r in TEXTS]
    assert results(df, F.length(cleaned)) == [r[4] for r in TEXTS]
    assert results(df, caps_ratio(F.col("v"))) == pytest.approx([r[5] for r in TEXTS])


def test_word_count_is_what_splitting_gives(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    cleaned = df.select(clean(F.col("html")).alias("c"))
    split = F.size(F.split("c", r"\s+"))
    assert cleaned.where(word_count(F.col("c")) != split).count() == 0


def test_single_spaces_are_not_replaced(spark):
    """Only runs that change are matched, and folding gives what folding every run gives."""
    from sedimenta.constants import SPACE_PATTERN
    from sedimenta.functions.text import FOLDED_SPACE

    gaps = [" ", "  ", "\t", "\n", " \r\n", "\x0b ", "\f\f", "\u00a0", "\u2003 ", " \x1c ", ""]
    made = [a + "x" + b + "\u00e9" + c for a in gaps for b in gaps for c in gaps]
    df = column(spark, made)
    folded = [F.regexp_replace("v", p, " ") for p in (SPACE_PATTERN, FOLDED_SPACE)]
    assert df.where(folded[0] != folded[1]).count() == 0
    # How often the pattern that cleaning uses matches.
    (pattern,) = column(spark, ["a b c d"]).select(F.regexp_count("v", F.lit(FOLDED_SPACE))).head()
    assert pattern == 0


def test_exclamation_ratio(spark):
    df = column(spark, ["a!b!", "", "none", None])
    assert results(df, exclamation_ratio(F.col("v"), F.length("v"))) == [0.5, 0.0, 0.0, 0.0]


def test_ratio_is_zero_where_it_is_undefined(spark):
    df = spark.createDataFrame([(10, 4), (5, 0), (0, 5), (0, 0), (1, None)], "a int, b int")
    found = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert found == [2.5, 0.0, 0.0, 0.0, 0.0]


SOURCES = {"liar": 0.7, "fakenewsnet": 0.6, "bluesky": 0.3, "other": 0.5, "": 0.5, None: 0.5,
           "LIAR": 0.5}


def test_credibility_from_a_map(spark):
    df = column(spark, SOURCES)
    assert results(df, credibility(F.col("v"))) == pytest.approx(list(SOURCES.values()))
    assert results(df, credibility(F.col("v"), {})) == [0.5] * len(SOURCES)


def test_credibility_from_a_large_map(spark, plan):
    """A map of many sources is joined as a table, with the same scores."""
    rows = column(spark, SOURCES).withColumnRenamed("v", "source")
    known = {str(n): 0.1 for n in range(5000)} | {"liar": 0.7, "fakenewsnet": 0.6, "bluesky": 0.3}
    joined = with_credibility(rows, known)
    assert "Join" in plan(joined)
    found = {r.source: r.source_credibility for r in joined.collect()}
    assert found == pytest.approx(SOURCES)


def test_credibility_from_a_table(spark):
    rows = column(spark, SOURCES).withColumnRenamed("v", "source")
    table = spark.createDataFrame(
        [("liar", 0.7), ("fakenewsnet", 0.6), ("bluesky", 0.3)], "source string, credibility double"
    )
    found = with_credibility(rows, table).orderBy("n").collect()
    assert [r.source_credibility for r in found] == pytest.approx(list(SOURCES.values()))
    assert dict(with_credibility(rows, table).dtypes)["source_credibility"] == "float"


def test_hash_split(spark):
    df = column(spark, ["a", "b", "c", "e", "i"])
    assert results(df, hash_split(F.col("v"))) == ["train", "train", "train", "val", "test"]


def test_hash_split_hashes_the_id_as_string(spark):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    counts = documents.groupBy(hash_split(F.col("doc_id")).alias("s")).count().collect()
    assert {r.s: r["count"] for r in counts} == {"train": 815, "val": 102, "test": 83}


def test_valid_for_scoring(spark):
    df = column(spark, ["short", "x" * 10, "x" * 2000, "x" * 2001, None, "é" * 2000])
    expected = [False, True, True, False, False, True]
    assert results(df, valid_for_scoring(F.col("v"))) == expected


def test_json_keeps_nulls_and_nesting(spark):
    df = spark.range(1).select(
        F.lit("x").alias("a"), F.lit(None).cast("int").alias("b"),
        F.struct(F.lit(1).alias("c")).alias("d"), F.array(F.lit(1), F.lit(2)).alias("e"),
    )
    row = df.select(as_json([F.col(c) for c in df.columns]), as_json([])).head()
    assert json.loads(row[0]) == {"a": "x", "b": None, "d": {"c": 1}, "e": [1, 2]}
    assert json.loads(row[1]) == {}


def test_argmax_takes_the_first_maximum(spark):
    nan = float("nan")
    df = column(spark, [[0.1, 0.9], [2.0, 2.0], [1.0, nan, nan], [-1.0]], "array<double>")
    assert results(df, argmax(F.col("v"))) == [1, 0, 1, 0]


def test_class_name(spark):
    df = column(spark, [0, 1, 2, -1, None], "int")
    assert results(df, class_name(F.col("v"))) == [
        "credible", "misinformation", "unknown", "unknown", "unknown"
    ]


def test_name_at(spark):
    df = column(spark, [0, 2, -1, None], "int")
    assert results(df, name_at(F.col("v"), ["a", "b", "c"])) == ["a", "c", "c", None]
    with pytest.raises(Exception, match="INVALID_ARRAY_INDEX"):
        column(spark, [3], "int").select(name_at(F.col("v"), ["a", "b", "c"])).collect()

"""Counts, classification metrics, choice and gate."""

from __future__ import annotations

import random

import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sedimenta.functions.records import argmax
from sedimenta.operators.metrics import (
    best_model,
    class_distribution,
    classification_metrics,
    confusion_matrix,
    layer_status,
    quality_gate,
    source_counts,
    split_counts,
)
from sedimenta.schemas import EXPORT

MIXED = [(0, 0), (0, 1), (0, 0), (0, 0), (1, 1), (1, 0), (1, 1), (0, 0), (1, 1)]


def pairs(spark, rows):
    return spark.createDataFrame(rows, "label int, prediction int")


@pytest.mark.parametrize(
    ("rows", "f1", "accuracy", "precision", "recall"),
    [
        ([(0, 0), (0, 0), (1, 1)], 1, 1, 1, 1),
        ([(0, 1)] * 4, 0, 0, 0, 0),
        # Five of class 0, four of them hit by five guesses; four of class 1, three of four.
        (MIXED, (5 * 0.8 + 4 * 0.75) / 9, 7 / 9, (5 * 0.8 + 4 * 0.75) / 9, 7 / 9),
    ],
)
def test_known_cases(spark, rows, f1, accuracy, precision, recall):
    row = classification_metrics(pairs(spark, rows)).head()
    assert (row.f1, row.accuracy, row.precision, row.recall) == pytest.approx(
        (f1, accuracy, precision, recall)
    )
    assert row.n_rows == len(rows)


def test_metrics_from_scores(spark):
    scores = [([0.2, 0.7][:: 1 - 2 * (1 - guess)], label) for label, guess in MIXED]
    df = spark.createDataFrame(scores, "scores array<double>, label int")
    row = classification_metrics(df.withColumn("prediction", argmax(F.col("scores")))).head()
    assert row.f1 == pytest.approx(7 / 9)


@pytest.mark.parametrize("classes", [2, 5])
def test_agrees_with_the_evaluator(spark, classes):
    rng = random.Random(classes)
    rows = [(rng.randrange(classes), rng.randrange(classes)) for _ in range(400)]
    df = pairs(spark, rows)
    row = classification_metrics(df).head()
    doubles = df.select(F.col("label").cast("double"), F.col("prediction").cast("double"))
    names = {"f1": "f1", "accuracy": "accuracy", "precision": "weightedPrecision",
             "recall": "weightedRecall"}
    for ours, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(metricName=theirs)
        assert row[ours] == pytest.approx(evaluator.evaluate(doubles))


def test_no_rows(spark):
    row = classification_metrics(pairs(spark, [])).head()
    assert tuple(row) == (None, None, None, None, 0)


def test_groups_are_scored_apart(spark):
    df = pairs(spark, MIXED).withColumn("c", F.lit("x")).union(
        pairs(spark, [(0, 0)]).withColumn("c", F.lit("y"))
    )
    found = {r.c: r.f1 for r in classification_metrics(df, by=["c"]).collect()}
    assert found == pytest.approx({"x": 7 / 9, "y": 1.0})


def test_confusion_matrix(spark):
    found = {tuple(r) for r in confusion_matrix(pairs(spark, MIXED)).collect()}
    assert found == {(0, 4, 1, 0), (1, 1, 3, 0)}


def test_confusion_matrix_invents_no_class(spark):
    odd = pairs(spark, [(0, 0), (None, 0), (1, 2), (0, None)])
    found = {tuple(r) for r in confusion_matrix(odd).collect()}
    assert found == {(0, 1, 0, 1), (1, 0, 0, 1), (None, 1, 0, 0)}
    one = confusion_matrix(pairs(spark, [(0, 0)]))
    assert {tuple(r) for r in one.collect()} == {(0, 1, 0, 0), (1, 0, 0, 0)}


def test_best_model(spark):
    df = spark.createDataFrame([(3, 0.5), (2, 0.9), (1, 0.9), (0, None)], "candidate int, f1 double")
    assert best_model(df).head().candidate == 1


GATES = [
    (0.85, 5000, "pass", "production"),
    (0.80, 5000, "pass", "production"),
    (0.75, 9000, "fail_f1", "staging"),
    (None, 9000, "pass_with_warning", "staging"),
    (0.90, 4999, "fail_train_rows", "staging"),
]


def test_quality_gate(spark):
    df = spark.createDataFrame([g[:2] for g in GATES], "f1 double, train_rows long")
    assert {tuple(r) for r in quality_gate(df).collect()} == set(GATES)


def test_counts(spark):
    df = spark.createDataFrame(
        [("a", 0, "train"), ("a", 1, "train"), ("b", 1, "val"), (None, 1, "val")],
        "source string, label_binary int, split string",
    )
    assert {tuple(r) for r in class_distribution(df).collect()} == {(0, 1), (1, 3)}
    assert {tuple(r) for r in split_counts(df).collect()} == {("train", 2), ("val", 2)}
    assert {tuple(r) for r in source_counts(df).collect()} == {
        ("a", 2, False), ("b", 1, False), (None, 1, False), (None, 4, True)
    }


def test_layer_status(spark, tmp_path):
    there, missing = str(tmp_path / "there"), str(tmp_path / "missing")
    spark.createDataFrame([("x", 1), ("y", 0)], EXPORT).write.parquet(there)
    status = layer_status(spark, {"bronze": (there, EXPORT), "gold": (missing, EXPORT)})
    assert {tuple(r) for r in status.collect()} == {
        ("bronze", there, True, 2, None), ("gold", missing, False, None, None)
    }


def test_one_bad_layer_spares_the_others(spark, tmp_path):
    there, broken = tmp_path / "there", tmp_path / "broken"
    spark.createDataFrame([("x", 1)], EXPORT).write.parquet(str(there))
    broken.mkdir()
    (broken / "part-0.parquet").write_bytes(b"no parquet at all")
    layers = {"bronze": (str(broken), EXPORT), "silver": (str(there), EXPORT)}
    found = {r.layer: r for r in layer_status(spark, layers).collect()}
    assert found["silver"].row_count == 1 and found["silver"].error is None
    assert found["bronze"].row_count is None and found["bronze"].error.startswith("error: ")

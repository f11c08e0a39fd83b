"""Counts and classification metrics. Everything starts from counts per few values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CLASS_NAMES, MIN_F1, MIN_TRAIN_ROWS
from ..functions.text import ratio
from .merge import read_table


def class_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("label_binary").agg(F.count(F.lit(1)).alias("n_rows"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))


def source_counts(df: DataFrame) -> DataFrame:
    """Rows per source and in total; the total has ``is_total`` set.

    The total is rolled up from the counts, so no row is counted twice on the way.
    """
    counts = df.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return counts.rollup("source").agg(
        F.sum("n").alias("n_rows"), (F.grouping("source") == 1).alias("is_total")
    )


def layer_status(
    spark: SparkSession, layers: dict[str, tuple[str, T.StructType]]
) -> DataFrame:
    """For each layer its path, whether its table is there, its rows, or why it has no count.

    A layer that cannot be read gets the first line of its ``error`` and spares the others.
    """

    def status(layer: str, path: str, schema: T.StructType) -> tuple:
        try:
            table = read_table(spark, path, schema)
            return layer, path, table is not None, None if table is None else table.count(), None
        except Exception as error:
            return layer, path, True, None, f"error: {str(error).splitlines()[0]}"

    return spark.createDataFrame(
        [status(n, p, s) for n, (p, s) in layers.items()],
        "layer string, path string, present boolean, row_count long, error string",
    )


def classification_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Accuracy, and precision / recall / F1 weighted by the rows of each true class.

    A class that is never predicted, or never hit, scores 0; without any rows the metrics are
    NULL. One row per value of ``by``, so that several candidates can be scored in one pass.
    ``weight`` names the number of rows that a row stands for.
    """
    pairs = df.groupBy(*by, F.col(label).alias("_label"), F.col(prediction).alias("_pred")).agg(
        (F.count(F.lit(1)) if weight is None else F.sum(weight)).alias("_n")
    )
    # Each pair counts for the class it has and for the class it was given.
    n, none = F.col("_n"), F.lit(0).cast("long")
    hit = F.when(F.col("_label").eqNullSafe(F.col("_pred")), n).otherwise(none)
    as_true = F.struct(
        F.col("_label").cast("double").alias("cls"),
        n.alias("support"), none.alias("predicted"), hit.alias("hits"),
    )
    as_predicted = F.struct(
        F.col("_pred").cast("double").alias("cls"),
        none.alias("support"), n.alias("predicted"), none.alias("hits"),
    )
    classes = (
        pairs.select(*by, F.inline(F.array(as_true, as_predicted)))
        .groupBy(*by, "cls")
        .agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    )
    support, predicted, hits = F.col("support"), F.col("predicted"), F.col("hits")
    total = F.sum(support)

    def weighted(score: Column) -> Column:
        return F.sum(support * score) / total

    return classes.groupBy(*by).agg(
        weighted(ratio(2 * hits, support + predicted)).alias("f1"),
        (F.sum(hits) / total).alias("accuracy"),
        weighted(ratio(hits, predicted)).alias("precision"),
        weighted(ratio(hits, support)).alias("recall"),
        F.coalesce(total, F.lit(0)).alias("n_rows"),
    )


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Rows per true class (down) and predicted class (across).

    Both classes have a line, with or without rows; so has each other true value that occurs,
    NULL among them. Predictions that are no class are counted in ``predicted_other``.
    """
    guess = F.col(prediction)
    hits = {
        f"predicted_{name}": F.count_if(guess == number) for number, name in CLASS_NAMES.items()
    }
    other = F.count_if(guess.isNull() | ~guess.isin(list(CLASS_NAMES)))
    truth = F.col(label).alias("truth")
    counts = df.groupBy(truth).agg(
        *[hit.alias(name) for name, hit in hits.items()], other.alias("predicted_other")
    )
    kind = counts.schema["truth"].dataType
    classes = df.sparkSession.createDataFrame([(n,) for n in CLASS_NAMES], "truth int")
    none = [F.lit(0).cast("long").alias(name) for name in counts.columns[1:]]
    lines = counts.unionByName(classes.select(F.col("truth").cast(kind), *none))
    return lines.groupBy("truth").agg(*[F.sum(c).alias(c) for c in counts.columns[1:]])


def best_model(metrics: DataFrame, candidate: str = "candidate") -> DataFrame:
    """The evaluation with the highest F1, ties by candidate."""
    return metrics.orderBy(F.desc_nulls_last("f1"), candidate).limit(1)


def quality_gate(
    metrics: DataFrame, min_f1: float = MIN_F1, min_train_rows: int = MIN_TRAIN_ROWS
) -> DataFrame:
    """Add ``gate`` and ``verdict`` to metrics that carry ``f1`` and ``train_rows``.

    A missing F1 passes the gate with a warning, but is no reason for production; a gate that
    fails for any reason is none either.
    """
    f1, rows = F.col("f1"), F.col("train_rows")
    gate = (
        F.when(f1.isNull(), "pass_with_warning")
        .when(f1 < min_f1, "fail_f1")
        .when(rows < min_train_rows, "fail_train_rows")
        .otherwise("pass")
    )
    verdict = F.when(F.col("gate") == "pass", "production").otherwise("staging")
    return metrics.withColumn("gate", gate).withColumn("verdict", verdict)

"""A two-class text classifier on ``pyspark.ml``: features, training, choice, scoring."""

from __future__ import annotations

import math
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import (
    CountVectorizer,
    ElementwiseProduct,
    SQLTransformer,
    VectorAssembler,
    VectorSizeHint,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.records import class_name
from ..functions.text import valid_for_scoring
from ..session import discard, scratch_path
from .metrics import best_model, classification_metrics

RATIO_COLUMNS = [
    "sentiment_score",
    "exclamation_ratio",
    "caps_ratio",
    "avg_word_length",
    "source_credibility",
]


class TermWeights(Estimator):
    """Counts of terms and their inverse document frequencies, both from one pass over the rows.

    How many rows hold a bucket says which buckets are kept and also what each of them weighs.
    Only these counts, one for each bucket, come to the driver.
    """

    def __init__(self, n_features: int, min_docs: int) -> None:
        super().__init__()
        self.n_features, self.min_docs = n_features, min_docs

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        bucket = F.transform("tokens", lambda word: F.pmod(F.xxhash64(word), F.lit(self.n_features)))
        # A place without a bucket counts the rows themselves.
        places = F.array_append(F.array_distinct(bucket), F.lit(None).cast("long"))
        counts = dataset.select(F.explode(places).alias("bucket")).groupBy("bucket").count()
        n_docs = {row.bucket: row["count"] for row in counts.collect()}
        n_rows = n_docs.pop(None, 0)
        kept = [(str(b),) for b, n in n_docs.items() if n >= self.min_docs]
        if not kept:
            raise ValueError(f"no term occurs in {self.min_docs} training rows")
        listed = dataset.sparkSession.createDataFrame(kept, "bucket string")
        vectorizer = CountVectorizer(
            inputCol="buckets", outputCol="term_counts", vocabSize=len(kept)
        ).fit(listed.select(F.array("bucket").alias("buckets")))
        weights = [math.log((n_rows + 1) / (n_docs[int(b)] + 1)) for b in vectorizer.vocabulary]
        return PipelineModel(
            stages=[
                vectorizer,
                ElementwiseProduct(
                    scalingVec=Vectors.dense(weights), inputCol="term_counts", outputCol="terms"
                ),
                VectorSizeHint(inputCol="terms", size=len(weights), handleInvalid="optimistic"),
            ]
        )


def feature_stages(
    n_features: int = 1 << 18,
    max_tokens: int | None = None,
    extra: Sequence[str] = (),
    min_docs: int = 2,
) -> Pipeline:
    """Hashed term weights of the cleaned text, and ``extra`` numeric columns.

    Terms are hashed into ``n_features`` buckets, and those that occur in ``min_docs`` training
    rows at least get a place in the vector. So the vectors, and the gradients that each task
    sends in each iteration, are as wide as the training rows need and never wider than
    ``n_features``, and so is what the driver holds of them. Buckets that training has not seen
    have no weight to learn; scored rows leave them out.

    All tokens count unless ``max_tokens`` keeps only the first ones, as models with a fixed
    input width need it.
    """
    words = "split(text_clean, ' ')"
    if max_tokens is not None:
        words = f"slice({words}, 1, {max_tokens})"
    bucket = f"CAST(pmod(xxhash64(word), {n_features}) AS STRING)"
    stages = [
        SQLTransformer(statement=f"SELECT *, {words} AS tokens FROM __THIS__"),
        SQLTransformer(
            statement=f"SELECT *, transform(tokens, word -> {bucket}) AS buckets FROM __THIS__"
        ),
        TermWeights(n_features, min_docs),
        VectorAssembler(inputCols=["terms", *extra], outputCol="features"),
    ]
    return Pipeline(stages=stages)


def without_summary(
    spark: SparkSession, model: LogisticRegressionModel
) -> LogisticRegressionModel:
    """The same model without what it knows about its training.

    A training summary holds the session, and scoring sends a model to the executors whole; a
    session that has observed a metric once cannot be sent.
    """
    path = scratch_path(spark, "model")
    try:
        model.write().save(path)
        return LogisticRegressionModel.load(path)
    finally:
        discard(spark, path)


def train_classifier(
    train: DataFrame,
    val: DataFrame,
    reg_params: Sequence[float] = (0.001, 0.01, 0.1),
    n_features: int = 1 << 18,
    max_tokens: int | None = None,
    extra: Sequence[str] = (),
    weight: str | None = None,
    max_iter: int = 20,
    min_docs: int = 2,
) -> tuple[PipelineModel, DataFrame]:
    """Fit one classifier per ``reg_params`` on train, keep the one with the best F1 on val.

    Both tables need ``text_clean`` and ``label_binary``. Returns the model and one row of
    validation metrics per candidate, ``eval_loss`` (mean log loss) among them.
    """
    spark = train.sparkSession
    features = feature_stages(n_features, max_tokens, extra, min_docs).fit(train)
    known = ["features", "label_binary"]
    # Written once: each step of each fit then sends its tasks a scan, and no vocabulary.
    paths = [scratch_path(spark, "vectors") for _ in range(2)]
    try:
        weighted = [*known, weight] if weight else known
        vectors(features, train).select(*weighted).write.parquet(paths[0])
        vectors(features, val).select(*known).write.parquet(paths[1])
        train_vectors, val_vectors = map(spark.read.parquet, paths)
        models = _fitted(train_vectors, reg_params, weight, max_iter)
        found = _evaluations(val_vectors, models, reg_params)
        rows = found.collect()
    finally:
        for path in paths:
            discard(spark, path)
    # A row per candidate: kept as values, so that it does not depend on the validation rows.
    metrics = spark.createDataFrame(rows, found.schema)
    chosen = best_model(metrics).head()
    if chosen is None or chosen["f1"] is None:
        raise ValueError("no validation rows to choose a model by")
    return PipelineModel(stages=[features, models[chosen["candidate"]]]), metrics


def vectors(features: PipelineModel, rows: DataFrame) -> DataFrame:
    """``rows`` with their features, without a name for each place in the vector.

    The names would go into the schema, and with it into each task and file.
    """
    unnamed = F.col("features").alias("features", metadata={"ml_attr": {}})
    return features.transform(rows).withColumn("features", unnamed)


def _fitted(
    rows: DataFrame, reg_params: Sequence[float], weight: str | None, max_iter: int
) -> list[LogisticRegressionModel]:
    """A model per regularization."""
    spark = rows.sparkSession
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    estimator = LogisticRegression(labelCol="label_binary", maxIter=max_iter)
    if weight:
        estimator = estimator.setWeightCol(weight)
    # Each fit is a row of short jobs; side by side they fill the gaps between them.
    fits = estimator.fitMultiple(rows, [{estimator.regParam: r} for r in reg_params])
    try:
        with ThreadPool(len(reg_params)) as pool:
            fit = inheritable_thread_target(spark)(lambda _: next(fits))
            found = dict(pool.imap_unordered(fit, reg_params))
    finally:
        rows.unpersist()
    return [without_summary(spark, found[n]) for n in range(len(reg_params))]


# Probabilities are kept from 0 and 1 by this much, so that a sure and wrong one has a loss.
TINY = 1e-15


def _evaluations(
    val: DataFrame, models: Sequence[LogisticRegressionModel], reg_params: Sequence[float]
) -> DataFrame:
    """Metrics and mean log loss of all models, in one pass over the rows."""
    guesses, label = [], F.col("label_binary")
    for number, (model, reg_param) in enumerate(zip(models, reg_params, strict=True)):
        chance = f"_probability_{number}"
        scorer = model.copy({model.predictionCol: f"_prediction_{number}",
                             model.probabilityCol: chance, model.rawPredictionCol: f"_raw_{number}"})
        val = scorer.transform(val)
        right = F.get(vector_to_array(chance), label)
        guesses.append(
            F.struct(
                F.lit(number).alias("candidate"), F.lit(reg_param).alias("reg_param"),
                F.col(f"_prediction_{number}").alias("prediction"),
                (-F.log(F.least(F.greatest(right, F.lit(TINY)), F.lit(1 - TINY)))).alias("loss"),
            )
        )
    rows = val.select("label_binary", F.inline(F.array(*guesses)))
    by = ["candidate", "reg_param"]
    # The loss is summed with the counts the metrics start from, so the rows are read once.
    counts = rows.groupBy(*by, "label_binary", "prediction").agg(
        F.count(F.lit(1)).alias("n"), F.sum("loss").alias("loss")
    )
    counts = val.sparkSession.createDataFrame(counts.collect(), counts.schema)
    loss = counts.groupBy(*by).agg((F.sum("loss") / F.sum("n")).alias("eval_loss"))
    metrics = classification_metrics(counts, "label_binary", by=by, weight="n")
    return metrics.join(loss, by)


def with_class_weights(train: DataFrame, name: str = "class_weight") -> DataFrame:
    """Add a weight that gives both classes the same total."""
    counts = train.groupBy("label_binary").count().collect()
    total = sum(row["count"] for row in counts)
    weight = F.lit(None).cast("double")
    for row in counts:
        share = total / (len(counts) * row["count"])
        weight = F.when(F.col("label_binary") == row["label_binary"], share).otherwise(weight)
    return train.withColumn(name, weight)


def score(model: PipelineModel, texts: DataFrame, model_version: str) -> DataFrame:
    """Class name and its probability for each row of a table with the model's columns."""
    return model.transform(texts).select(
        *texts.columns,
        F.col("prediction").cast("int").alias("prediction"),
        class_name(F.col("prediction")).alias("predicted_label"),
        F.array_max(vector_to_array("probability")).alias("confidence"),
        F.lit(model_version).alias("model_version"),
    )


def with_validity(texts: DataFrame, text: str = "text") -> DataFrame:
    """Add ``is_valid``: whether a service that limits the length of texts would take the row."""
    return texts.withColumn("is_valid", valid_for_scoring(F.col(text)))

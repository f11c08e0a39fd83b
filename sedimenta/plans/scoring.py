"""Raw texts to predictions."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import SOURCE_CREDIBILITY
from ..operators.model import score, with_validity
from .gold import with_features
from .silver import with_text_columns


def score_texts(
    model: PipelineModel,
    texts: DataFrame,
    lexicon: DataFrame,
    model_version: str,
    credibility: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
) -> DataFrame:
    """Predictions for all texts, of any length; a NULL text is scored as an empty one.

    ``texts`` has ``id``, ``source`` and ``text``; its columns come back with ``prediction``,
    ``predicted_label``, ``confidence``, ``model_version`` and ``is_valid``, which says whether
    a service that limits the length of texts would take the row.
    """
    checked = with_validity(texts).withColumn("_given", F.col("text"))
    filled = checked.withColumn("text", F.coalesce("text", F.lit("")))
    features = with_features(with_text_columns(filled), lexicon, credibility)
    scored = score(model, features, model_version).withColumn("text", F.col("_given"))
    return scored.select(
        *texts.columns, "prediction", "predicted_label", "confidence", "model_version", "is_valid"
    )

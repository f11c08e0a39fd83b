"""Toxicity by a chain of linear classifiers, each fed the probabilities of those before it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.model import without_summary
from .common import Step, empty_if_null


@dataclass(frozen=True)
class ChainSettings:
    """``sample``: labelled documents to learn from, at most; the others are only scored.

    ``words``: words kept per category, those that say most about it, each with a chi-squared of
    ``evidence`` at least, which chance alone does not give to any of some 100,000 words.
    """

    sample: int = 20_000
    words: int = 2_000
    evidence: float = 30.0
    folds: int = 3
    iterations: int = 30
    penalty: float = 1e-4


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _featured(docs: DataFrame) -> DataFrame:
    """``docs`` with ``words``, the distinct ones, and what tells prose from junk and long from short."""
    text = empty_if_null("text")
    words = F.filter(F.split(F.lower(text), r"[^\p{L}]+"), lambda w: w != "")
    docs = docs.withColumn("all_words", words)
    docs = docs.withColumn("words", F.array_distinct("all_words"))
    size, letters = F.char_length(text), F.regexp_replace(text, r"[^\p{L}\s]", "")
    shares = {
        "varied": _share(F.size("words"), F.size("all_words")),
        "signs": _share(size - F.char_length(letters), size),
        "upper": _share(F.char_length(F.regexp_replace(text, r"\P{Lu}", "")), size),
        "long": F.log1p(F.size("words")),
    }
    return docs.withColumns(shares).drop("all_words")


SHARES = ("varied", "signs", "upper", "long")


def telling_vocabulary(
    sample: DataFrame, categories: Sequence[str], settings: ChainSettings
) -> list[str]:
    """Words with the largest chi-squared for a category, ties by word."""
    totals = sample.agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in categories]
    ).head()
    counted = sample.select(*categories, F.explode("words").alias("word")).groupBy("word").agg(
        F.count("*").alias("n"), *[F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in categories]
    )
    chosen: set[str] = set()
    for c in categories:
        share = (totals[c] or 0) / max(1, totals["n"])
        expected = F.col("n") * share
        spread = expected * (1 - share)
        if not 0 < share < 1:
            continue
        chi = (F.col(c) - expected) ** 2 / spread
        best = counted.where(chi >= settings.evidence).orderBy(chi.desc(), "word")
        best = best.limit(settings.words)
        chosen.update(row.word for row in best.select("word").collect())
    return sorted(chosen)


class ToxicityChain:
    """Fitted chain; :meth:`score` adds a probability per category."""

    def __init__(
        self, categories: Sequence[str], vocabulary: list[str],
        models: list[LogisticRegressionModel | float],
    ) -> None:
        self.categories, self.vocabulary, self.models = list(categories), vocabulary, models

    def score(self, docs: DataFrame) -> DataFrame:
        """All rows and columns of ``docs``, and ``p_<category>`` for each category.

        Whole texts are scored; a NULL text counts as empty. Columns of ``docs`` with the name
        of a result are replaced. No shuffle.
        """
        added = [f"p_{c}" for c in self.categories]
        kept = [c for c in docs.columns if c not in added]
        rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"))
        rows = _featured(rows.withColumn("text", F.col("row.text")))
        rows = _vectors(rows, self.vocabulary)
        for c, model in zip(self.categories, self.models, strict=True):
            rows = _probability(rows, c, model, added[: added.index(f"p_{c}")])
        return rows.select("row.*", *added)


def _vectors(df: DataFrame, vocabulary: list[str]) -> DataFrame:
    counter = CountVectorizerModel.from_vocabulary(
        vocabulary or ["\0"], inputCol="words", outputCol="counts"
    )
    return counter.setBinary(True).transform(df)


def _assembled(df: DataFrame, earlier: Sequence[str]) -> DataFrame:
    parts = VectorAssembler(inputCols=["counts", *SHARES, *earlier], outputCol="features")
    return parts.transform(df)


def _probability(
    df: DataFrame, category: str, model: LogisticRegressionModel | float, earlier: Sequence[str]
) -> DataFrame:
    name = f"p_{category}"
    if isinstance(model, float):
        return df.withColumn(name, F.lit(model))
    scored = model.transform(_assembled(df, earlier))
    return scored.withColumn(name, vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability", "prediction"
    )


def _fit(
    df: DataFrame, category: str, earlier: Sequence[str], settings: ChainSettings
) -> LogisticRegressionModel | float:
    """A model, or the share of the category where all or none of the rows have it."""
    known = df.where(F.col(category).isNotNull())
    share = known.agg(F.avg(F.col(category).cast("double"))).head()[0] or 0.0
    if not 0 < share < 1:
        return float(share)
    learner = LogisticRegression(
        labelCol=category, maxIter=settings.iterations, regParam=settings.penalty
    )
    return without_summary(df.sparkSession, learner.fit(_assembled(known, earlier)))


def fit_chain(
    docs: DataFrame, labels: DataFrame, categories: Sequence[str],
    settings: ChainSettings = ChainSettings(),
) -> ToxicityChain:
    """Learn the categories, 0/1 columns of ``labels``, in the given order.

    Learns from at most ``sample`` labelled documents, chosen by a hash of ``doc_id``. A model's
    probabilities that later ones learn from are out of fold: they come from models that have not
    seen the row. A document labelled more than once has a category if one of its labels says so;
    NULL labels are left out. Without labels all probabilities are 0.
    """
    given = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        *[F.max(c).alias(c) for c in categories]
    )
    chosen = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(settings.sample)
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = sample.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(1)), settings.folds))
    step = Step(_featured(sample).drop("text").repartition(4, "doc_id"), "labelled")
    vocabulary = telling_vocabulary(step.df, categories, settings)
    rows, models = _vectors(step.df, vocabulary).drop("words"), []
    for i, c in enumerate(categories):
        earlier = [f"p_{e}" for e in categories[:i]]
        models.append(_fit(rows, c, earlier, settings))
        if i + 1 < len(categories):
            parts = []
            for fold in range(settings.folds):
                model = _fit(rows.where(F.col("fold") != fold), c, earlier, settings)
                parts.append(_probability(rows.where(F.col("fold") == fold), c, model, earlier))
            whole = parts[0]
            for part in parts[1:]:
                whole = whole.unionByName(part)
            rows = Step(whole, f"folds-{i}").df
    return ToxicityChain(categories, vocabulary, models)


# Poor text is told first: what is junk is seldom abuse.
CATEGORIES = ("poor", "toxic")
REJECT = 0.5


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the chain calls toxic.

    All columns stay as they are, also those that are named like a result of the chain.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    judged = toxicity(docs.select(whole, "doc_id", "text"), labels)
    return judged.where(~F.col("is_toxic")).select("row.*")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` with ``p_poor``, ``p_toxic`` and ``is_toxic``, from the chain over ``labels``."""
    judged = labels.select("doc_id", (1 - F.col("quality")).alias("poor"), F.col("toxic"))
    scored = fit_chain(docs, judged, CATEGORIES).score(docs)
    return scored.withColumn("is_toxic", F.col("p_toxic") >= REJECT)

"""The classifier."""

from __future__ import annotations

import inspect
import math
import random

import pytest
from pyspark.ml.feature import HashingTF
from pyspark.sql import Observation
from pyspark.sql import functions as F

from sedimenta.operators.model import (
    feature_stages,
    score,
    train_classifier,
    vectors,
    with_class_weights,
    with_validity,
    without_summary,
)


@pytest.fixture(scope="module")
def table(spark):
    """Texts of the two classes use different words."""
    rng = random.Random(5)
    words = {0: "report official source data".split(), 1: "shocking secret hoax miracle".split()}
    rows = []
    for n in range(400):
        label = int(n % 4 == 0)
        text = " ".join(rng.choice(words[label] + ["the", "of", "it"]) for _ in range(12))
        rows.append((str(n), text, label, float(n % 5)))
    return spark.createDataFrame(rows, "id string, text_clean string, label_binary int, extra double")


@pytest.fixture(scope="module")
def trained(table):
    # A session that has observed a metric holds what cannot be sent to executors.
    seen = Observation()
    table.observe(seen, F.count("*").alias("n")).write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 400
    weighted = with_class_weights(table)
    train, val = weighted.where("id % 5 > 0"), weighted.where("id % 5 = 0")
    return train_classifier(
        train, val, reg_params=(0.01, 100.0), n_features=1 << 10, extra=["extra"],
        weight="class_weight", max_iter=5,
    )


def test_candidates_and_choice(trained):
    _, metrics = trained
    rows = {r.reg_param: r for r in metrics.collect()}
    assert set(rows) == {0.01, 100.0}
    assert rows[0.01].f1 > 0.95
    assert rows[0.01].n_rows == 80
    assert 0 < rows[0.01].eval_loss < rows[100.0].eval_loss


def test_scores(spark, trained, table):
    model, _ = trained
    scored = score(model, table, "7")
    rows = scored.collect()
    assert len(rows) == 400
    assert all(0.5 <= r.confidence <= 1.0 for r in rows)
    assert {r.predicted_label for r in rows} == {"credible", "misinformation"}
    assert {r.model_version for r in rows} == {"7"}
    assert all((r.predicted_label == "credible") == (r.prediction == 0) for r in rows)
    assert sum(r.prediction == r.label_binary for r in rows) > 380


def test_raw_texts(spark, table):
    from sedimenta.functions.lexicon import default_lexicon
    from sedimenta.plans.scoring import score_texts

    model, _ = train_classifier(table, table, reg_params=(0.01,), n_features=1 << 10, max_iter=5)
    texts = spark.createDataFrame(
        [("1", "s", "Shocking SECRET <b>hoax</b>!"), ("2", "s", "Official report, data"),
         ("3", "s", "short"), ("4", "s", None), ("5", "s", "secret " * 1000)],
        "id string, source string, text string",
    )
    scored = score_texts(model, texts, default_lexicon(spark), "1")
    found = {r.id: r for r in scored.collect()}
    assert len(found) == 5
    assert [found[i].predicted_label for i in "12"] == ["misinformation", "credible"]
    assert {i: r.is_valid for i, r in found.items()} == {
        "1": True, "2": True, "3": False, "4": False, "5": False
    }
    assert all(0.5 <= r.confidence <= 1.0 for r in found.values())
    assert found["4"].text is None and len(found["5"].text) == 7000
    assert scored.columns[:3] == texts.columns


def test_model_survives_saving(spark, trained, table, tmp_path):
    from pyspark.ml import PipelineModel

    model, _ = trained
    model.write().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    sums = [score(m, table, "1").agg(F.sum("confidence")).head()[0] for m in (model, loaded)]
    assert sums[0] == pytest.approx(sums[1])


def test_class_weights_balance(table):
    sums = with_class_weights(table).groupBy("label_binary").agg(F.sum("class_weight")).collect()
    assert {round(r[1], 6) for r in sums} == {200.0}


def test_all_tokens_count_unless_limited(spark):
    text = " ".join(f"w{n}" for n in range(300))
    df = spark.createDataFrame([(text,)], "text_clean string")
    for limit, expected in ((None, 300), (128, 128)):
        fitted = feature_stages(1 << 10, max_tokens=limit, min_docs=1).fit(df)
        assert fitted.transform(df).select(F.size("tokens")).head()[0] == expected


def test_vectors_are_as_wide_as_the_training_rows_need(spark):
    rows = [("a b", ), ("a c",), ("b a a",), ("d",)]
    df = spark.createDataFrame(rows, "text_clean string")
    for least, terms in ((1, 4), (2, 2), (3, 1)):
        fitted = feature_stages(1 << 18, min_docs=least).fit(df)
        found = vectors(fitted, df).select("text_clean", "term_counts", "features").collect()
        assert {r.features.size for r in found} == {terms}
        # Terms that training does not know are left out, in rows to be scored as well.
        known = {1: "abcd", 2: "ab", 3: "a"}[least]
        for r in found:
            assert sum(r.term_counts.values) == sum(w in known for w in r.text_clean.split())
    new = spark.createDataFrame([("z z a",), ("",)], "text_clean string")
    assert [r.term_counts.numNonzeros() for r in fitted.transform(new).collect()] == [1, 0]


def test_vectors_name_no_places(spark, table):
    df = vectors(feature_stages(1 << 10).fit(table), table)
    assert "attrs" not in df.schema["features"].json()


def test_no_validation_rows(table):
    with pytest.raises(ValueError, match="validation"):
        train_classifier(table, table.where("false"), reg_params=(0.1,), n_features=64, max_iter=1)


def test_validity(spark):
    df = spark.createDataFrame([("short",), ("long enough text",), (None,)], "text string")
    assert [r.is_valid for r in with_validity(df).collect()] == [False, True, False]


def test_loss_and_metrics_of_candidates(spark):
    """One pass over all candidates gives what each gives alone."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors

    from sedimenta.operators.metrics import classification_metrics
    from sedimenta.operators.model import _evaluations

    rng = random.Random(3)
    rows = [(Vectors.dense([rng.random() + n % 2, rng.random()]), n % 2) for n in range(60)]
    df = spark.createDataFrame(rows, ["features", "label_binary"])
    learner = LogisticRegression(labelCol="label_binary", maxIter=5)
    models = [
        without_summary(spark, learner.copy({learner.regParam: r}).fit(df)) for r in (0.01, 1.0)
    ]
    assert not any(m.hasSummary for m in models)
    found = {r.candidate: r for r in _evaluations(df, models, (0.01, 1.0)).collect()}
    for n, fitted in enumerate(models):
        alone = fitted.transform(df)
        metrics = classification_metrics(alone, "label_binary").head()
        assert found[n].f1 == pytest.approx(metrics.f1)
        chances = [(r.probability[r.label_binary]) for r in alone.collect()]
        loss = -sum(map(math.log, chances)) / len(chances)
        assert found[n].eval_loss == pytest.approx(loss)


def test_terms_are_hashed_as_finely_as_the_library_does():
    """The defaults cut no buckets."""
    given = HashingTF().getNumFeatures()
    assert inspect.signature(train_classifier).parameters["n_features"].default == given
    assert inspect.signature(feature_stages).parameters["n_features"].default == given


def test_terms_are_counted_and_weighed_in_one_pass(spark):
    """Each row is computed once, and the weights are those of the library."""
    from pyspark.ml.feature import IDF

    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(text):
        seen.add(1)
        return text

    texts = [("a b",), ("a c a",), ("b a a",), ("d a",)]
    df = spark.createDataFrame(texts, "text string").coalesce(1)
    fitted = feature_stages(1 << 18, min_docs=1).fit(df.select(counted("text").alias("text_clean")))
    assert seen.value == len(texts)
    rows = fitted.transform(df.withColumnRenamed("text", "text_clean"))
    library = IDF(inputCol="term_counts", outputCol="expected").fit(rows).transform(rows)
    for r in library.collect():
        assert r.features.toArray() == pytest.approx(r.expected.toArray())


def test_vectors_are_looked_into_as_stored(spark, plan):
    """No vector is made dense, of rows that are dense in the file neither."""
    from checks.queries import QUERIES

    found = QUERIES["token_features"](spark, "/root/testdata/sf0.001")
    text = plan(found)
    assert "UDF" not in text and "indices" in text
    assert found.where("weighted AND n_terms = n_tokens").count() == found.count() > 0

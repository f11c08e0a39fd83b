"""Sentiment against a plain computation, row by row."""

from __future__ import annotations

import random
import re

import pytest

from sedimenta.functions.lexicon import default_lexicon
from sedimenta.operators.joins import RepeatedKey, with_credibility
from sedimenta.operators.sentiment import with_sentiment
from sedimenta.schemas import LEXICON

WORDS = [
    ("good", 0.75, "polar"), ("bad", -0.5, "polar"), ("can't", -0.25, "polar"),
    ("great", 1.0, "polar"), ("not", 0.0, "negator"), ("very", 1.5, "intensifier"),
    ("bit", 0.5, "intensifier"),
]
LEXICON_OF = {w: (p, k) for w, p, k in WORDS}


def plain(text):
    if text is None:
        return 0.0
    scores, before = [], None
    for word in re.findall(r"[a-z']+", text):
        polarity, kind = LEXICON_OF.get(word, (0.0, None))
        if kind == "polar":
            strength, kind_before = LEXICON_OF.get(before, (0.0, None))
            factor = {"negator": -0.5, "intensifier": strength}.get(kind_before, 1.0)
            scores.append(max(-1.0, min(1.0, polarity * factor)))
        before = word
    return sum(scores) / len(scores) if scores else 0.0


def texts():
    rng = random.Random(7)
    vocabulary = [w for w, _, _ in WORDS] + ["the", "é", "of", "", "goodness", "it's"]
    gaps = [" ", "  ", ", ", "-", "1", "ü", " "]
    made = [
        "".join(rng.choice(vocabulary) + rng.choice(gaps) for _ in range(rng.randrange(30)))
        for _ in range(300)
    ]
    return [None, "", " ", "good", "not good", "very great", "not very good", "good, bad", *made]


@pytest.mark.parametrize("inline", [10_000, 0])
def test_matches_the_plain_computation(spark, inline):
    given = texts()
    df = spark.createDataFrame(
        [(str(n), "s", t) for n, t in enumerate(given)], "id string, source string, text_clean string"
    )
    scored = with_sentiment(
        df, spark.createDataFrame(WORDS, LEXICON), max_inline_words=inline
    )
    assert dict(scored.dtypes)["sentiment_score"] == "float"
    assert scored.columns == [*df.columns, "sentiment_score"]
    found = {int(r.id): r.sentiment_score for r in scored.collect()}
    assert len(found) == len(given)
    for number, text in enumerate(given):
        assert found[number] == pytest.approx(plain(text), abs=1e-6), text


def test_examples(spark):
    df = spark.createDataFrame(
        [("not good",), ("very great",), ("very not good",)], "text_clean string"
    )
    scored = with_sentiment(df, spark.createDataFrame(WORDS, LEXICON)).collect()
    assert [r.sentiment_score for r in scored] == [-0.375, 1.0, -0.375]


def test_empty_word_list(spark):
    df = spark.createDataFrame([("good",)], "text_clean string")
    assert with_sentiment(df, spark.createDataFrame([], LEXICON)).head().sentiment_score == 0.0


def test_odd_words_in_the_list(spark):
    odd = [("a\\", 0.5, "polar"), ("'", 0.25, "polar"), ('"', 0.5, "polar"), ("fine", 0.5, "polar")]
    df = spark.createDataFrame([("' fine",), ("a\\",)], "text_clean string")
    scored = with_sentiment(df, spark.createDataFrame(odd, LEXICON)).collect()
    assert [r.sentiment_score for r in scored] == [0.375, 0.0]


def test_default_list_has_each_word_once_and_polarities_in_range(spark):
    lexicon = default_lexicon(spark)
    assert lexicon.count() == lexicon.select("word").distinct().count()
    assert lexicon.where("abs(polarity) > 1 AND kind = 'polar'").count() == 0


def test_small_list_needs_no_shuffle(spark, plan):
    df = spark.createDataFrame([("good",)], "text_clean string")
    text = plan(with_sentiment(df, spark.createDataFrame(WORDS, LEXICON)))
    assert "Exchange" not in text and "Python" not in text.replace("PythonRDD", "")


@pytest.mark.parametrize("inline", [10_000, 0])
def test_score_depends_on_the_text_alone(spark, inline):
    """Keys may be NULL or repeated."""
    df = spark.createDataFrame(
        [(None, "s", "good"), ("1", "s", "good"), ("1", "s", "bad"), ("1", "s", None)],
        "id string, source string, text_clean string",
    )
    scored = with_sentiment(df, spark.createDataFrame(WORDS, LEXICON), max_inline_words=inline)
    assert sorted(r.sentiment_score for r in scored.collect()) == [-0.5, 0.0, 0.75, 0.75]


@pytest.mark.parametrize("inline", [10_000, 0])
def test_a_word_may_be_listed_once(spark, inline):
    twice = spark.createDataFrame([("good", 0.5, "polar"), ("good", 1.0, "polar")], LEXICON)
    df = spark.createDataFrame([("good",)], "text_clean string")
    with pytest.raises(RepeatedKey, match="good"):
        with_sentiment(df, twice, max_inline_words=inline)


def test_credibility_tables(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "source string")
    table = spark.createDataFrame([("a", 0.25), (None, 0.9)], "source string, credibility double")
    large = {f"s{n}": 0.1 for n in range(2_000)} | {"a": 0.25}
    for given in (table, large, {"a": 0.25}):
        found = {r.source: r.source_credibility for r in with_credibility(df, given).collect()}
        assert found == {"a": 0.25, "b": 0.5, None: 0.5}
    with pytest.raises(RepeatedKey, match="source"):
        with_credibility(df, table.unionByName(table))


def test_words_stay_where_they_are_when_the_list_is_small_enough_to_send(spark, plan):
    """A list that is joined is sent to the words if Spark finds it small; only means are shuffled."""
    df = spark.createDataFrame([("1", "a good thing")], "id string, text_clean string")
    text = plan(with_sentiment(df, spark.createDataFrame(WORDS, LEXICON), max_inline_words=0))
    assert not any("word" in line for line in text.splitlines() if "hashpartitioning" in line)
    assert "SortMergeJoin Inner" not in text

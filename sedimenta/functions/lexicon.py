"""A small English word list for sentiment; real use may bring a larger table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import LEXICON

POLAR_WORDS = {
    1.0: "awesome best brilliant excellent fantastic perfect superb wonderful",
    0.75: "amazing beautiful delightful great happy impressive love outstanding",
    0.5: "accurate beneficial better glad good helpful honest hopeful nice pleasant positive"
    " proud reliable safe strong success successful trustworthy win",
    0.25: "agree clear easy fair free fresh fun genuine interesting new okay real right smart"
    " true useful",
    -0.25: "difficult doubtful expensive hard late old questionable slow strange unclear"
    " unlikely weak",
    -0.5: "afraid angry bad broken dangerous fail failed failure fake false hurt lie lies"
    " misleading negative poor sad sick unfair unsafe wrong",
    -0.75: "corrupt cruel deadly disgusting fraud hate hoax ugly violent",
    -1.0: "awful evil horrible terrible worst",
}

NEGATORS = "barely can't cannot don't hardly isn't neither never no not wasn't won't"

INTENSIFIERS = {
    1.5: "absolutely extremely incredibly totally",
    1.25: "highly really so too very",
    0.75: "fairly quite rather",
    0.5: "slightly somewhat",
}


def default_lexicon(spark: SparkSession) -> DataFrame:
    """The word list as a ``(word, polarity, kind)`` table."""
    rows = [(w, p, "polar") for p, words in POLAR_WORDS.items() for w in words.split()]
    rows += [(w, 0.0, "negator") for w in NEGATORS.split()]
    rows += [(w, f, "intensifier") for f, words in INTENSIFIERS.items() for w in words.split()]
    return spark.createDataFrame(rows, LEXICON)

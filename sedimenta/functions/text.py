"""Cleaning and measuring text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import (
    CREDIBLE,
    CREDIBLE_LABELS,
    MAX_TEXT_CHARS,
    MIN_TEXT_CHARS,
    MISINFORMATION,
    MISINFORMATION_LABELS,
    TAG_PATTERN,
    UNKNOWN,
)

# What Unicode counts as white space, plus the four ASCII separators that only some
# definitions include; anchored at both ends.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"

# The matches of SPACE_PATTERN that are not one space already. Those that are, between most words,
# would be replaced by themselves, which is most of the time that folding takes.
FOLDED_SPACE = r"\s(?:(?<! )|\s)\s*"


def label_class(label: Column) -> Column:
    """0 for credible words, 1 for misinformation words, -1 for anything else or NULL."""
    word = F.regexp_replace(F.lower(label), _OUTER_SPACE, "")
    return (
        F.when(word.isin(CREDIBLE_LABELS), CREDIBLE)
        .when(word.isin(MISINFORMATION_LABELS), MISINFORMATION)
        .otherwise(UNKNOWN)
    )


def has_text(text: Column) -> Column:
    """False for NULL and for text of U+0020 only (tabs and line ends count as text)."""
    return text.isNotNull() & (F.trim(text) != "")


def clean(text: Column) -> Column:
    """Drop tags, fold runs of ASCII white space to one space, trim, lower-case.

    Most texts have no tags; those are spared the pattern, which starts with the bracket.
    """
    without_tags = F.when(
        F.contains(text, F.lit("<")), F.regexp_replace(text, TAG_PATTERN, "")
    ).otherwise(text)
    return F.lower(F.trim(F.regexp_replace(without_tags, FOLDED_SPACE, " ")))


def occurrences(text: Column, char: str) -> Column:
    """How often one character occurs, without building an array."""
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def word_count(cleaned: Column) -> Column:
    """Words of a text that went through :func:`clean`; the empty text has one.

    Cleaned text holds single spaces only and none at its ends, so counting them gives what
    splitting on white space gives.
    """
    return occurrences(cleaned, " ") + 1


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double, 0.0 where the denominator is zero or NULL."""
    return F.when(
        denominator != 0, numerator.cast("double") / denominator.cast("double")
    ).otherwise(0.0)


def exclamation_ratio(cleaned: Column, char_count: Column) -> Column:
    return ratio(occurrences(cleaned, "!"), char_count)


def caps_ratio(text: Column) -> Column:
    """Share of ASCII capitals in the raw text.

    All else is removed, a run at a time: runs are skipped faster than single places are tried.
    """
    return ratio(F.length(F.regexp_replace(text, "[^A-Z]+", "")), F.length(text))


def avg_word_length(char_count: Column, words: Column) -> Column:
    return ratio(char_count, words)


def valid_for_scoring(text: Column) -> Column:
    """Whether a text has an accepted length; NULL has not."""
    return F.coalesce(F.length(text).between(MIN_TEXT_CHARS, MAX_TEXT_CHARS), F.lit(False))


def text_digest(text: Column) -> Column:
    """32 bytes that tell texts apart."""
    return F.unhex(F.sha2(text, 256))

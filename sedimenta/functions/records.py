"""Raw records: ids, metadata, vocabularies, splits and predictions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import (
    CLASS_NAMES,
    CREDIBLE,
    MISINFORMATION,
    SPLIT_BUCKETS,
    TEST,
    TRAIN,
    VAL,
)


def as_json(fields: Sequence[Column]) -> Column:
    """One JSON object from named columns; NULL fields stay visible as ``null``."""
    if not fields:
        return F.lit("{}")
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def first_present(df: DataFrame, *candidates: str, default: str = "") -> Column:
    """First non-NULL of those candidate columns that exist, as string, else ``default``."""
    known = [F.col(name).cast("string") for name in candidates if name in df.columns]
    return F.coalesce(*known, F.lit(default))


def column_or(df: DataFrame, name: str, default: object) -> Column:
    """A column as it is, or a constant if the table does not have it."""
    return F.col(name) if name in df.columns else F.lit(default)


def name_at(index: Column, names: Sequence[str]) -> Column:
    """Name by 0-based position; negative positions count from the end.

    A position outside the list fails the job under ANSI mode: the vocabulary is wrong then.
    No position gives no name.
    """
    position = F.when(index >= 0, index + 1).otherwise(index)
    name = F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))
    # Without the test a NULL position would be taken for the last one.
    return F.when(index.isNotNull(), name)


def hash_split(key: Column) -> Column:
    """train / val / test by the hash of the id **as string**, 80/10/10."""
    bucket = F.pmod(F.hash(key.cast("string")), F.lit(SPLIT_BUCKETS))
    return (
        F.when(bucket < SPLIT_BUCKETS - 2, TRAIN)
        .when(bucket == SPLIT_BUCKETS - 2, VAL)
        .otherwise(TEST)
    )


def argmax(scores: Column) -> Column:
    """0-based position of the first maximum."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def class_name(prediction: Column) -> Column:
    return (
        F.when(prediction == CREDIBLE, CLASS_NAMES[CREDIBLE])
        .when(prediction == MISINFORMATION, CLASS_NAMES[MISINFORMATION])
        .otherwise("unknown")
    )

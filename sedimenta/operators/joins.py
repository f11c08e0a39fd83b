"""Joins with dimension tables, which must hold a key once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import DEFAULT_CREDIBILITY, SOURCE_CREDIBILITY

# Entries of a map that become part of the expression; more of them are joined as a table.
MAX_INLINE_ROWS = 1_000


class RepeatedKey(ValueError):
    """A dimension table that holds a key twice would multiply the rows it is joined to."""


def require_unique(table: DataFrame, key: str) -> None:
    """Fail if ``key`` has a value more than once; NULL never matches and may repeat."""
    twice = table.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").head()
    if twice is not None:
        raise RepeatedKey(f"{key} {twice[0]!r} occurs {twice[1]} times")


def credibility(
    source: Column,
    table: dict[str, float] = SOURCE_CREDIBILITY,
    default: float = DEFAULT_CREDIBILITY,
) -> Column:
    """Credibility of a source from a map; exact match, else the default."""
    if not table:
        return F.lit(default).cast("float")
    known = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    return F.coalesce(F.element_at(known, source), F.lit(default)).cast("float")


def with_credibility(
    df: DataFrame,
    table: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
    default: float = DEFAULT_CREDIBILITY,
) -> DataFrame:
    """Add ``source_credibility`` from a map, or from a ``(source, credibility)`` table.

    A large map is joined like a table. Spark broadcasts the table if its bytes are few; else the
    join shuffles both sides and adaptive execution splits hot sources.
    """
    if isinstance(table, dict) and len(table) <= MAX_INLINE_ROWS:
        return df.withColumn("source_credibility", credibility(F.col("source"), table, default))
    if isinstance(table, dict):
        table = df.sparkSession.createDataFrame(
            [(s, float(c)) for s, c in table.items()], "source string, credibility double"
        )
    require_unique(table, "source")
    score = F.coalesce("credibility", F.lit(default)).cast("float")
    joined = df.join(table.select("source", "credibility"), "source", "left")
    return joined.withColumn("source_credibility", score).select(*df.columns, "source_credibility")

"""Raw records: the row layout all sources are brought to."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.records import as_json
from ..schemas import BRONZE


def raw_records(
    df: DataFrame,
    id: Column,
    text: Column,
    label: Column,
    source: Column | str,
    meta: Sequence[Column],
) -> DataFrame:
    """Rows of id, text, label, source and raw_meta; text is never NULL, labels are verbatim."""
    return df.select(
        id.cast("string").alias("id"),
        F.coalesce(text, F.lit("")).alias("text"),
        label.cast("string").alias("label"),
        (F.lit(source) if isinstance(source, str) else source).alias("source"),
        as_json(meta).alias("raw_meta"),
    )


def union_records(parts: Sequence[DataFrame]) -> DataFrame:
    """All rows of all parts, by column name."""
    return reduce(DataFrame.unionByName, parts)


def stamped(records: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Add the time of ingestion, the same for all rows, and put columns in table order.

    A row without id or source cannot be told from others and fails the job.
    """
    missing = F.raise_error(F.lit("a record has no id or no source")).cast("string")
    now = F.current_timestamp() if as_of is None else as_of
    return records.withColumns(
        {"id": F.coalesce("id", missing), "source": F.coalesce("source", missing),
         "ingested_at": now}
    ).select(*BRONZE.names)

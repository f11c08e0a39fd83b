"""All layers, one after the other."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession

from ..constants import SOURCE_CREDIBILITY
from .bronze import ingest_posts, ingest_records
from .gold import refresh_gold
from .silver import refresh_silver

log = logging.getLogger(__name__)


def refresh_layers(
    spark: SparkSession,
    paths: dict[str, str],
    parts: Sequence[DataFrame],
    lexicon: DataFrame,
    landing: str | Mapping[str, str] | None = None,
    limit: int | None = None,
    credibility: dict[str, float] | DataFrame = SOURCE_CREDIBILITY,
    as_of: Column | None = None,
) -> str:
    """Ingest records and landed posts, then refresh silver and gold.

    ``paths`` names the folders of bronze, silver and gold. The result is ``success``, or
    ``partial`` if only posts, or those of some terms, could not be ingested; anything else that
    fails raises.
    """
    status = "success"
    if parts:
        ingest_records(parts, paths["bronze"], as_of)
    if landing is not None:
        try:
            if ingest_posts(spark, landing, paths["bronze"], limit, as_of):
                status = "partial"
        except Exception:
            log.warning("posts of %s were not ingested", landing, exc_info=True)
            status = "partial"
    refresh_silver(spark, paths["bronze"], paths["silver"], as_of)
    refresh_gold(spark, paths["silver"], paths["gold"], lexicon, credibility, as_of)
    return status

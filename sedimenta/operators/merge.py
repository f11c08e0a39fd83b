"""Layer tables: reading, creating, inserting and upserting over Parquet directories.

Plain Parquet has no commit that spans files, so a table that is rewritten is never written in
place. The new version goes to a sibling folder, ``<table>__next``; when it is complete, the old
files move to ``<table>__previous`` and the new ones take their place, which are renames only. The
folder ``__previous`` exists exactly while that goes on. Whoever finds it later completes the
renames before anything else, so a table read through :func:`read_table` is the old one or the new
one, whenever the job that wrote it was lost. A table has one writer at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from ..constants import KEYS
from ..session import discard, folder_at, scratch_path
from .dedup import unique_keys

NEXT, PREVIOUS = "__next", "__previous"

# Texts take about two thirds of the place they take with the default of Parquet writers.
COMPRESSION = "zstd"


class DuplicateKeys(ValueError):
    """A batch that holds a key more than once cannot decide which row replaces the old one."""


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The table at ``path``, or None if there is none; completes a replacement that broke off."""
    complete_replacement(spark, path)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "errorifexists",
    together: bool = False,
    **options: str,
) -> None:
    """Write a table, by default refusing to touch one that is there.

    Rows of a partition are brought together first, unless they are ``together`` already.
    """
    if not together:
        df = brought_together(df, partition_by)
    options = {"compression": COMPRESSION, **options}
    df.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(path)


def brought_together(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition next to each other, so that each task writes few files.

    A hot partition is split over many tasks by size. Columns that can be derived after this step
    need not go through its shuffle.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def unmatched(df: DataFrame, other: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Rows whose key the other table does not hold; a NULL key never matches."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def upserted(target: DataFrame, batch: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Target rows without a match, and all rows of the batch."""
    return unmatched(target, batch, keys).unionByName(batch)


def merged(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> DataFrame:
    """What :func:`upserted` gives, with rows of a partition brought together by the same shuffle.

    All rows are range-partitioned by their key, the part of it that names the partition first;
    where a key has a row of the batch, its others go.
    """
    order = [c for c in partition_by if c in keys]
    order += [k for k in keys if k not in order]
    rows = target.withColumn("_new", F.lit(0)).unionByName(batch.withColumn("_new", F.lit(1)))
    rank = F.rank().over(Window.partitionBy(*order).orderBy(F.desc("_new")))
    unknown = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    ranked = rows.repartitionByRange(*order).withColumn("_rank", rank)
    return ranked.where((F.col("_rank") == 1) | unknown).drop("_new", "_rank")


def insert_new(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = KEYS,
    partition_by: Sequence[str] = (),
) -> int:
    """Append the rows whose key is new and return how many; rows already in the table stay as they are.

    A key the batch holds twice goes in once. Of a table that is partitioned by part of its key
    only the partitions of the batch are read. A batch without new rows writes nothing, and
    does not create a table.

    The keys say which rows are new, and alone are shuffled first; of the rows only those go
    through a shuffle that are written, or whose key occurs twice. The batch is computed once for
    its keys and once for its rows.
    """
    spark = batch.sparkSession
    target = read_table(spark, path, schema)
    staged_path = scratch_path(spark, "keys")
    # One struct as key, because NULLs have to meet as well.
    key = F.struct(*keys).alias("_key")
    try:
        # The hash has every column computed, so that a source that fails fails the insert.
        counts = batch.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_times"), F.max(F.xxhash64(*schema.names)).alias("_seen")
        )
        if target is not None:
            if partition_by:
                target = target.where(listed(batch, partition_by))
            counts = counts.join(target.select(*keys, F.lit(True).alias("_known")), list(keys), "left")
            counts = counts.groupBy(*keys, "_times", "_seen").agg(F.max("_known").alias("_known"))
        else:
            counts = counts.withColumn("_known", F.lit(None).cast("boolean"))
        counts.select(key, "_times", "_seen", "_known").write.option("compression", COMPRESSION).parquet(staged_path)
        staged = spark.read.parquet(staged_path)
        new, known = staged.where("_known IS NULL"), staged.where("_known")
        n_rows, n_repeated = new.agg(F.count("*"), F.count_if(F.col("_times") > 1)).head()
        if not n_rows:
            return 0
        fresh = batch.select(*schema.names).withColumn("_key", key)
        n_known = known.count()
        if n_known:
            fewer, how = (new, "left_semi") if n_rows < n_known else (known, "left_anti")
            fresh = fresh.join(fewer.select("_key"), "_key", how)
        if n_repeated:
            repeated = new.where("_times > 1").select("_key")
            once = fresh.join(repeated, "_key", "left_anti")
            several = fresh.join(repeated, "_key", "left_semi")
            fresh = once.unionByName(unique_keys(several, keys))
        fresh = fresh.select(*schema.names)
        if target is None:
            replace_table(fresh, path, partition_by)
        else:
            write_table(fresh, path, partition_by, mode="append")
        return n_rows
    finally:
        discard(spark, staged_path)


def append(
    batch: DataFrame, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> int:
    """Append rows that are known to be new, and return how many; none write nothing.

    The batch is computed once, into the scratch folder, and its rows are brought together by
    partition from there.
    """
    spark = batch.sparkSession
    staged_path = scratch_path(spark, "batch")
    try:
        batch.select(*schema.names).write.option("compression", COMPRESSION).parquet(staged_path)
        return _appended(spark.read.schema(schema).parquet(staged_path), path, partition_by)
    finally:
        discard(spark, staged_path)


def _appended(staged: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    n_rows = staged.count()
    if n_rows:
        write_table(staged, path, partition_by, mode="append")
    return n_rows


def upsert(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str] = KEYS,
    partition_by: Sequence[str] = (),
    partitions_follow_key: bool = False,
    together: bool = False,
) -> int:
    """Replace the rows whose key is in the batch, insert the others, keep the rest.

    Returns the rows of the batch.

    Without a table the batch becomes the table at once, beside its place, and moves there when its
    keys are found to be unique; ``together`` says that its rows lie as :func:`brought_together`
    puts them. Else it is computed once, into the scratch folder: its keys, partitions and rows are
    each read from there. Only partitions the batch touches are read and rewritten, unless a row
    moves to another partition; ``partitions_follow_key`` says that none ever does, which saves
    the search for such rows. A batch without rows writes nothing.
    """
    spark = batch.sparkSession
    target = read_table(spark, path, schema)
    if target is None:
        return _created(batch.select(*schema.names), path, schema, keys, partition_by, together)
    staged_path = scratch_path(spark, "batch")
    try:
        batch.select(*schema.names).write.option("compression", COMPRESSION).parquet(staged_path)
        staged = spark.read.schema(schema).parquet(staged_path)
        n_rows = staged.count()
        if not n_rows:
            return 0
        _require_unique(staged, keys)
        stays = partitions_follow_key or set(partition_by) <= set(keys)
        if partition_by and (stays or not _moves_rows(target, staged, keys, partition_by)):
            touched = target.where(listed(staged, partition_by))
            by_key = any(c in keys for c in partition_by)
            if by_key:
                content = merged(touched, staged, keys, partition_by)
            else:
                content = upserted(touched, staged, keys)
            replace_partitions(content.select(*schema.names), path, partition_by, together=by_key)
        else:
            replace_table(upserted(target, staged, keys).select(*schema.names), path, partition_by)
        return n_rows
    finally:
        discard(spark, staged_path)


def _created(
    batch: DataFrame,
    path: str,
    schema: T.StructType,
    keys: Sequence[str],
    partition_by: Sequence[str],
    together: bool,
) -> int:
    """Make the batch the table and return its rows, unless it holds a key twice."""
    spark = batch.sparkSession
    _write_next(batch, path, partition_by, together)
    written = spark.read.schema(schema).parquet(path + NEXT)
    try:
        _require_unique(written, keys)
    except DuplicateKeys:
        folder_at(spark, path).remove(NEXT)
        raise
    n_rows = written.count()
    _put_in_place(spark, path)
    return n_rows


def _require_unique(batch: DataFrame, keys: Sequence[str]) -> None:
    known = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    twice = batch.where(known).groupBy(*keys).count().where("count > 1").head()
    if twice is not None:
        raise DuplicateKeys(f"key {twice[:-1]} occurs {twice[-1]} times in the batch")


def _moves_rows(
    target: DataFrame, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str]
) -> bool:
    """Whether a matched row would change partition, and could leave its old one empty."""
    free = [c for c in partition_by if c not in keys]
    old = target.select(*keys, *[F.col(c).alias(f"_old_{c}") for c in free])
    changed = reduce(
        Column.__or__, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in free]
    )
    matched = batch.select(*keys, *free).join(old, list(keys))
    return not matched.where(changed).isEmpty()


def listed(batch: DataFrame, partition_by: Sequence[str]) -> Column:
    """Condition that selects the partitions of the batch.

    A partition is named by the JSON of its values, which also tells NULL apart. The list is no
    longer than the one of partitions that the driver makes for any scan of the table.
    """
    place = F.to_json(F.struct(*partition_by))
    return place.isin([row[0] for row in batch.select(place).distinct().collect()])


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Put ``df``, which may be computed from the table, in place of all that the table holds."""
    _write_next(df, path, partition_by)
    _put_in_place(df.sparkSession, path)


def _write_next(
    df: DataFrame, path: str, partition_by: Sequence[str], together: bool = False
) -> None:
    write_table(
        df, path + NEXT, partition_by, mode="overwrite", together=together,
        partitionOverwriteMode="static",
    )


def _put_in_place(spark: SparkSession, path: str) -> None:
    folder = folder_at(spark, path)
    if not folder.exists(""):
        folder.move(NEXT, "")
        return
    folder.make(f"{PREVIOUS}/whole")
    complete_replacement(spark, path)


def replace_partitions(
    df: DataFrame, path: str, partition_by: Sequence[str], together: bool = False
) -> None:
    """Put ``df`` in place of the partitions it has rows for; the others stay."""
    spark = df.sparkSession
    _write_next(df, path, partition_by, together)
    folder_at(spark, path).make(f"{PREVIOUS}/parts")
    complete_replacement(spark, path)


def complete_replacement(spark: SparkSession, path: str) -> None:
    """Do the renames of a replacement that are still to be done; each can break off anywhere.

    ``__previous`` is made when ``__next`` is complete, and holds a folder that says whether the
    table or partitions of it are replaced. Whatever is left in ``__next`` has not moved yet.
    """
    folder = folder_at(spark, path)
    if not folder.exists(PREVIOUS):
        return
    whole = folder.exists(f"{PREVIOUS}/whole")
    kept = f"{PREVIOUS}/{'whole' if whole else 'parts'}"
    if folder.exists(NEXT):
        for part in [""] if whole else folder.leaves(NEXT):
            if folder.exists(f"{NEXT}{part}"):
                if folder.exists(part) and not folder.exists(f"{kept}/old{part}"):
                    folder.move(part, f"{kept}/old{part}")
                folder.move(f"{NEXT}{part}", part)
        folder.remove(NEXT)
    folder.remove(PREVIOUS)

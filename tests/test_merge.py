"""Merges over Parquet tables."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from sedimenta.operators import merge
from sedimenta.operators.merge import (
    DuplicateKeys,
    insert_new,
    read_table,
    upsert,
    write_table,
)
from sedimenta.session import Folder, folder_at

SCHEMA = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "source", "text", "split")]
)


@pytest.fixture
def path(tmp_path):
    return str(tmp_path / "table")


def rows(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


def content(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, SCHEMA).select(*SCHEMA.names).collect())


OLD = [("1", "a", "old", "train"), ("2", "a", "old", "val"), ("1", "b", "old", "train")]
NEW = [("1", "a", "new", "train"), ("3", "a", "new", "train"), ("2", "b", "new", "test")]
UPSERTED = sorted([*NEW, OLD[1], OLD[2]])
INSERTED = sorted([*OLD, NEW[1], NEW[2]])


def test_no_table(spark, path):
    assert read_table(spark, path, SCHEMA) is None


def test_create_refuses_to_overwrite(spark, path):
    write_table(rows(spark, *OLD), path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        write_table(rows(spark, *NEW), path)
    assert content(spark, path) == sorted(OLD)


def test_insert(spark, path):
    for batch, expected in ((OLD, sorted(OLD)), (OLD, sorted(OLD)), (NEW, INSERTED), (NEW, INSERTED)):
        insert_new(rows(spark, *batch), path, SCHEMA)
        assert content(spark, path) == expected


def test_insert_takes_one_row_per_key(spark, path):
    twice = [("1", "a", "y", "train"), ("1", "a", "x", "val"), ("1", "a", "x", "train")]
    insert_new(rows(spark, *twice), path, SCHEMA)
    assert content(spark, path) == [("1", "a", "x", "train")]


def test_insert_of_nothing_makes_no_table(spark, path):
    insert_new(rows(spark), path, SCHEMA)
    assert read_table(spark, path, SCHEMA) is None


def test_insert_into_partitions(spark, path, tmp_path):
    for batch, expected in ((OLD, sorted(OLD)), (NEW, INSERTED), (NEW, INSERTED)):
        insert_new(rows(spark, *batch), path, SCHEMA, partition_by=["source"])
        assert content(spark, path) == expected
    files = sorted((tmp_path / "table").rglob("*"))
    insert_new(rows(spark, *OLD), path, SCHEMA, partition_by=["source"])
    assert sorted((tmp_path / "table").rglob("*")) == files


@pytest.mark.parametrize("partition_by", [[], ["source"], ["source", "split"]])
def test_upsert(spark, path, partition_by):
    for batch, expected in ((OLD, sorted(OLD)), (OLD, sorted(OLD)), (NEW, UPSERTED), (NEW, UPSERTED)):
        upsert(rows(spark, *batch), path, SCHEMA, partition_by=partition_by)
        assert content(spark, path) == expected


def test_upsert_leaves_other_partitions_alone(spark, path, tmp_path):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source"])
    before = sorted((tmp_path / "table" / "source=b").iterdir())
    upsert(rows(spark, NEW[0]), path, SCHEMA, partition_by=["source"])
    assert sorted((tmp_path / "table" / "source=b").iterdir()) == before


def test_upsert_of_a_row_that_changes_partition(spark, path):
    """The partition it leaves has no other row and must not keep the old one."""
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source", "split"])
    upsert(rows(spark, ("2", "a", "new", "test")), path, SCHEMA, partition_by=["source", "split"])
    assert content(spark, path) == sorted([OLD[0], OLD[2], ("2", "a", "new", "test")])


def test_upsert_of_nothing_writes_nothing(spark, path, tmp_path):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source"])
    before = sorted((tmp_path / "table").rglob("*"))
    upsert(rows(spark), path, SCHEMA, partition_by=["source"])
    assert sorted((tmp_path / "table").rglob("*")) == before


class Lost(Exception):
    """The driver is lost."""


STEPS = ("make", "move", "remove")


@pytest.mark.parametrize("partition_by", [[], ["source"]])
@pytest.mark.parametrize("after", range(8))
def test_a_replacement_that_breaks_off_loses_nothing(spark, path, monkeypatch, partition_by, after):
    """Lost after each number of steps; the next reader finds the old rows or the new ones."""
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=partition_by)
    left = [after]

    def failing(step):
        def run(self, *args):
            if not left[0]:
                raise Lost
            left[0] -= 1
            return step(self, *args)

        return run

    with monkeypatch.context() as patch:
        for name in STEPS:
            patch.setattr(Folder, name, failing(getattr(Folder, name)))
        try:
            upsert(rows(spark, *NEW), path, SCHEMA, partition_by=partition_by)
        except Lost:
            pass
    assert content(spark, path) in (sorted(OLD), UPSERTED)
    upsert(rows(spark, *NEW), path, SCHEMA, partition_by=partition_by)
    assert content(spark, path) == UPSERTED
    assert not any(folder_at(spark, path).exists(n) for n in (merge.NEXT, merge.PREVIOUS))


@pytest.mark.parametrize("partition_by", [[], ["source"]])
def test_a_write_that_fails_loses_nothing(spark, path, monkeypatch, partition_by):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=partition_by)
    write = merge.write_table

    def broken(df, *args, **options):
        write(df.withColumn("text", merge.F.raise_error(merge.F.lit("disk"))), *args, **options)

    with monkeypatch.context() as patch:
        patch.setattr(merge, "write_table", broken)
        with pytest.raises(Exception, match="disk"):
            upsert(rows(spark, *NEW), path, SCHEMA, partition_by=partition_by)
    assert content(spark, path) == sorted(OLD)
    upsert(rows(spark, *NEW), path, SCHEMA, partition_by=partition_by)
    assert content(spark, path) == UPSERTED


def test_the_first_upsert_rejects_a_key_that_occurs_twice_too(spark, path):
    with pytest.raises(DuplicateKeys):
        upsert(rows(spark, NEW[0], NEW[0]), path, SCHEMA)
    assert read_table(spark, path, SCHEMA) is None


def test_partitions_that_follow_the_key_are_not_searched(spark, path, monkeypatch):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source", "split"])
    monkeypatch.setattr(merge, "_moves_rows", lambda *_: pytest.fail("searched"))
    upsert(
        rows(spark, NEW[0]), path, SCHEMA, partition_by=["source", "split"],
        partitions_follow_key=True,
    )
    assert content(spark, path) == sorted([NEW[0], OLD[1], OLD[2]])


def test_upsert_rejects_a_key_that_occurs_twice(spark, path):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source"])
    with pytest.raises(DuplicateKeys):
        upsert(rows(spark, NEW[0], ("1", "a", "x", "val")), path, SCHEMA, partition_by=["source"])
    assert content(spark, path) == sorted(OLD)


def test_upsert_clears_its_scratch_folder(spark, path, tmp_path, monkeypatch):
    scratch = tmp_path / "scratch"
    monkeypatch.setattr(merge, "scratch_path", lambda _, name: f"{scratch}/{name}")
    for partition_by in (["source"], []):
        target = f"{path}-{len(partition_by)}"
        upsert(rows(spark, *OLD), target, SCHEMA, partition_by=partition_by)
        upsert(rows(spark, *NEW), target, SCHEMA, partition_by=partition_by)
        assert content(spark, target) == UPSERTED
        with pytest.raises(DuplicateKeys):
            upsert(rows(spark, NEW[0], NEW[0]), target, SCHEMA, partition_by=partition_by)
        assert list(scratch.iterdir()) == []


def test_null_keys_never_match(spark, path):
    upsert(rows(spark, ("1", None, "old", "train")), path, SCHEMA, partition_by=["source"])
    upsert(rows(spark, ("1", None, "new", "train")), path, SCHEMA, partition_by=["source"])
    found = [r.text for r in read_table(spark, path, SCHEMA).collect()]
    assert sorted(found) == ["new", "old"]


def test_failing_batch_leaves_the_table(spark, path):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source"])
    bad = rows(spark, *NEW).withColumn("text", merge.F.raise_error(merge.F.lit("bad row")))
    with pytest.raises(Exception, match="bad row"):
        upsert(bad, path, SCHEMA, partition_by=["source"])
    assert content(spark, path) == sorted(OLD)


def test_only_touched_partitions_are_read(spark, path, plan):
    upsert(rows(spark, *OLD), path, SCHEMA, partition_by=["source", "split"])
    target = read_table(spark, path, SCHEMA)
    touched = merge.listed(rows(spark, NEW[0]), ["source", "split"])
    filters = plan(target.where(touched)).split("PartitionFilters: [")[1]
    assert filters.startswith("(invoke(StructsToJson")
    assert target.where(touched).count() == 1


def test_hot_partition_is_written_by_many_tasks(spark, path, tmp_path):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        hot = spark.range(0, 60_000, 1, 8).selectExpr(
            "CAST(id AS STRING) AS id", "IF(id % 3 = 0, 'hot', CAST(id % 50 AS STRING)) AS source",
            "sha2(CAST(id AS STRING), 512) AS text", "'train' AS split",
        )
        write_table(hot, path, ["source"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
    files = [f for f in (tmp_path / "table" / "source=hot").iterdir() if f.suffix == ".parquet"]
    assert len(files) > 4
    assert read_table(spark, path, SCHEMA).count() == 60_000


def test_an_insert_without_news_shuffles_no_rows(spark, path, monkeypatch):
    """No row is told from its copies by a shuffle if its key is there; a failing source still fails."""
    from sedimenta.operators.merge import insert_new

    assert insert_new(rows(spark, *OLD, OLD[0]), path, SCHEMA, partition_by=["source"]) == len(OLD)
    monkeypatch.setattr(merge, "unique_keys", lambda *_: pytest.fail("shuffled"))
    assert insert_new(rows(spark, *OLD), path, SCHEMA, partition_by=["source"]) == 0
    assert content(spark, path) == sorted(OLD)
    broken = rows(spark, *OLD).withColumn("text", merge.F.raise_error(merge.F.lit("source down")))
    with pytest.raises(Exception, match="source down"):
        insert_new(broken, path, SCHEMA, partition_by=["source"])


@pytest.mark.parametrize("partition_by", [[], ["source"]])
def test_a_first_upsert_writes_its_rows_once(spark, path, monkeypatch, partition_by):
    monkeypatch.setattr(merge, "scratch_path", lambda *_: pytest.fail("written twice"))
    assert upsert(rows(spark, *OLD), path, SCHEMA, partition_by=partition_by) == len(OLD)
    assert content(spark, path) == sorted(OLD)


def test_tables_are_compressed_well(spark, path):
    write_table(rows(spark, *OLD), path)
    assert all(f.endswith(".zstd.parquet") for f in read_table(spark, path, SCHEMA).inputFiles())


def test_a_merge_takes_one_exchange(spark, path, plan):
    from sedimenta.operators.merge import merged

    keys = ["id", "source"]
    found = merged(rows(spark, *OLD), rows(spark, *NEW), keys, ["source"])
    assert plan(found).split("\n\n\n")[0].count("Exchange") == 1
    assert sorted(tuple(r) for r in found.collect()) == UPSERTED

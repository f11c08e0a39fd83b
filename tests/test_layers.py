"""Bronze to gold as a whole."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import tables as given
from sedimenta.operators.export import export_splits, read_export
from sedimenta.operators.merge import read_table
from sedimenta.plans.bronze import ingest_records
from sedimenta.plans.gold import refresh_gold, to_gold
from sedimenta.plans.layers import refresh_layers
from sedimenta.plans.silver import refresh_silver, to_silver
from sedimenta.schemas import BRONZE, GOLD, SILVER

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def layers(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("layers")
    paths = {n: str(root / n) for n in ("bronze", "silver", "gold")}
    parts = [f(spark, FOLDER) for f in (given.document_records, given.page_records)]

    def refresh():
        ingest_records(parts, paths["bronze"])
        refresh_silver(spark, paths["bronze"], paths["silver"])
        refresh_gold(spark, paths["silver"], paths["gold"], given.lexicon(spark))
        return {
            "bronze": read_table(spark, paths["bronze"], BRONZE),
            "silver": read_table(spark, paths["silver"], SILVER),
            "gold": read_table(spark, paths["gold"], GOLD),
        }

    return refresh


def test_layers(layers, spark, tmp_path):
    tables = layers()
    stable = {n: t.drop("ingested_at", "processed_at", "featurized_at") for n, t in tables.items()}
    before = {n: sorted(map(str, t.collect())) for n, t in stable.items()}
    times = {r.ingested_at for r in tables["silver"].collect()}

    for table in tables.values():
        assert table.groupBy("id", "source").count().where("count > 1").count() == 0
    assert len(before["silver"]) <= len(before["bronze"])
    assert 0 < len(before["gold"]) < len(before["silver"])
    splits = {r.split: r["count"] for r in tables["gold"].groupBy("split").count().collect()}
    assert sum(splits.values()) == len(before["gold"]) and set(splits) <= {"train", "val", "test"}

    train, val = export_splits(tables["gold"], str(tmp_path))
    assert read_export(spark, train).count() == splits["train"]
    assert read_export(spark, val).count() == splits["val"]

    again = layers()
    for name, table in again.items():
        rows = table.drop("ingested_at", "processed_at", "featurized_at").collect()
        assert sorted(map(str, rows)) == before[name]
    # The time of ingestion is that of the first run.
    assert {r.ingested_at for r in again["silver"].collect()} == times


def test_all_layers_at_once(spark, tmp_path):
    paths = {n: str(tmp_path / n) for n in ("bronze", "silver", "gold")}
    parts = [given.document_records(spark, FOLDER)]
    landing = given.landed(given.posts(spark, FOLDER))

    def refresh(source, folder):
        return refresh_layers(spark, paths, source, given.lexicon(spark), folder, limit=None)

    assert refresh(parts, str(tmp_path / "nothing landed")) == "partial"
    gold = read_table(spark, paths["gold"], GOLD).count()
    assert gold > 0
    assert refresh([], landing) == "success"
    silver = read_table(spark, paths["silver"], SILVER)
    assert silver.where("source = 'bluesky'").count() > 0
    # Posts have no known class, so none of them gets to gold.
    assert read_table(spark, paths["gold"], GOLD).count() == gold
    files = sorted(p for layer in paths.values() for p in Path(layer).rglob("*.parquet"))
    assert refresh(parts, landing) == "success"
    assert sorted(p for layer in paths.values() for p in Path(layer).rglob("*.parquet")) == files
    failing = parts[0].withColumn("text", F.raise_error(F.lit("source down")).cast("string"))
    with pytest.raises(Exception, match="source down"):
        refresh([failing], landing)


def test_refreshes_take_up_new_rows_only_and_count(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("bronze", "silver", "gold")]
    first = [("1", "One text", "true"), ("2", "One text", "fake"), ("3", "Two", "fake"), ("4", " ", "true")]
    more = [("5", "Two", "true"), ("6", "Three", "true"), ("7", "Three", "fake")]

    def refresh(rows, day, **options):
        df = spark.createDataFrame(rows, "id string, text string, label string")
        df = df.select("*", F.lit("s").alias("source"), F.lit("{}").alias("raw_meta"))
        as_of = F.lit(f"2024-01-0{day}").cast("timestamp")
        ingest_records([df], paths[0], as_of)
        counts = refresh_silver(spark, *paths[:2], as_of, **options)
        return counts, refresh_gold(spark, *paths[1:], given.lexicon(spark), as_of=as_of, **options)

    assert refresh(first, 1) == ({"rows_before": 4, "rows_after": 2}, {0: 1, 1: 1})
    assert refresh(more, 2) == ({"rows_before": 2, "rows_after": 1}, {0: 2, 1: 1})
    assert refresh([], 3) == ({"rows_before": 0, "rows_after": 0}, {0: 2, 1: 1})
    assert refresh([], 4, full=True) == ({"rows_before": 7, "rows_after": 3}, {0: 2, 1: 1})
    assert {r.id for r in read_table(spark, paths[1], SILVER).collect()} == {"1", "3", "6"}


@pytest.fixture
def grown(spark, tmp_path):
    """Three layers, and a second delivery that has not been taken up yet."""
    paths = [str(tmp_path / n) for n in ("bronze", "silver", "gold")]

    def deliver(rows, day):
        df = spark.createDataFrame(rows, "id string, text string, label string, source string")
        as_of = F.lit(f"2024-01-0{day}").cast("timestamp")
        ingest_records([df.withColumn("raw_meta", F.lit("{}"))], paths[0], as_of)

    def refresh():
        return (
            refresh_silver(spark, *paths[:2]),
            refresh_gold(spark, *paths[1:], given.lexicon(spark)),
        )

    deliver([(str(n), f"Text {n}", "true", "s" if n % 2 else "t/#?") for n in range(20)], 1)
    refresh()
    more = [("21", "Text 1", "fake", "s"), ("22", "Text 2", "true", "s"), ("23", "New", "fake", "s")]
    deliver(more, 2)
    return paths, refresh


def test_a_refresh_reads_no_old_text(spark, grown, plan, monkeypatch):
    from sedimenta.operators import deliveries
    from sedimenta.plans import silver

    paths, refresh = grown
    plans = []

    def noted(bronze, old):
        found = new_texts(bronze, old)
        plans.append(plan(found))
        return found

    new_texts = silver.new_texts
    monkeypatch.setattr(silver, "new_texts", noted)
    assert refresh() == ({"rows_before": 2, "rows_after": 2}, {0: 21, 1: 1})
    [text] = plans
    scans = [part for part in text.split("\n\n") if "Scan parquet" in part and "Location" in part]
    bronze = [s for s in scans if "/bronze/" in s]
    # Of bronze the new file only, of silver the digests of its source, and texts only of rows
    # that have no digest: there are none, and files say so.
    assert len(bronze) == 1 and bronze[0].count(".parquet") == 1
    stored = [s for s in scans if "text_digest" in s and "ReadSchema: struct<text_digest:binary>" in s]
    assert len(stored) == 1 and "PartitionFilters: [" in stored[0] and "source" in stored[0]
    older = [s for s in scans if "text:string" in s and "/silver" in s]
    assert all("IsNull(text_digest)" in s for s in older)
    # Nothing new: no layer is read at all.
    monkeypatch.setattr(silver, "new_texts", None)
    monkeypatch.setattr(deliveries, "rows_of", None)
    assert refresh() == ({"rows_before": 0, "rows_after": 0}, {0: 21, 1: 1})


def test_files_that_were_not_noted_are_taken_again_without_doubles(spark, grown, monkeypatch):
    from sedimenta.plans import gold, silver

    paths, refresh = grown

    def lost(*_, **__):
        raise OSError("lost")

    for module in (silver, gold):
        note = module.note_files
        monkeypatch.setattr(module, "note_files", lost)
        with pytest.raises(OSError, match="lost"):
            refresh()
        monkeypatch.setattr(module, "note_files", note)
    assert refresh()[1] == {0: 21, 1: 1}
    for path, schema, n in ((paths[1], SILVER, 22), (paths[2], GOLD, 22)):
        table = read_table(spark, path, schema)
        assert table.count() == table.select("id", "source").distinct().count() == n


def test_a_silver_table_without_digests_is_refreshed(spark, grown):
    from sedimenta.operators.merge import replace_table
    from sedimenta.schemas import SILVER_PARTITIONS

    paths, refresh = grown
    replace_table(read_table(spark, paths[1], SILVER), paths[1], SILVER_PARTITIONS)
    assert refresh() == ({"rows_before": 2, "rows_after": 2}, {0: 21, 1: 1})
    full = refresh_silver(spark, *paths[:2], full=True)
    assert full == {"rows_before": 23, "rows_after": 22}
    assert refresh() == ({"rows_before": 0, "rows_after": 0}, {0: 21, 1: 1})


def test_classes_are_counted_once_per_file(spark, grown, monkeypatch):
    from sedimenta.plans import gold

    paths, refresh = grown
    assert refresh()[1] == {0: 21, 1: 1}
    monkeypatch.setattr(gold, "rows_of", None)
    assert gold.class_counts(spark, paths[2]) == {0: 21, 1: 1}
    monkeypatch.undo()
    # Files that are replaced count no more.
    counts = refresh_gold(spark, *paths[1:], given.lexicon(spark), full=True)
    assert counts == {0: 21, 1: 1}
    assert gold.class_counts(spark, paths[2]) == counts


def test_schemas(spark):
    silver = to_silver(given.bronze(spark, FOLDER))
    gold = to_gold(silver, given.lexicon(spark))
    for df, schema in ((silver, SILVER), (gold, GOLD)):
        assert [(f.name, f.dataType) for f in df.schema] == [(f.name, f.dataType) for f in schema]


def test_missing_layers(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        refresh_silver(spark, str(tmp_path / "none"), str(tmp_path / "silver"))
    with pytest.raises(FileNotFoundError):
        refresh_gold(spark, str(tmp_path / "none"), str(tmp_path / "gold"), given.lexicon(spark))


def test_texts_equal_after_cleaning_both_stay(spark):
    df = spark.createDataFrame(
        [("1", "Same", "true", "s"), ("2", "same", "true", "s"), ("3", "Same", "true", "t"),
         ("4", "Same", "true", "s"), ("5", None, "true", "s"), ("6", " ", "true", "s")],
        "id string, text string, label string, source string",
    ).select("*", F.lit("{}").alias("raw_meta"), given.as_of().alias("ingested_at"))
    assert {r.id for r in to_silver(df).collect()} == {"1", "2", "3"}


def test_plan_of_the_silver_build(spark, plan, tmp_path):
    path = str(tmp_path / "bronze")
    given.bronze(spark, FOLDER).write.parquet(path)
    bronze = read_table(spark, path, BRONZE)
    text = plan(to_silver(bronze))
    assert text.split("\n\n\n")[0].count("Exchange") == 1
    assert "PushedFilters: [IsNotNull(text)]" in text
    for name in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert name not in text
    narrow = plan(to_silver(bronze).groupBy("label_binary").count())
    assert "raw_meta" not in narrow


def test_plan_of_the_gold_build(spark, plan, tmp_path):
    path = str(tmp_path / "silver")
    to_silver(given.bronze(spark, FOLDER)).write.partitionBy("source").parquet(path)
    silver = read_table(spark, path, SILVER)
    text = plan(to_gold(silver, given.lexicon(spark)))
    assert "Exchange" not in text and "Python" not in text
    assert "Not(EqualTo(label_binary,-1))" in text
    assert "raw_meta" not in text


def test_split_export_reads_one_partition_and_two_columns(spark, plan, tmp_path):
    path = str(tmp_path / "gold")
    gold = to_gold(to_silver(given.bronze(spark, FOLDER)), given.lexicon(spark))
    gold.write.partitionBy("source", "split").parquet(path)
    from sedimenta.operators.export import split_rows

    text = plan(split_rows(read_table(spark, path, GOLD), "train"))
    assert "ReadSchema: struct<text_clean:string,label_binary:int>" in text
    assert "PartitionFilters: [isnotnull(split" in text

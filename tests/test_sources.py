"""Statements, headlines and posts from files."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from sedimenta.plans.bronze import ingest_posts, ingest_records
from sedimenta.operators.merge import read_table
from sedimenta.schemas import BRONZE
from sedimenta.sources.posts import post_records, read_posts
from sedimenta.sources.records import raw_records, stamped
from sedimenta.sources.static import (
    headline_records,
    read_indexed_splits,
    read_splits,
    statement_records,
)
from sedimenta.streaming.posts import stream_posts

NAMES = ["false", "half-true", "mostly-true", "true", "barely-true", "pants-fire"]


def by_id(df):
    return {r.id: r for r in df.collect()}


def test_record(spark):
    df = spark.createDataFrame([(1, None, "Weird Label ")], "a long, b string, c string")
    row = raw_records(df, F.col("a"), F.col("b"), F.col("c"), "s", []).head()
    assert tuple(row) == ("1", "", "Weird Label ", "s", "{}")


def test_stamped_rows_share_one_time_and_have_table_order(spark):
    df = spark.range(100).select(*[F.lit("x").alias(c) for c in BRONZE.names if c != "ingested_at"])
    rows = stamped(df.repartition(8))
    assert rows.columns == BRONZE.names
    assert rows.select("ingested_at").distinct().count() == 1


@pytest.mark.parametrize("column", ["id", "source"])
def test_a_record_needs_a_key(spark, column):
    df = spark.range(3).select(*[F.lit("x").alias(c) for c in BRONZE.names if c != "ingested_at"])
    assert stamped(df).count() == 3
    with pytest.raises(Exception, match="no id or no source"):
        stamped(df.withColumn(column, F.lit(None).cast("string"))).collect()


@pytest.mark.parametrize("format", ["parquet", "json", "csv"])
def test_statements(spark, tmp_path, format):
    df = spark.createDataFrame(
        [("a.json", "Claim one", 0, "me"), ("b.json", None, 5, None)],
        "id string, statement string, label int, speaker string",
    )
    paths = {}
    for split in ("train", "test"):
        paths[split] = str(tmp_path / split)
        df.withColumn("id", F.concat("id", F.lit(split))).write.format(format).save(paths[split])
    rows = read_splits(spark, paths, format, df.schema)
    found = by_id(statement_records(rows, NAMES))
    assert len(found) == 4
    one, two = found["a.jsontrain"], found["b.jsontest"]
    assert (one.text, one.label, one.source) == ("Claim one", "false", "liar")
    assert json.loads(one.raw_meta) == {"speaker": "me", "split": "train"}
    assert (two.text, two.label) == ("", "pants-fire")
    assert json.loads(two.raw_meta) == {"speaker": None, "split": "test"}


def test_missing_split_fails(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        read_splits(spark, {"train": str(tmp_path / "none")})


HEADLINES = [("A", "u", "d", 3, 1), ("B", None, None, None, 0), (None, "v", "e", 0, None)]


def headline_frame(spark):
    return spark.createDataFrame(
        [(n, *row) for n, row in enumerate(HEADLINES)],
        "n int, title string, news_url string, source_domain string, tweet_num int, real int",
    )


def test_headlines(spark):
    rows = headline_frame(spark).withColumn("split", F.lit("train"))
    found = by_id(headline_records(rows, order=["n"]))
    assert sorted(found) == ["train_0", "train_1", "train_2"]
    assert [found[f"train_{n}"].label for n in range(3)] == ["real", "fake", "fake"]
    assert [found[f"train_{n}"].text for n in range(3)] == ["A", "B", ""]
    assert json.loads(found["train_0"].raw_meta) == {
        "news_url": "u", "source_domain": "d", "tweet_num": 3, "split": "train"
    }


def test_headlines_without_optional_columns(spark):
    rows = spark.createDataFrame([("t", 0)], "split string, row_index long")
    row = headline_records(rows).head()
    assert (row.id, row.text, row.label, row.source) == ("t_0", "", "fake", "fakenewsnet")
    assert json.loads(row.raw_meta) == {
        "news_url": "", "source_domain": "", "tweet_num": 0, "split": "t"
    }


def test_headlines_need_an_order(spark):
    with pytest.raises(ValueError, match="order"):
        headline_records(spark.createDataFrame([("t", "x")], "split string, title string"))


def test_headlines_are_numbered_over_the_files_of_a_split(spark, tmp_path):
    for split, files in {"train": 3, "val": 2}.items():
        for number in range(files):
            part = spark.range(number * 100, number * 100 + 100, 1, 1)
            path = str(tmp_path / split / f"file-{number}")
            part.selectExpr("CAST(id AS STRING) AS title").write.parquet(path)
    paths = {s: str(tmp_path / s / "file-*") for s in ("train", "val")}
    rows = read_indexed_splits(spark, paths)
    found = by_id(headline_records(rows))
    assert len(found) == 500
    assert all(r.text == i.split("_")[1] for i, r in found.items())


POSTS = [
    {"uri": "at://1", "cid": "c", "indexed_at": "2024-01-02", "record": {"text": "Hi"},
     "author": {"did": "d", "handle": "h"}, "reply_count": 1, "repost_count": 2,
     "like_count": 3, "query": "news"},
    {"uri": "at://2", "query": "politics"},
    {"uri": "", "record": {"text": "no uri"}, "query": "news"},
    {"record": {"text": "no uri either"}, "query": "news"},
    {"uri": "at://3", "like_count": "many", "record": {"text": "odd count"}, "query": "news"},
]


def land(path, posts, name="posts.json", extra=()):
    path.mkdir(exist_ok=True)
    lines = [json.dumps(p) for p in posts] + list(extra)
    (path / name).write_text("\n".join(lines) + "\n")
    return str(path)


def test_posts(spark, tmp_path):
    path = land(tmp_path / "in", POSTS, extra=["not a post {"])
    found = by_id(post_records(read_posts(spark, path)))
    assert sorted(found) == ["at://1", "at://2", "at://3"]
    one, two = found["at://1"], found["at://2"]
    assert (one.text, one.label, one.source) == ("Hi", "unknown", "bluesky")
    assert json.loads(one.raw_meta) == {
        "cid": "c", "author_did": "d", "author_handle": "h", "indexed_at": "2024-01-02",
        "reply_count": 1, "repost_count": 2, "like_count": 3, "query": "news",
    }
    assert two.text == ""
    assert json.loads(two.raw_meta)["like_count"] == 0
    assert found["at://3"].text == "odd count"


def cut_gzip(folder):
    """A compressed file of many posts that breaks off."""
    lines = "".join(json.dumps({"uri": f"cut://{n}", "query": "q"}) + "\n" for n in range(5_000))
    whole = gzip.compress(lines.encode())
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "cut.json.gz").write_bytes(whole[: len(whole) // 2])


def test_a_file_that_breaks_off_fails_the_ingest(spark, tmp_path):
    path, table = land(tmp_path / "in", POSTS), str(tmp_path / "bronze")
    cut_gzip(tmp_path / "in")
    with pytest.raises(Exception, match="(?i)unexpected end|corrupt|cannot read|FAILED_READ_FILE"):
        ingest_posts(spark, path, table)
    assert read_table(spark, table, BRONZE) is None


def test_a_failing_term_spares_the_others(spark, tmp_path, caplog):
    cut_gzip(tmp_path / "bad")
    terms = {"news": land(tmp_path / "in", POSTS), "bad": str(tmp_path / "bad"), "none": str(tmp_path / "no")}
    table = str(tmp_path / "bronze")
    with caplog.at_level("WARNING"):
        assert ingest_posts(spark, terms, table) == ["bad", "none"]
    assert "'bad'" in caplog.text and "'none'" in caplog.text
    assert read_table(spark, table, BRONZE).count() == 3


def test_broken_lines_are_counted_and_kept(spark, tmp_path, caplog):
    broken = ["not a post {", '{"uri": "at://9", "cid": "x", "rec']
    path = land(tmp_path / "in", POSTS, extra=broken)
    quarantine = str(tmp_path / "quarantine")
    with caplog.at_level("WARNING"):
        ingest_posts(spark, path, str(tmp_path / "bronze"), quarantine=quarantine)
    assert "2 landed lines" in caplog.text
    assert sorted(r.line for r in spark.read.parquet(quarantine).collect()) == sorted(broken)


def test_a_batch_that_is_tried_again_adds_nothing_twice(spark, tmp_path, monkeypatch):
    """The insert is lost after the quarantine was written; the stream tries the batch again."""
    from sedimenta.plans import bronze

    broken = ["not a post {", "not a post {", '{"uri": "at://9", "cid": "x", "rec']
    path = land(tmp_path / "in", POSTS, extra=broken)
    table, quarantine, marks = (str(tmp_path / n) for n in ("bronze", "quarantine", "marks"))

    def run():
        stream_posts(spark, path, table, marks, quarantine=quarantine).awaitTermination()

    def lost(*_, **__):
        raise OSError("lost")

    ingest = bronze.ingest_records
    monkeypatch.setattr(bronze, "ingest_records", lost)
    with pytest.raises(Exception, match="lost"):
        run()
    assert read_table(spark, table, BRONZE) is None
    monkeypatch.setattr(bronze, "ingest_records", ingest)
    for _ in range(2):
        run()
        assert read_table(spark, table, BRONZE).count() == 3
        rows = spark.read.parquet(quarantine).collect()
        assert sorted((r.line, r.times) for r in rows) == sorted([(broken[0], 2), (broken[2], 1)])
    # Without the marks of the stream all is read again.
    stream_posts(spark, path, table, str(tmp_path / "new"), quarantine=quarantine).awaitTermination()
    assert spark.read.parquet(quarantine).count() == 2


def test_lines_are_parsed_once(spark, tmp_path, monkeypatch):
    from sedimenta.plans import bronze

    path, scans = land(tmp_path / "in", POSTS, extra=["not a post {"]), []
    insert = bronze.insert_new
    monkeypatch.setattr(bronze, "insert_new", lambda df, *a, **k: (
        scans.append(df._jdf.queryExecution().executedPlan().toString()), insert(df, *a, **k)
    )[1])
    ingest_posts(spark, path, str(tmp_path / "bronze"), quarantine=str(tmp_path / "quarantine"))
    assert len(scans) == 2 and not any("json" in s.lower().split("filescan ")[-1][:20] for s in scans)
    assert all("FileScan parquet" in s for s in scans)


def test_all_posts_are_taken_unless_limited(spark, tmp_path):
    many = [{"uri": f"at://{n}", "query": "news", "indexed_at": str(n)} for n in range(500)]
    path = land(tmp_path / "in", many)
    ingest_posts(spark, path, str(tmp_path / "all"))
    assert read_table(spark, str(tmp_path / "all"), BRONZE).count() == 500
    ingest_posts(spark, path, str(tmp_path / "some"), limit=40)
    assert read_table(spark, str(tmp_path / "some"), BRONZE).count() == 10


def test_ingest_posts_twice(spark, tmp_path):
    path, table = land(tmp_path / "in", POSTS), str(tmp_path / "bronze")
    for _ in range(2):
        ingest_posts(spark, path, table)
        assert read_table(spark, table, BRONZE).count() == 3


def test_no_posts_no_table(spark, tmp_path):
    path, table = land(tmp_path / "in", POSTS[2:4]), str(tmp_path / "bronze")
    ingest_posts(spark, path, table)
    assert read_table(spark, table, BRONZE) is None


def test_a_failing_source_fails_the_ingest(spark, tmp_path):
    good = spark.createDataFrame([("1", "t", "l", "s", "{}")], "id string, text string,"
                                 " label string, source string, raw_meta string")
    bad = good.withColumn("text", F.raise_error(F.lit("source down")).cast("string"))
    with pytest.raises(Exception, match="source down"):
        ingest_records([good, bad], str(tmp_path / "bronze"))
    # What a failed write leaves behind is no table content.
    table = read_table(spark, str(tmp_path / "bronze"), BRONZE)
    assert table is None or table.count() == 0


def test_stream(spark, tmp_path):
    landing = tmp_path / "in"
    path, table, marks = land(landing, POSTS), str(tmp_path / "bronze"), str(tmp_path / "marks")

    def run(**options):
        stream_posts(spark, path, table, marks, **options).awaitTermination()
        return by_id(read_table(spark, table, BRONZE))

    first = run()
    assert sorted(first) == ["at://1", "at://2", "at://3"]
    changed = {**POSTS[0], "record": {"text": "edited"}}
    land(landing, [changed, POSTS[1], {"uri": "at://4", "query": "news"}], "more.json")
    land(landing, [{"uri": "at://4", "query": "politics"}], "again.json")
    second = run(max_files=1)
    assert sorted(second) == ["at://1", "at://2", "at://3", "at://4"]
    assert second["at://1"] == first["at://1"]
    assert read_table(spark, table, BRONZE).count() == 4
    # A stream without its marks starts over and still adds nothing.
    stream_posts(spark, path, table, str(tmp_path / "new marks")).awaitTermination()
    assert read_table(spark, table, BRONZE).count() == 4


def test_rows_stay_where_they_are_when_files_number_them(spark, tmp_path, plan):
    """Only counts per file meet the rows, by a broadcast; no row goes to the task of its file."""
    path = str(tmp_path / "headlines")
    spark.range(0, 3000, 1, 4).selectExpr("id", "repeat('x', 50) AS title").write.parquet(path)
    from sedimenta.sources.static import read_indexed_splits

    indexed = read_indexed_splits(spark, {"all": path})
    text = plan(indexed)
    assert "BroadcastHashJoin" in text and "hashpartitioning" not in text
    assert sorted(r.row_index for r in indexed.collect()) == list(range(3000))


def test_headline_files_grow_in_number(spark, plan, monkeypatch):
    """As many files as there are shuffle partitions, so that no task reads a fifth of all rows."""
    from checks.queries import QUERIES

    monkeypatch.setattr("checks.queries.scratch_path", lambda *_: path)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/headline-files"
    found = QUERIES["ingest_headline_files"](spark, "/root/testdata/sf0.01")
    assert found.count() == 1000
    assert len(spark.read.parquet(path).inputFiles()) == 8

"""Row numbers and best rows of groups, with hot groups."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from sedimenta.operators.ranking import cap_per_term, posts_per_term, row_index, top_per_group


def rows(n, seed=0):
    """A third of the rows is in one group."""
    rng = random.Random(seed)
    numbers = rng.sample(range(10 * n), n)
    return [(f"g{rng.randrange(6)}" if i % 3 else "hot", o, f"v{o}") for i, o in enumerate(numbers)]


@pytest.fixture(params=["10m", "-1"])
def threshold(spark, request):
    """Joins with and without a broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", request.param)
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_row_index(spark, threshold):
    given = rows(5000)
    df = spark.createDataFrame(given, "g string, o long, v string").repartition(8)
    expected = defaultdict(list)
    for g, o, _ in sorted(given):
        expected[g].append(o)
    found = row_index(df, ["g"], ["o"]).collect()
    assert len(found) == len(given)
    assert all(expected[r.g][r.row_index] == r.o for r in found)
    assert all(r.v == f"v{r.o}" for r in found)


def test_row_index_spreads_a_hot_group(spark, tmp_path, monkeypatch):
    """All rows are one group, and several tasks sort and number them."""
    path = tmp_path / "sorted"
    monkeypatch.setattr("sedimenta.operators.ranking.scratch_path", lambda *_: str(path))
    df = spark.range(0, 200_000, 1, 8).selectExpr("'all' AS g", "id * 7 % 200003 AS o")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = row_index(df, ["g"], ["o"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(list(path.glob("part-*"))) > 1
    wrong = indexed.selectExpr("row_index AS i", "rank() OVER (ORDER BY o) - 1 AS r")
    assert wrong.where("i <> r").count() == 0


def test_row_index_with_null_groups(spark, threshold):
    df = spark.createDataFrame([("a", 2), (None, 7), ("a", 1), (None, 3)], "g string, o int")
    assert {(r.g, r.o, r.row_index) for r in row_index(df, ["g"], ["o"]).collect()} == {
        ("a", 1, 0), ("a", 2, 1), (None, 3, 0), (None, 7, 1)
    }


def test_row_index_writes_keys_only(spark, threshold, tmp_path, monkeypatch):
    """Wide columns stay out of the scratch folder; rows with equal keys are numbered all the same."""
    path = tmp_path / "sorted"
    paths = iter([str(path), str(tmp_path / "empty")])
    monkeypatch.setattr("sedimenta.operators.ranking.scratch_path", lambda *_: next(paths))
    given = [("a", 1, "x"), ("a", 1, "x"), ("a", 1, "y"), ("a", 0, None), (None, None, "n"), ("b", 5, "z")]
    df = spark.createDataFrame(given, "g string, o int, text string")
    indexed = row_index(df, ["g"], ["o"])
    assert spark.read.parquet(str(path)).columns == ["g", "o"]
    assert indexed.columns == ["g", "o", "text", "row_index"]
    found = indexed.collect()
    assert sorted(map(str, (r[:3] for r in found))) == sorted(map(str, given))
    assert sorted(r.row_index for r in found if r.g == "a") == [0, 1, 2, 3]
    assert {(r.g, r.o, r.row_index) for r in found if (r.g, r.o) != ("a", 1)} == {
        ("a", 0, 0), (None, None, 0), ("b", 5, 0)
    }
    assert row_index(df.limit(0), ["g"], ["o"], "other").count() == 0


def test_top_per_group(spark, plan):
    given = rows(4000, 1)
    df = spark.createDataFrame(given, "g string, o long, v string").repartition(8)
    top = top_per_group(df, ["g"], [F.desc("o")], 7, spread_by="v")
    expected = {
        (g, o) for g in {r[0] for r in given}
        for o in sorted((r[1] for r in given if r[0] == g), reverse=True)[:7]
    }
    # Cut down before and after each of the two shuffles.
    assert plan(top).split("\n\n\n")[0].count("WindowGroupLimit") == 4
    found = [(r.g, r.o) for r in top.collect()]
    assert len(found) == len(expected) and set(found) == expected


@pytest.mark.parametrize(("limit", "each"), [(100, 25), (3, 1), (0, 1), (10_000, 2_500)])
def test_posts_per_term(limit, each):
    assert posts_per_term(limit) == each


def test_cap_takes_the_newest_posts_of_each_term(spark):
    posts = spark.createDataFrame(
        [(f"u{n}", f"2024-01-{n % 28 + 1:02}", "news" if n % 3 else "politics") for n in range(90)],
        "uri string, indexed_at string, query string",
    )
    capped = cap_per_term(posts, 8).collect()
    assert sorted(r["query"] for r in capped) == ["news"] * 2 + ["politics"] * 2
    assert {r.indexed_at for r in capped if r["query"] == "news"} <= {"2024-01-28", "2024-01-27"}

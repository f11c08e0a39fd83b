"""De-duplication and keys."""

from __future__ import annotations

import random

from sedimenta.operators.dedup import dedup_counts, distinct_texts, unique_keys

COLUMNS = "id string, text string, source string, ingested_at int"


def random_rows(n, seed):
    rng = random.Random(seed)
    texts = [None, "", "copy", *(f"text {i}" for i in range(20))]
    weights = [2, 2, 30, *[1] * 20]
    return [
        (str(i), rng.choices(texts, weights)[0], rng.choice("ab"), rng.randrange(4))
        for i in range(n)
    ]


def expected(rows):
    best = {}
    for row in rows:
        key = (row[1], row[2])
        if key not in best or (row[3], row[0]) < (best[key][3], best[key][0]):
            best[key] = row
    return sorted(best.values(), key=str)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_distinct_texts_keeps_the_first_row(spark):
    rows = random_rows(3000, 1)
    df = spark.createDataFrame(rows, COLUMNS).repartition(16)
    assert found(distinct_texts(df)) == expected(rows)


def test_later_rows_do_not_change_the_choice(spark):
    rows = random_rows(500, 2)
    later = [(f"new {i}", *row[1:3], row[3] + 10) for i, row in enumerate(rows)]
    df = spark.createDataFrame(rows + later, COLUMNS)
    assert found(distinct_texts(df)) == expected(rows)


def test_copies_are_cut_down_before_the_shuffle(spark, plan):
    text = plan(distinct_texts(spark.createDataFrame(random_rows(10, 3), COLUMNS)))
    exchange, partial = text.index("Exchange ("), text.rindex("WindowGroupLimit (", 0, text.index("\n\n\n"))
    assert text.count("Exchange (") >= 1 and exchange < partial
    assert "Partial" in text


def test_hot_text_reaches_the_last_task_once_per_map_task(spark):
    """A third of all rows is one text; hardly any of them is shuffled."""
    df = spark.range(0, 300_000, 1, 8).selectExpr(
        "CAST(id AS STRING) AS id",
        "IF(id % 3 = 0, repeat('hot ', 50), sha2(CAST(id AS STRING), 256)) AS text",
        "'a' AS source", "0 AS ingested_at",
    )
    result = distinct_texts(df)
    assert result.count() == 200_001
    assert [r.id for r in result.where("text LIKE 'hot%'").collect()] == ["0"]


def test_counts(spark):
    rows = random_rows(2000, 4)
    row = dedup_counts(spark.createDataFrame(rows, COLUMNS).repartition(8)).head()
    kept = len(expected(rows))
    assert row.asDict() == {
        "rows_before": 2000, "rows_after": kept, "rows_dropped": 2000 - kept
    }


def test_counts_of_nothing(spark):
    assert tuple(dedup_counts(spark.createDataFrame([], COLUMNS)).head()) == (0, 0, 0)


def test_unique_keys(spark):
    rows = [("1", "b", "a", 1), ("1", "a", "a", 9), ("1", "c", "b", 0), ("2", None, "a", 0)]
    df = spark.createDataFrame(rows, COLUMNS)
    assert found(unique_keys(df)) == sorted(rows[1:], key=str)
    assert found(unique_keys(df, order=["ingested_at"])) == sorted(
        [rows[0], *rows[2:]], key=str
    )


def test_texts_that_occur_once_are_not_shuffled(spark, plan):
    from sedimenta.operators.dedup import distinct_texts_in_place

    rows = random_rows(3000, 1)
    df = spark.createDataFrame(rows, COLUMNS).repartition(16)
    assert found(distinct_texts_in_place(df)) == expected(rows)
    alone = spark.createDataFrame([("1", "x", "a", 0), ("2", None, "a", 0)], COLUMNS)
    assert "Exchange" not in plan(distinct_texts_in_place(alone))

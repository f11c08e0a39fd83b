"""The stages of the corpus pipeline, one after the other, each judged on what it was given."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))

from test_documents import mark, plain_components  # noqa: E402

import corpus_pipeline  # noqa: E402
from sedimenta.llm.pii import find_personal_data  # noqa: E402
from sedimenta.llm.toxicity import toxicity  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output of each stage by its name."""
    root, found = tmp_path_factory.mktemp("stages"), {}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        path = str(root / name.split()[0])
        stage(spark, docs, FOLDER).write.parquet(path)
        found[name] = docs, spark.read.parquet(path)
        docs = found[name][1]
    return found


def test_order_and_columns(stages):
    assert list(stages) == [
        "toxicity", "simhash near-dedup", "benchmark decontamination", "pii", "packing"
    ]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name
        assert after.count() <= before.count()


def test_toxic_documents_go(spark, stages):
    before, after = stages["toxicity"]
    judged = toxicity(before, spark.read.parquet(f"{FOLDER}/labels.parquet")).collect()
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in judged if not r.is_toxic}
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    gone = {r.doc_id for r in judged if r.is_toxic}
    assert sum(labels.get(d) == 1 for d in gone) > 0.9 * sum(d in labels for d in gone)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["simhash near-dedup"]
    rows = before.collect()
    marks = [mark(r.text) for r in rows]
    links = [(i, j) for i in range(len(rows)) for j in range(i) if (marks[i] ^ marks[j]).bit_count() <= 4]
    first: dict = {}
    for r, root in zip(rows, plain_components(len(rows), links)):
        first[root] = min(r.doc_id, first.get(root, r.doc_id))
    assert sorted(r.doc_id for r in after.collect()) == sorted(first.values())


def test_texts_lose_personal_data_only(stages):
    before, after = stages["pii"]
    assert before.count() == after.count()
    kinds = F.expr("size(base)")
    # What is put in the place of an identifier is none.
    assert find_personal_data(after.select("doc_id", "text")).agg(F.sum(kinds)).head()[0] == 0
    assert after.where(F.col("n_chars") != F.char_length("text")).count() == 0


def test_pieces_hold_every_document(stages):
    before, after = stages["packing"]
    held = after.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("all"), F.max("sequence_id")
    )
    assert held.count() == before.count()
    assert held.where("n <> all").count() == 0
    sizes = after.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert sizes.where("n <> end OR n > 2048").count() == 0

"""Where materialized steps go."""

from __future__ import annotations

import pytest

from sedimenta.session import scratch_path, sizing


class Session:
    """Settings only."""

    def __init__(self, **settings):
        self.settings = {f"spark.{k.replace('_', '.')}": v for k, v in settings.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_the_folder_of_the_session_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x").startswith(f"{root}/x-")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Session(master="yarn"), "x")
    shared = Session(master="yarn", checkpoint_dir="hdfs:///shared/")
    assert scratch_path(shared, "x").startswith("hdfs:///shared/x-")


def test_a_local_session_may_do_without():
    assert "/sedimenta-" in scratch_path(Session(master="local[4]"), "x")


@pytest.mark.parametrize(
    ("data_bytes", "cores", "partitions", "read", "written"),
    [
        (10**7, 8, 8, 16 << 20, 16 << 20),
        (10**11, 8, 93, 512 << 20, 128 << 20),
        (100 * 10**12, 8000, 93132, 512 << 20, 128 << 20),
    ],
)
def test_sizing(data_bytes, cores, partitions, read, written):
    assert sizing(data_bytes, cores) == {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(read),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(written),
    }

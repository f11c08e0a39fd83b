"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession

# Adaptive execution merges small shuffle partitions and splits skewed ones.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
}

MEGABYTE = 1 << 20


def sizing(data_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a job over that much input on that many cores.

    Map tasks read up to 512 MB and shuffle partitions hold about 1 GB, which sorts with little
    spill; smaller ones would make too many blocks of too few bytes. Partitions that are merged
    or split at run time, and with them files, come to 128 MB. Small jobs get smaller pieces, so
    that every core has some work.
    """
    share = max(16 * MEGABYTE, data_bytes // (2 * cores))
    return {
        "spark.sql.shuffle.partitions": str(max(cores, data_bytes // (1024 * MEGABYTE))),
        "spark.sql.files.maxPartitionBytes": str(min(512 * MEGABYTE, share)),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(min(128 * MEGABYTE, share)),
    }


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; ``settings`` are added as given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="sedimenta-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``.

    Only a local master may go without that setting; executors on other machines could not
    see a folder of the driver.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (spark.conf.get("spark.master", None) or "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_scratch()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Folder:
    """Files beside and below a path, on whatever file system it is; ``""`` is the path itself.

    Other names are appended to the path: ``__x`` is a sibling, ``/x`` lies below.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._make_path = spark._jvm.org.apache.hadoop.fs.Path
        self._path = path.rstrip("/")
        self._system = self._make_path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._make_path(self._path + name)

    def exists(self, name: str) -> bool:
        return self._system.exists(self._at(name))

    def make(self, name: str) -> None:
        self._system.mkdirs(self._at(name))

    def remove(self, name: str) -> None:
        self._system.delete(self._at(name), True)

    def move(self, name: str, target: str) -> None:
        """Rename; folders above the target are made, and one that is there is an error."""
        goal = self._at(target)
        self._system.mkdirs(goal.getParent())
        if self._system.exists(goal) or not self._system.rename(self._at(name), goal):
            raise OSError(f"{self._path}{name} cannot be moved to {goal.toString()}")

    def leaves(self, name: str) -> list[str]:
        """Partition folders below ``name`` that hold files, as ``/a=1/b=2``."""
        found = []
        for status in self._system.listStatus(self._at(name)):
            child = status.getPath().getName()
            if status.isDirectory() and "=" in child:
                below = self.leaves(f"{name}/{child}")
                found += [f"/{child}{b}" for b in below] or [f"/{child}"]
        return found


def folder_at(spark: SparkSession, path: str) -> Folder:
    return Folder(spark, path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a scratch path whose content is no longer needed."""
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    location.getFileSystem(spark._jsc.hadoopConfiguration()).delete(location, True)

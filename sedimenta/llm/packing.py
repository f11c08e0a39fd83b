"""Packing along a space-filling curve: documents that are alike come into the same sequences."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Step, empty_if_null, ship_code
from .tokens import encoder

LENGTH = 2048
END_ID = 1

# Documents are counted in HASHED buckets of ids, projected to DIMENSIONS numbers, and each of
# these cut into 2 ** DEPTH cells.
HASHED, DIMENSIONS, DEPTH = 256, 4, 12
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


def _projection() -> np.ndarray:
    return np.random.default_rng(10).standard_normal((HASHED, DIMENSIONS))


def document_point(ids: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Hashed counts of ids, damped and of length one, in few dimensions."""
    bucket = (ids.astype(np.uint64) * _FACTOR) >> np.uint64(56)
    counts = np.log1p(np.bincount(bucket.astype(np.int64), minlength=HASHED))
    norm = np.sqrt((counts * counts).sum())
    return (counts / norm if norm else counts) @ projection


def hilbert_keys(cells: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Places on the Hilbert curve of points with whole coordinates below ``2 ** depth``.

    The coordinates are turned into those of the cube that the curve visits, level by level,
    and their bits, in Gray code, are dealt out from the highest level on.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    level = 1 << (depth - 1)
    while level > 1:
        mask = level - 1
        for i in range(n):
            flip = (x[i] & level) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & mask)
            x[0] ^= np.where(flip, mask, swap)
            x[i] ^= swap
        level >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    level = 1 << (depth - 1)
    while level > 1:
        turn ^= np.where((x[n - 1] & level) != 0, level - 1, 0)
        level >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for bit in range(depth - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> bit) & 1)
    return key


def _tokenised(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, projection = encoder(path, keeps_space=False), _projection()
        end = np.array([END_ID], tool.dtype).tobytes()
        for batch in batches:
            found = [x + end for x in tool.encode(batch["text"].to_pylist())]
            points = [document_point(np.frombuffer(x, tool.dtype), projection) for x in found]
            columns = [batch["doc_id"], pa.array([len(x) // len(end) for x in found], pa.int64())]
            flat = np.array(points).reshape(-1, DIMENSIONS)
            columns += [pa.array(np.ascontiguousarray(flat[:, i])) for i in range(DIMENSIONS)]
            names = ["doc_id", "n", *(f"x{i}" for i in range(DIMENSIONS)), "ids"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.binary())], names)

    return rows


def _keyed(middle: list[float], spread: list[float]):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            point = np.stack([batch[f"x{i}"].to_numpy() for i in range(DIMENSIONS)], axis=1)
            # A smooth step gives the middle, where most documents are, most of the cells.
            even = (np.tanh((point - middle) / spread) + 1) / 2
            cells = np.minimum((even * (1 << DEPTH)).astype(np.int64), (1 << DEPTH) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["n"], pa.array(hilbert_keys(cells))], ["row", "n", "key"]
            )

    return rows


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of the rows before, within the partition."""
    total = 0
    for batch in batches:
        stops = total + np.cumsum(batch["n"].to_numpy())
        yield pa.RecordBatch.from_arrays(
            [batch["row"], batch["part"], pa.array(stops - batch["n"].to_numpy()), batch["n"]],
            ["row", "part", "before", "n"],
        )
        total = int(stops[-1]) if len(stops) else total


def _cut(dtype: str, length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        for batch in batches:
            out: list[list[int]] = [[] for _ in names]
            for key, first, ids in zip(
                batch["doc_id"].to_pylist(), batch["first"].to_pylist(), batch["ids"], strict=True
            ):
                wide = np.frombuffer(ids.as_buffer(), dtype).astype("<u4")
                octets, start = wide.tobytes(), 0
                while start < len(wide):
                    sequence, offset = divmod(first + start, length)
                    size = min(length - offset, len(wide) - start)
                    crc = zlib.crc32(octets[4 * start : 4 * (start + size)])
                    row = (key, start, size, crc, len(wide), sequence, offset)
                    for column, value in zip(out, row, strict=True):
                        column.append(value)
                    start += size
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names)

    return rows


def packed(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of sequences.

    Each document's ids, an end id included, follow those of its neighbour on the curve, and the
    whole is cut every ``length`` ids: sequences have no gaps, and only the last is padded. A NULL
    text is empty and gives the end id alone; copies are neighbours, each with its own pieces;
    a NULL ``doc_id`` stays NULL. Columns besides ``doc_id`` and ``text`` are left aside.

    Texts are tokenised once. Places on the curve are sorted as narrow rows, with ties by row, so
    that any number of copies spreads over tasks; ids are shuffled once, to meet their places.
    """
    spark = docs.sparkSession
    ship_code(spark)
    points = ", ".join(f"x{i} double" for i in range(DIMENSIONS))
    found = docs.select(F.col("doc_id").cast("long"), empty_if_null("text").alias("text"))
    found = found.mapInArrow(_tokenised(vocabulary), f"doc_id long, n long, {points}, ids binary")
    tokens = Step(found.withColumn("row", F.monotonically_increasing_id()), "tokens").df
    axes = [f"x{i}" for i in range(DIMENSIONS)]
    moments = tokens.agg(*[F.avg(x) for x in axes], *[F.stddev_pop(x) for x in axes]).head()
    middle = [m or 0.0 for m in moments[:DIMENSIONS]]
    spread = [s or 1.0 for s in moments[DIMENSIONS:]]
    keyed = tokens.select("row", "n", *axes).mapInArrow(
        _keyed(middle, spread), "row long, n long, key long"
    )
    ordered = keyed.repartitionByRange("key", "row").sortWithinPartitions("key", "row")
    ordered = ordered.select("row", "n", F.spark_partition_id().alias("part"))
    places = Step(ordered.mapInArrow(_running, "row long, part int, before long, n long"), "places").df
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = places.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift")
    )
    placed = places.join(F.broadcast(parts), "part").select(
        "row", (F.col("shift") + F.col("before")).alias("first")
    )
    met = tokens.select("row", "doc_id", "ids").join(placed, "row")
    dtype = encoder(vocabulary, keeps_space=False).dtype
    return met.select("doc_id", "first", "ids").mapInArrow(
        _cut(dtype, length),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long",
    )

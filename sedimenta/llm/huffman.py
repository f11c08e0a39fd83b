"""Token ids in files: canonical Huffman codes of limited length, in blocks that stand alone.

A file is a folder with two Parquet tables. ``codes`` holds the code length of each id; canonical
codes follow from the lengths. ``blocks`` holds the ids of consecutive whole documents per row:
``part`` and ``block`` give the order, ``doc_ids`` and ``lengths`` the documents, ``payload`` the
codes, most significant bit first, and ``checkpoints`` the bit offset of every ``STRIDE``-th id,
so that all stretches of a block are decoded side by side from a table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Step, empty_if_null, released_shuffles, ship_code
from .tokens import encoder

LIMIT = 16
STRIDE = 256
BLOCK_IDS = 1 << 18

PLAIN = "part int, block int, doc_ids array<long>, lengths array<long>, ids binary"
PACKED = "part int, block int, doc_ids array<long>, lengths array<long>, payload binary, checkpoints binary"


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Lengths of the best prefix code with codes of ``limit`` bits at most; 0 for unused ids.

    Package-merge: per level the leaves are merged with pairs of the level before; of the last
    level the first ``2 n - 2`` items are taken, and each time a leaf is taken its code grows.
    """
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    n = len(used)
    if n < 2:
        lengths[used] = 1
        return lengths
    limit = max(limit, (n - 1).bit_length())
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    levels, items = [], leaves
    levels.append(np.ones(n, bool))
    for _ in range(limit - 1):
        packages = items[: len(items) // 2 * 2].reshape(-1, 2).sum(axis=1)
        merged = np.concatenate([leaves, packages])
        place = np.argsort(merged, kind="stable")
        items = merged[place]
        levels.append(place < n)
    taken = 2 * n - 2
    for is_leaf in reversed(levels):
        n_leaves = int(is_leaf[:taken].sum())
        lengths[order[:n_leaves]] += 1
        taken = 2 * (taken - n_leaves)
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """The code of each id: shorter codes first, then smaller ids."""
    codes = np.zeros(len(lengths), np.uint64)
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    if len(order):
        longest = int(lengths.max())
        room = np.uint64(1) << (longest - lengths[order].astype(np.uint64)).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum(room)[:-1]]).astype(np.uint64)
        codes[order] = first >> (longest - lengths[order]).astype(np.uint64)
    return codes


def encode_block(ids: np.ndarray, lengths: np.ndarray, codes: np.ndarray) -> tuple[bytes, bytes]:
    """Payload and checkpoints of one block."""
    size = lengths[ids].astype(np.int64)
    stop = np.cumsum(size)
    start = stop - size
    word = start >> 5
    shift = (64 - (start & 31) - size).astype(np.uint64)
    value = codes[ids] << shift
    n_words = (int(stop[-1]) >> 5) + 2 if len(ids) else 0
    # Bits of different codes never meet, so that sums put them together; 32 bits stay exact.
    high = np.bincount(word, (value >> np.uint64(32)).astype(np.float64), n_words)
    low = np.bincount(word + 1, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), n_words)
    payload = (high + low).astype(np.uint64).astype(">u4").tobytes()
    return payload, start[::STRIDE].astype("<u8").tobytes()


def decode_table(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Id and code length for every start of a code, and how many bits such a start has."""
    longest = int(lengths.max(initial=0))
    order = np.lexsort((np.arange(len(lengths)), lengths))
    order = order[lengths[order] > 0]
    room = 1 << (longest - lengths[order].astype(np.int64))
    ids = np.zeros(1 << longest, np.uint32)
    sizes = np.zeros(1 << longest, np.int64)
    filled = int(room.sum())
    ids[:filled] = np.repeat(order, room)
    sizes[:filled] = np.repeat(lengths[order], room)
    return ids, sizes, longest


def decode_block(
    payload: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, np.ndarray, int]
) -> np.ndarray:
    """The ``n`` ids of a block: all stretches between checkpoints advance together."""
    ids, sizes, longest = table
    octets = payload + bytes(8)
    windows = np.ndarray((len(payload) + 1,), ">u8", octets, strides=(1,))
    at = np.frombuffer(checkpoints, "<u8").astype(np.int64)
    out = np.zeros((STRIDE, len(at)), np.uint32)
    last = n - STRIDE * (len(at) - 1)
    for i in range(STRIDE):
        if i == last:  # the last stretch may be shorter
            at = at[:-1]
        if not len(at):
            break
        ahead = windows[at >> 3].astype(np.uint64) >> (64 - longest - (at & 7)).astype(np.uint64)
        start = (ahead & np.uint64((1 << longest) - 1)).astype(np.int64)
        out[i, : len(at)] = ids[start]
        at = at + sizes[start]
    return out.T.reshape(-1)[:n]


def _plain_blocks(path: str, end_id: int):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path, keeps_space=True)
        end = np.array([end_id], tool.dtype).tobytes()
        width = len(end)
        doc_ids, pieces, part, block, size = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([block], pa.int32()),
                    pa.array([doc_ids], pa.list_(pa.int64())),
                    pa.array([[len(p) // width for p in pieces]], pa.list_(pa.int64())),
                    pa.array([b"".join(pieces)], pa.binary()),
                ],
                ["part", "block", "doc_ids", "lengths", "ids"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch["part"][0].as_py()
            keys = batch["doc_id"].to_pylist()
            for key, found in zip(keys, tool.encode(batch["text"].to_pylist()), strict=True):
                doc_ids.append(key)
                pieces.append(found + end)
                size += len(pieces[-1]) // width
                if size >= BLOCK_IDS:
                    yield row()
                    doc_ids, pieces, block, size = [], [], block + 1, 0
        if doc_ids:
            yield row()

    return blocks


def _counted(dtype: str):
    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                part = np.bincount(np.frombuffer(ids.as_buffer(), dtype), minlength=len(total))
                part[: len(total)] += total
                total = part
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(total[used])], ["id", "n"]
        )

    return counts


def _packed(dtype: str, table):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, codes = table.value
        for batch in batches:
            done = [
                encode_block(np.frombuffer(x.as_buffer(), dtype), lengths, codes)
                for x in batch["ids"]
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch[c] for c in ("part", "block", "doc_ids", "lengths")),
                    pa.array([p for p, _ in done], pa.binary()),
                    pa.array([c for _, c in done], pa.binary()),
                ],
                ["part", "block", "doc_ids", "lengths", "payload", "checkpoints"],
            )

    return blocks


def write_token_file(docs: DataFrame, path: str, vocabulary: str, end_id: int = 0) -> None:
    """Encode whole texts, append ``end_id`` to each, and write all ids in order of ``doc_id``.

    NULL texts are empty and give the end id alone; a NULL ``doc_id`` comes first; rows with the
    same one stand in the order of a hash of their texts. Without rows the file has no blocks.

    Documents are range-partitioned once. The plain ids wait in the scratch folder until the
    counts of all ids, one number per id of the vocabulary, have given the codes.
    """
    spark = docs.sparkSession
    ship_code(spark)
    text = empty_if_null("text")
    ordered = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("tie"))
    ordered = ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))
    plain = Step(ordered.mapInArrow(_plain_blocks(vocabulary, end_id), PLAIN), "ids")
    tool = encoder(vocabulary, keeps_space=True)
    size = max(tool.library.get_vocab_size(), end_id + 1)
    counted = plain.df.select("ids").mapInArrow(_counted(tool.dtype), "id long, n long")
    found = counted.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[found["id"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    lengths = code_lengths(counts)
    table = spark.sparkContext.broadcast((lengths, canonical_codes(lengths)))
    rows = [(int(i), int(lengths[i])) for i in np.flatnonzero(lengths)]
    with released_shuffles(spark):
        spark.createDataFrame(rows, "id int, length int").coalesce(1).write.parquet(f"{path}/codes")
        packed = plain.df.mapInArrow(_packed(tool.dtype, table), PACKED)
        packed.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    plain.drop()


def _unpacked(table):
    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = decode_table(table.value)
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                stops = np.cumsum(lengths)
                ids = decode_block(row["payload"], row["checkpoints"], int(stops[-1]), lookup)
                octets = ids.astype("<u4").tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(row["doc_ids"], pa.int64()),
                        pa.array(row["first"] + stops - lengths),
                        pa.array(
                            [octets[4 * (b - k) : 4 * b] for b, k in zip(stops.tolist(), row["lengths"])],
                            pa.binary(),
                        ),
                    ],
                    ["doc_id", "start", "ids"],
                )

    return documents


def read_token_file(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of each document in a file.

    ``ids`` are little-endian unsigned 32-bit numbers, ``start`` is how many ids stand before.
    Blocks are decoded one by one, on any task; starts come from the sizes of blocks.
    """
    ship_code(spark)
    codes = spark.read.schema("id int, length int").parquet(f"{path}/codes").toPandas()
    lengths = np.zeros(int(codes["id"].max()) + 1 if len(codes) else 1, np.uint8)
    lengths[codes["id"].to_numpy(np.int64)] = codes["length"].to_numpy(np.uint8)
    blocks = spark.read.schema(PACKED).parquet(f"{path}/blocks")
    sizes = blocks.select(
        "part", "block", F.aggregate("lengths", F.lit(0).cast("long"), lambda a, b: a + b).alias("n")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sizes.groupBy("part").agg(F.sum("n").alias("n")).select(
        "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")
    )
    inside = Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(parts, "part").select(
        "part", "block",
        (F.col("first") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"),
    )
    table = spark.sparkContext.broadcast(lengths)
    # Blocks, not their ids, meet their starts, should those be too many for one message.
    begun = blocks.join(starts, ["part", "block"]).select(*blocks.columns, "first")
    return begun.mapInArrow(_unpacked(table), "doc_id long, start long, ids binary")

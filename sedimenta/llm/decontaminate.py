"""Benchmark items inside documents: MinHash containment search by size, then exact containment.

An item is found in a document that holds at least ``threshold`` of its distinct shingles of five
words. Items are partitioned by size: one with ``n`` shingles belongs to the least power of two
``u >= n``, and its sketch are the ``floor((1 - threshold) * u) + 1`` shingles of smallest hash.
A document that holds the threshold can miss no more than ``floor((1 - threshold) * n)`` shingles,
so it holds one of the sketch, however long it is: the search loses nothing. Documents with a
sketch shingle are then compared shingle by shingle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Step, ship_code

SHINGLE = 5
THRESHOLD = 0.8

# Everything that is not a letter, digit or beyond ASCII separates words.
SEPARATORS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256))

# Bits that say which hashes occur in items; the size is fixed, more items only mean more
# shingles that pass and find no partner in the join.
BITS = 1 << 24

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_CACHED_WORDS = 1_000_000


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words: runs without white space and ASCII punctuation."""
    return (text or "").lower().encode().translate(SEPARATORS).split()


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHED_WORDS:
            self.clear()
        import xxhash

        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def shingle_hashes(words: list[bytes], known: _WordHashes) -> np.ndarray:
    """A 64-bit hash for each shingle, by place."""
    n = len(words) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    each = np.fromiter((known[w] for w in words), np.uint64, len(words))
    total = np.zeros(n, np.uint64)
    for i in range(SHINGLE):
        total = total * _FACTOR + each[i : i + n]
        total ^= total >> np.uint64(29)
    return total


def _item_rows(threshold: float):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("item_id", "shingle", "hash", "n", "sketch")}
            for item, text in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist()):
                words = words_of(text)
                hashes = shingle_hashes(words, known)
                first: dict[bytes, int] = {}
                for i, h in enumerate(hashes.tolist()):
                    first.setdefault(b" ".join(words[i : i + SHINGLE]), h)
                bound = 1 << max(0, len(first) - 1).bit_length()
                size = int((1 - threshold) * bound + 1e-9) + 1
                order = sorted(first.items(), key=lambda x: (x[1], x[0]))
                for rank, (shingle, h) in enumerate(order):
                    out["item_id"].append(item)
                    out["shingle"].append(shingle.decode())
                    out["hash"].append(h - (1 << 64) if h >> 63 else h)
                    out["n"].append(len(first))
                    out["sketch"].append(rank < size)
            yield pa.RecordBatch.from_pydict(
                {
                    "item_id": pa.array(out["item_id"], pa.int64()),
                    "shingle": pa.array(out["shingle"], pa.string()),
                    "hash": pa.array(out["hash"], pa.int64()),
                    "n": pa.array(out["n"], pa.int64()),
                    "sketch": pa.array(out["sketch"], pa.bool_()),
                }
            )

    return rows


def item_shingles(items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(item_id, shingle, hash, n, sketch) for the distinct shingles of each item."""
    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(
        _item_rows(threshold),
        "item_id long, shingle string, hash long, n long, sketch boolean",
    )


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the low hash ends, gathered as at most ``BITS / 64`` words."""
    place = F.col("hash").bitwiseAND(BITS - 1)
    words = hashes.groupBy(F.shiftright(place, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(hash & {63} as int))")).alias("bits")
    )
    found = words.toPandas()
    bitmap = np.zeros(BITS // 64, np.uint64)
    bitmap[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return bitmap


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    word = bitmap[(hashes & np.uint64(BITS - 1)) >> np.uint64(6)]
    return (word >> (hashes & np.uint64(63))) & np.uint64(1) != 0


def _document_hits(bitmaps):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _WordHashes()
        sketch, whole = bitmaps.value
        for batch in batches:
            rows, shingles = [], []
            for row, text in enumerate(batch["text"]):
                words = words_of(text.as_py())
                hashes = shingle_hashes(words, known)
                if not _has(sketch, hashes).any():
                    continue
                found = {
                    b" ".join(words[i : i + SHINGLE])
                    for i in np.flatnonzero(_has(whole, hashes)).tolist()
                }
                rows += [row] * len(found)
                shingles += [s.decode() for s in found]
            taken = batch["key"].take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [taken, pa.array(shingles, pa.string())], ["key", "shingle"]
            )

    return rows


def contained_items(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", threshold: float = THRESHOLD
) -> DataFrame:
    """(key, item_id, n_shingles, n_found, containment) for each item found in a document.

    ``docs`` has ``key`` (any type, also NULL) and ``text``, ``items`` has ``item_id`` and
    ``text``. Documents with the same key count as one. Items of fewer than five words have no
    shingle and are never found; NULL texts are empty; of repeated items, each counts once by
    ``item_id``, its texts together. Either table may be empty.

    Documents are read once, each text as a whole; only shingles that items have too, by a bitmap
    of fixed size, leave the task. A shingle in very many documents meets the few items that hold
    it in an equi-join.
    """
    spark = docs.sparkSession
    ship_code(spark)
    index = Step(item_shingles(items, threshold), "items").df
    bitmaps = spark.sparkContext.broadcast(
        (_bitmap(index.where("sketch")), _bitmap(index))
    )
    named = docs.select(F.col(f"`{key}`").alias("key"), "text")
    schema = T.StructType([named.schema["key"]]).add("shingle", T.StringType())
    hits = named.mapInArrow(_document_hits(bitmaps), schema)
    sizes = index.groupBy("item_id").agg(F.countDistinct("shingle").alias("n_shingles"))
    entries = index.groupBy("item_id", "shingle").agg(F.max("sketch").alias("sketch"))
    met = hits.join(entries.join(sizes, "item_id"), "shingle")
    counted = met.groupBy("key", "item_id", "n_shingles").agg(
        F.countDistinct("shingle").alias("n_found"), F.max("sketch").alias("sketch")
    )
    share = F.col("n_found") / F.col("n_shingles")
    return counted.where(F.col("sketch") & (share >= threshold)).select(
        F.col("key").alias(key), "item_id", "n_shingles", "n_found", share.alias("containment")
    )


def without_benchmark(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item; all columns and other rows stay."""
    key = F.struct("doc_id", F.xxhash64("text")).alias("key")
    found = contained_items(docs.select(key, "text"), items, "key").select("key").distinct()
    rows = docs.select(key, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    return rows.join(found, "key", "left_anti").select("row.*")

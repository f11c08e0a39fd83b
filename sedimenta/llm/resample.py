"""Importance resampling: draw documents as if they came from a target collection.

Hashed n-grams of words are counted over the documents and over the target. A document weighs
what its n-grams gain, and Gumbel noise from a hash of its id makes the highest sums a draw
without replacement in proportion to the weights.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ranking import row_index
from .common import Step, ship_code

# Words worked on at once: a long document is gone through in parts, short ones together.
AT_ONCE = 200_000


@dataclass(frozen=True)
class Resampling:
    """``percent`` of the documents with ``least_words`` at least are drawn.

    ``longest``: words of the longest n-gram. ``buckets``: what their CRC is taken modulo; the
    driver holds a number per bucket. ``seed`` goes into the noise.
    """

    percent: int = 5
    least_words: int = 20
    longest: int = 3
    buckets: int = 10_000
    seed: int = 42


# A digit, a-z, or a byte of a character that is not ASCII.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


# --- running CRCs -----------------------------------------------------------------

POLYNOMIAL = 0xEDB88320


def _images() -> list[int]:
    """Where appending one zero byte takes each bit of a CRC."""
    found = []
    for bit in range(32):
        x = 1 << bit
        for _ in range(8):
            x = x >> 1 ^ (POLYNOMIAL if x & 1 else 0)
        found.append(x)
    return found


def _taken(images: list[int], x: int) -> int:
    found = 0
    for bit, image in enumerate(images):
        if x >> bit & 1:
            found ^= image
    return found


def _tables(images: list[int]) -> np.ndarray:
    """The same map by table, one for each byte of a CRC."""
    return np.array(
        [[_taken(images, value << 8 * byte) for value in range(256)] for byte in range(4)],
        np.uint32,
    )


class Shifts:
    """CRCs as they are when bytes follow that leave them alone but for the shift.

    The CRC of a string is that of a prefix that ends with it, less the shifted CRC of what comes
    before, because appending bytes is linear over GF(2). Shifts by 1, 2, 4... bytes come from
    squaring the map of one byte, and any length is a row of those.
    """

    def __init__(self) -> None:
        self._images, self._steps = _images(), []

    def __call__(self, crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        found = crcs.copy()
        for bit in range(int(lengths.max(initial=0)).bit_length()):
            if bit == len(self._steps):
                self._steps.append(_tables(self._images))
                self._images = [_taken(self._images, x) for x in self._images]
            at = np.flatnonzero(lengths >> bit & 1)
            x, step = found[at], self._steps[bit]
            found[at] = (
                step[0][x & 255] ^ step[1][x >> 8 & 255] ^ step[2][x >> 16 & 255] ^ step[3][x >> 24]
            )
        return found


def _parts(texts: list[str | None], longest: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(document, words that were in the part before, words) of each part of each text.

    A part begins with the last words of the one before, so that each n-gram ends among the new
    words of exactly one part.
    """
    for number, text in enumerate(texts):
        octets = (text or "").encode("utf-8", "surrogatepass").lower()
        if len(octets) <= 2 * AT_ONCE:
            yield number, 0, _WORD.findall(octets)
            continue
        found, before = (m.group() for m in _WORD.finditer(octets)), []
        while new := list(islice(found, AT_ONCE)):
            yield number, len(before), before + new
            before = (before + new)[1 - longest :] if longest > 1 else []


def _together(parts: Iterator[tuple[int, int, list[bytes]]]) -> Iterator[list]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[2])
        if size >= AT_ONCE:
            yield held
            held, size = [], 0
    if held:
        yield held


class Features:
    """Buckets of all n-grams of texts."""

    def __init__(self, settings: Resampling) -> None:
        self.settings, self.shifted = settings, Shifts()

    def __call__(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(document, its new words) of some parts, and (document, bucket) of their n-grams.

        The running CRC of a document without its separators, one space between words, is kept
        at each word's start and end; n-grams are not hashed themselves.
        """
        for parts in _together(_parts(texts, self.settings.longest)):
            starts, ends = [], []
            for _, _, words in parts:
                crc = 0
                for word in words:
                    starts.append(crc)
                    crc = crc32(word, crc)
                    ends.append(crc)
                    crc = crc32(b" ", crc)
            sizes = np.array([len(words) for _, _, words in parts], np.int64)
            owner = np.repeat([number for number, _, _ in parts], sizes)
            carried = np.repeat([before for _, before, _ in parts], sizes)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            lengths = np.fromiter(
                (len(w) for _, _, words in parts for w in words), np.int64, len(owner)
            )
            ends = np.array(ends, np.uint32)
            before = self.shifted(np.array(starts, np.uint32), lengths)
            owners, buckets = [], []
            for n in range(self.settings.longest):
                if n:
                    before = self.shifted(before[:-1], lengths[n:] + 1)
                last = place[n:]
                here = (last >= n) & (last >= carried[n:])
                owners.append(owner[n:][here])
                buckets.append((ends[n:] ^ before)[here] % self.settings.buckets)
            new = np.array([(number, len(words) - old) for number, old, words in parts], np.int64)
            yield new.reshape(-1, 2), np.concatenate(owners), np.concatenate(buckets)


# --- counts, weights, draw --------------------------------------------------------


def bucket_counts(texts: DataFrame, settings: Resampling = Resampling()) -> np.ndarray:
    """How many n-grams of all ``text`` fall into each bucket; tasks send a row per bucket."""
    ship_code(texts.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, n = Features(settings), np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for _, _, buckets in features(batch.column(0).to_pylist()):
                n += np.bincount(buckets, minlength=settings.buckets)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["bucket", "n"])

    per_task = texts.select("text").mapInArrow(counted, "bucket long, n long")
    found = np.zeros(settings.buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        found[row.bucket] = row.n
    return found


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What an n-gram of each bucket gains, in thousandths of a natural logarithm, floored."""
    n = len(source)
    s_all, t_all = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all)))
            for s, t in zip(source.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, settings: Resampling = Resampling()) -> DataFrame:
    """``row`` (all columns but ``text``), ``n_words``, ``n_features`` and ``weight`` per document.

    Whole texts count, of any length; a NULL or empty one has no words and weighs nothing. No
    shuffle.
    """
    ship_code(docs.sparkSession)
    kept = T.StructType([f for f in docs.schema if f.name != "text"])
    rows = docs.select(F.struct(*[F.col(f"`{f.name}`") for f in kept]).alias("row"), "text")
    layout = T.StructType().add("row", kept)
    for name in ("n_words", "n_features", "weight"):
        layout = layout.add(name, "long")

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(settings)
        for batch in batches:
            size = batch.num_rows
            found = np.zeros((3, size), np.int64)
            for new, owner, buckets in features(batch.column(1).to_pylist()):
                np.add.at(found[0], new[:, 0], new[:, 1])
                found[1] += np.bincount(owner, minlength=size)
                # Sums of whole numbers, exact in doubles up to 2 ** 53.
                found[2] += np.bincount(owner, gain[buckets], size).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, found)], layout.names
            )

    return rows.mapInArrow(judged, layout)


def scored(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling()) -> DataFrame:
    """:func:`weighted` by both collections, with ``score``: weight and noise from ``doc_id``."""
    gain = gains(bucket_counts(docs, settings), bucket_counts(target, settings))
    name = F.concat(F.lit(f"{settings.seed}:"), F.coalesce(F.col("row.doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    return weighted(docs, gain, settings).withColumn("score", F.col("weight") + noise)


def drawn(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling()) -> DataFrame:
    """:func:`scored` with ``rank``: 1, 2, 3... for documents that are drawn, else NULL.

    Drawn are the highest scores, ties to the smaller ``doc_id``, of all documents with
    ``least_words`` that have an id. The scores, not the texts, are written once and range-sorted,
    so no task gets them all.
    """
    rows = Step(scored(docs, target, settings), "scored").df
    may_go = (F.col("n_words") >= settings.least_words) & F.col("row.doc_id").isNotNull()
    # Rows with an id count, others can be in no draw.
    n = rows.where(may_go).count() * settings.percent // 100
    order = rows.where(may_go).withColumns({"_low": -F.col("score"), "_id": F.col("row.doc_id")})
    placed = row_index(order, [], ["_low", "_id"], "_number")
    rank = F.when(F.col("_number") < n, F.col("_number") + 1).cast("long")
    rest = rows.where(~may_go).withColumn("rank", F.lit(None).cast("long"))
    return placed.withColumn("rank", rank).select(*rows.columns, "rank").unionByName(rest)


def resampled(docs: DataFrame, target: DataFrame, settings: Resampling = Resampling()) -> DataFrame:
    """The documents of ``docs`` that are drawn, with all their columns, in no order.

    Rows that share a ``doc_id`` are kept together if one of them is drawn.
    """
    chosen = drawn(docs, target, settings).where(F.col("rank").isNotNull())
    return docs.join(chosen.select(F.col("row.doc_id").alias("doc_id")).distinct(), "doc_id", "left_semi")

"""Near-duplicates by SimHash: fingerprints that differ in few bits.

Pivot distance tables: the distances of a fingerprint to fixed reference fingerprints are its
coordinates, and two fingerprints whose coordinates differ by more than the radius anywhere cannot
lie within it. Distances to references spread over all bits are near half the bits for almost
everyone, so they can discard pairs but not find any. Pairs are brought together by references of
single bits, whose distances give those bits: of ``radius + 2`` blocks of bits two are the same for
any pair within the radius, and fingerprints meet under each pair of blocks (:class:`Blocks`).
Under a key the wide references discard, and the exact distance decides about the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Step, ship_code
from .components import connected_components

WORD = 64
SEED = 42

# Reference fingerprints of the distance table, one word each; longer ones repeat it.
PIVOTS = np.random.default_rng(20).integers(0, 1 << 63, 24, dtype=np.uint64) * np.uint64(2)

# Fingerprints under one key that are compared at once; more are dealt into tiles.
TILE = 4096

# Hashes whose bits are counted at once, and rows of a partition compared at once.
COUNTED = 1 << 16
ROWS = 1 << 17


@dataclass(frozen=True)
class Blocks:
    """Keys that bring all pairs within ``radius`` together."""

    radius: int = 4
    words: int = 1

    def keys(self, marks: np.ndarray) -> np.ndarray:
        bits = _bits(marks)
        n = self.radius + 2
        cuts = [round(i * bits.shape[1] / n) for i in range(n + 1)]
        blocks = [bits[:, a:b] for a, b in zip(cuts, cuts[1:])]
        pairs = [np.concatenate(pair, axis=1) for pair in combinations(blocks, 2)]
        return np.stack([_numbers(p, i) for i, p in enumerate(pairs)], axis=1)


def _bits(marks: np.ndarray) -> np.ndarray:
    octets = marks.astype(">u8").view(np.uint8).reshape(len(marks), -1)
    return np.unpackbits(octets, axis=1)


def _numbers(bits: np.ndarray, table: int) -> np.ndarray:
    """Bits as numbers, the number of their table on top."""
    weights = 1 << np.arange(bits.shape[1] - 1, -1, -1)
    return (bits.astype(np.int64) * weights).sum(axis=1) | table << 48


def _further(hashes: np.ndarray, word: int) -> np.ndarray:
    """Hashes of the same things that are independent of the given ones."""
    if not word:
        return hashes
    x = hashes + np.uint64(word * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _shingle_hashes(text: str | None, shingle: int) -> tuple[Iterator[int], int]:
    """Hashes of the word shingles, repeats included, and how many there are.

    A-Z are lower-cased, words are runs without ASCII white space. Fewer words than a shingle
    make one shingle; no words make none.
    """
    import xxhash

    found = (text or "").encode().lower().split()
    if not found:
        return iter(()), 0
    joined = b" ".join(found)
    stops = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], stops[:-1] + 1])
    n = max(1, len(found) - shingle + 1)
    last = min(shingle, len(found)) - 1
    pieces = map(slice, starts[:n].tolist(), stops[last:].tolist())
    return map(xxhash.xxh64_intdigest, map(joined.__getitem__, pieces), repeat(SEED)), n


def _majority(hashes: Iterator[int], n: int, words: int) -> list[int]:
    counts, left = np.zeros(WORD * words, np.int64), n
    while left:
        part = np.fromiter(hashes, np.uint64, min(left, COUNTED))
        wide = np.stack([_further(part, w) for w in range(words)], axis=1)
        counts += _bits(wide).sum(axis=0, dtype=np.int64)
        left -= len(part)
    octets = np.packbits(2 * counts > n)
    return octets.view(">u8").tolist()


def fingerprint(text: str | None, shingle: int, words: int = 1) -> list[int]:
    """SimHash over word shingles, repeats included, as ``words`` unsigned numbers; no words
    make zero."""
    return _majority(*_shingle_hashes(text, shingle), words)


def _fingerprints(shingle: int, words: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [fingerprint(t.as_py(), shingle, words) for t in batch["text"]]
            signed = np.array(marks, np.uint64).reshape(-1, words).view(np.int64)
            columns = [pa.array(np.ascontiguousarray(signed[:, w])) for w in range(words)]
            yield pa.RecordBatch.from_arrays(
                [batch["key"], *columns], ["key", *(f"f{w}" for w in range(words))]
            )

    return rows


def fingerprints(docs: DataFrame, key: str, shingle: int, words: int) -> DataFrame:
    """(key, f0, f1, ...) for each document; the bits of each word are those of a signed long."""
    ship_code(docs.sparkSession)
    named = docs.select(F.col(f"`{key}`").alias("key"), "text")
    schema = T.StructType([named.schema["key"]])
    for w in range(words):
        schema = schema.add(f"f{w}", T.LongType())
    return named.mapInArrow(_fingerprints(shingle, words), schema)


def _keyed(search: Blocks, with_marks: bool):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"f{w}" for w in range(search.words)]
        for batch in batches:
            marks = np.stack([batch[c].to_numpy() for c in names], axis=1)
            keys = search.keys(marks.view(np.uint64))
            if not with_marks:
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel())], ["key"])
                continue
            row = pa.array(np.repeat(np.arange(len(keys)), keys.shape[1]))
            columns = ["node", *names]
            held = [batch[c].take(row) for c in columns]
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), *held], ["key", *columns])

    return rows


def _linked(groups: np.ndarray, marks: np.ndarray, radius: int) -> np.ndarray:
    """For each row the first row it is connected to, within its group of equal numbers."""
    table = np.bitwise_count(marks[:, None, :] ^ PIVOTS[:, None]).sum(axis=2, dtype=np.int16)
    root = np.arange(len(marks))
    rows, shift = np.arange(len(marks)), 0
    while True:
        shift += 1
        rows = rows[rows + shift < len(marks)]
        rows = rows[groups[rows] == groups[rows + shift]]
        if not len(rows):
            return root
        a = rows[root[rows] != root[rows + shift]]
        b = a + shift
        _unite(root, *_near(table, marks, a, b, radius))


def _unite(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Put the least row that is connected over the pairs as the root of each row."""
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(root, lower := root[root]):
            root[:] = lower
        apart = root[a] != root[b]
        a, b = a[apart], b[apart]


def _near(table: np.ndarray, marks: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int):
    """Those of the pairs of rows that differ in at most ``radius`` bits."""
    near = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= radius
    a, b = a[near], b[near]
    near = np.bitwise_count(marks[a] ^ marks[b]).sum(axis=1, dtype=np.int64) <= radius
    return a[near], b[near]


def _spanning_links(radius: int):
    """Rows sorted by group in; for each node a link to the first it is connected to."""

    def linked(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        change = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
        groups = np.concatenate([[0], np.cumsum(change)])
        root = _linked(groups, np.ascontiguousarray(rows[:, 4:]).view(np.uint64), radius)
        moved = np.flatnonzero(root != np.arange(len(root)))
        a, b = rows[moved, 3], rows[root[moved], 3]
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return _by_key(linked)


def _by_key(found):
    """Rows sorted by group in; ``found`` gets whole groups."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy() for c in batch.columns], axis=1))
            if sum(map(len, held)) < ROWS:
                continue
            # The last group may go on in the next batch.
            part = np.concatenate(held)
            ended = np.flatnonzero((part[:, :3] != part[-1, :3]).any(axis=1))
            cut = int(ended[-1]) + 1 if len(ended) else 0
            if cut:
                yield from found(part[:cut])
            held = [part[cut:]]
        if sum(map(len, held)):
            yield from found(np.concatenate(held))

    return rows


def _met(marks: DataFrame, search: Blocks) -> DataFrame:
    """(key, low, high, node, f0, ...) sorted by group, a group being the first three.

    A key that very many fingerprints share is dealt into tiles, each pair of which is a group of
    its own.
    """
    names = [f"f{w}" for w in range(search.words)]
    only = marks.select(*names).mapInArrow(_keyed(search, False), "key long")
    counted = only.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > TILE)
    crowded = counted.select("key", F.ceil(F.col("n") / TILE).cast("long").alias("tiles"))
    crowded = Step(crowded, "crowded").df
    held = ["node", *names]
    keyed = marks.select(*held).mapInArrow(
        _keyed(search, True), "key long, " + ", ".join(f"{c} long" for c in held)
    )
    tiles = F.coalesce("tiles", F.lit(1).cast("long"))
    dealt = keyed.join(crowded, "key", "left").withColumns(
        {"tiles": tiles, "tile": F.pmod(F.xxhash64("node", F.lit(1)), tiles)}
    )
    met = dealt.withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1))
    ).select(
        "key", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        *held,
    )
    group = ["key", "low", "high"]
    return met.repartition(*group).sortWithinPartitions(*group)


def near_links(marks: DataFrame, search: Blocks) -> DataFrame:
    """Links (a, b) that connect the nodes whose fingerprints are found within the radius.

    ``marks`` has ``node``, a long, and distinct fingerprints ``f0``, ... Of a group that is
    connected anyway only a spanning set of links comes out, never all pairs.
    """
    return _met(marks, search).mapInArrow(_spanning_links(search.radius), "a long, b long")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", shingle: int = 4, search: Blocks = Blocks()
) -> DataFrame:
    """(key, component_id, f0, ...) for each document.

    Documents are linked when their fingerprints are found to differ in at most ``radius`` bits;
    ``component_id`` is the smallest key that can be reached over links, itself included. A NULL
    or empty text has fingerprint zero and is linked like any other; a NULL key is never the
    smallest, unless there is no other. Copies share a fingerprint and enter the search once.
    Repeated rows come out as often as they are given.
    """
    names = [f"f{w}" for w in range(search.words)]
    step = Step(fingerprints(docs, key, shingle, search.words), "fingerprints").df
    distinct = step.groupBy(*names).agg(F.min("key").alias("first"))
    nodes = Step(distinct.withColumn("node", F.monotonically_increasing_id()), "nodes").df
    found = connected_components(near_links(nodes, search))
    rooted = nodes.join(found, "node", "left").withColumn(
        "component", F.coalesce("component", "node")
    )
    least = rooted.groupBy("component").agg(F.min("first").alias("component_id"))
    named = rooted.join(least, "component").select(*names, "component_id")
    return step.join(named, names).select(F.col("key").alias(key), "component_id", *names)


def without_near_duplicates(
    docs: DataFrame, shingle: int = 4, search: Blocks = Blocks()
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: that of the smallest ``doc_id``.

    Groups are the components of :func:`near_duplicates`. Columns and texts stay as they are. Of
    repeated rows one stays; NULL and empty texts are copies of one another; a NULL ``doc_id``
    comes before all others.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    step = Step(rows.withColumn("place", F.monotonically_increasing_id()), "rows").df
    keyed = step.select(
        F.struct(F.col("row.doc_id").alias("doc_id"), "place").alias("key"),
        F.col("row.text").alias("text"),
    )
    found = near_duplicates(keyed, "key", shingle, search)
    kept = found.where(F.col("key") == F.col("component_id")).select(F.col("key.place").alias("place"))
    return step.join(kept, "place", "left_semi").select("row.*")

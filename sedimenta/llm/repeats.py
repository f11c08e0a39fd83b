"""Removal of byte strings that an earlier document has already, by distributed prefix doubling.

Suffixes are told apart by their first ``LENGTH`` bytes only, so doubling stops there. A suffix
that is unique at a shorter length leaves at once, and most do:

1. Names of 8 bytes are those bytes, names of 16 and ``ANCHOR`` = 24 are made from pairs of
   shorter names at growing offsets. Every string of 50 bytes holds 27 names of 24 bytes, of which
   the least is its anchor; strings that are equal have equal anchors. Consecutive suffixes with
   the same anchor are one run. Spark deals anchors into buckets, sorts them there, and runs whose
   anchor occurs in one document only are done.
2. What is left takes part with all its bytes: equal runs are put together, and the first document
   that has one keeps it. In any later one the run is removed.
3. Runs that share an anchor without being equal may still share some of their suffixes. These
   are named at 32 and at 50 bytes, sorted, and each but those of the first document is removed.
   Where an anchor has very many runs, Spark counts their suffixes as strings instead.

Names are 64 bits wide and only ever bring equal strings together; strings are compared as bytes
before anything is removed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Step, empty_if_null, ship_code, shuffle_partitions

LENGTH = 50
ANCHOR = 24
NAMES = LENGTH - ANCHOR + 1

# Bytes that are named at once, runs that are sorted at once, suffixes of a run at most (text
# that repeats itself has the same anchor on and on).
PIECE, SORTED, LONGEST = 1 << 21, 1 << 20, 64

# Runs of one anchor that are compared in one group; of more, each suffix is a row of its own.
GROUP = 1 << 16
ROWS = 1 << 17

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The name of each pair of names."""
    x = a * _A
    x += b * _B
    x ^= x >> np.uint64(29)
    return x


def _eights(octets: bytes) -> np.ndarray:
    """The 8 bytes from every place on."""
    n = max(0, len(octets) - 7)
    return np.ndarray((n,), "<u8", octets, strides=(1,)).astype(np.uint64) if n else np.zeros(0, np.uint64)


def anchor_names(octets: bytes) -> np.ndarray:
    """Names of the ``ANCHOR`` bytes from every place on."""
    eight = _eights(octets)
    sixteen = _paired(eight[:-8], eight[8:])
    return _paired(sixteen[:-8], eight[16:])


def suffix_names(octets: bytes) -> np.ndarray:
    """Names of the ``LENGTH`` bytes from every place on."""
    name, width = _eights(octets), 8
    while width < LENGTH:
        offset = min(width, LENGTH - width)
        name = _paired(name[:-offset], name[offset:])
        width += offset
    return name


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` consecutive values, from every place on, by doubling too."""
    size = 1
    while size < width:
        step = min(size, width - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def runs_of(pieces: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    """(anchor, document, first place, suffixes) of the runs in pieces of documents.

    A piece is (document, place of its first byte, bytes) of at least ``LENGTH`` bytes.
    """
    least = _least(anchor_names(b"".join(p[2] for p in pieces)), NAMES)
    sizes = np.array([len(p[2]) for p in pieces])
    starts = np.cumsum(sizes) - sizes
    counts = sizes - LENGTH + 1
    which = np.repeat(np.arange(len(pieces)), counts)
    inside = np.arange(len(which)) - np.repeat(np.cumsum(counts) - counts, counts)
    anchors = least[starts[which] + inside]
    change = np.ones(len(which), bool)
    change[1:] = (anchors[1:] != anchors[:-1]) | (which[1:] != which[:-1])
    first = np.flatnonzero(change)
    n = np.diff(np.append(first, len(which)))
    if n.max(initial=0) > LONGEST:
        parts = -(-n // LONGEST)
        number = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        whole = np.repeat(n, parts)
        first = np.repeat(first, parts) + number * LONGEST
        n = np.minimum(whole - number * LONGEST, LONGEST)
    docs = np.array([p[0] for p in pieces], np.int64)[which[first]]
    place = np.array([p[1] for p in pieces], np.int64)[which[first]] + inside[first]
    return anchors[first], docs, place, n


RUN = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("place", "<u4"), ("n", "u1"), ("known", "u1")])

# In ``known``: to be looked up; repeated, and tells others; repeated, and of no use to others.
OPEN, TELLS, SILENT = 0, 1, 2


def _columns(runs: np.ndarray) -> bytes:
    """Runs column by column, which compresses better than row by row."""
    return b"".join(np.ascontiguousarray(runs[c]).tobytes() for c in RUN.names)


def _from_columns(octets: bytes) -> np.ndarray:
    runs = np.empty(len(octets) // RUN.itemsize, RUN)
    at = 0
    for c in RUN.names:
        runs[c] = np.frombuffer(octets, RUN[c], len(runs), at)
        at += runs[c].nbytes
    return runs


def _repeated(runs: np.ndarray) -> np.ndarray:
    """Whether the anchor of each run, sorted by anchor, is in more than one document."""
    first = np.flatnonzero(np.append(True, runs["anchor"][1:] != runs["anchor"][:-1]))
    several = np.minimum.reduceat(runs["doc"], first) != np.maximum.reduceat(runs["doc"], first)
    several |= np.maximum.reduceat(runs["known"], first) > OPEN
    return np.repeat(several, np.diff(np.append(first, len(runs))))


def _dealt(buckets: int):
    """Texts in; (bucket, runs) out. What a part of the texts repeats itself is known at once."""

    def deal(parts: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        runs = np.empty(sum(len(p[0]) for p in parts), RUN)
        for name, columns in zip(RUN.names, zip(*parts)):
            runs[name] = np.concatenate(columns)
        runs["known"] = OPEN
        runs = runs[np.argsort(runs["anchor"], kind="stable")]
        if not len(runs):
            return
        repeated = _repeated(runs)
        first = np.append(True, runs["anchor"][1:] != runs["anchor"][:-1])
        runs["known"] = np.where(repeated, np.where(first, TELLS, SILENT), OPEN)
        # Runs of one anchor meet in its bucket, at most one document's per part; the others go
        # anywhere, so that an anchor of very many documents does not fill a bucket.
        target = np.where(
            runs["known"] == SILENT, runs["place"].astype(np.int64) + runs["doc"],
            (runs["anchor"] >> np.uint64(20)).astype(np.int64),
        ) % buckets
        order = np.argsort(target, kind="stable")
        runs, target = runs[order], target[order]
        cuts = np.flatnonzero(np.append(True, target[1:] != target[:-1]))
        ends = np.append(cuts[1:], len(runs))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(target[cuts].astype(np.int32)),
                pa.array([_columns(runs[a:b]) for a, b in zip(cuts, ends)], pa.binary()),
            ],
            ["bucket", "runs"],
        )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: list[tuple[int, int, bytes]] = []
        parts: list[tuple[np.ndarray, ...]] = []
        size = n_runs = 0

        def name() -> int:
            parts.append((*runs_of(pieces), np.zeros(0)))
            parts[-1] = (*parts[-1][:4], np.zeros(len(parts[-1][0]), np.uint8))
            pieces.clear()
            return len(parts[-1][0])

        for batch in batches:
            for doc, text in zip(batch["doc_id"].to_pylist(), batch["text"]):
                octets = text.as_py().encode()
                for at in range(0, len(octets) - LENGTH + 1, PIECE):
                    pieces.append((doc, at, octets[at : at + PIECE + LENGTH - 1]))
                    size += len(pieces[-1][2])
                    if size >= PIECE:
                        n_runs, size = n_runs + name(), 0
                    if n_runs >= SORTED:
                        yield from deal(parts)
                        parts, n_runs = [], 0
        if pieces:
            name()
        if parts:
            yield from deal(parts)

    return rows


def _settled(table: pa.Table) -> pa.Table:
    """The runs of a bucket whose anchor is in more than one document."""
    runs = np.concatenate([_from_columns(x.as_py()) for x in table["runs"]])
    silent = runs["known"] == SILENT
    asked = runs[~silent]
    asked = asked[np.argsort(asked["anchor"], kind="stable")]
    if len(asked):
        asked = asked[_repeated(asked)]
    found = np.concatenate([asked, runs[silent]])
    return pa.table(
        {
            "doc_id": pa.array(found["doc"].astype(np.int64)),
            "anchor": pa.array(found["anchor"].view(np.int64).copy() if len(found) else np.zeros(0, np.int64)),
            "place": pa.array(found["place"].astype(np.int64)),
            "n": pa.array(found["n"].astype(np.int32)),
        }
    )


RUN_ROWS = (
    "anchor long, digest long, doc_id long, mark long, place long, n int, octets binary"
)


def _with_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with their repeated runs in; a row for each run, with its bytes, out."""
    import xxhash

    names = ["anchor", "digest", "doc_id", "mark", "place", "n", "octets"]
    kinds = [pa.int64()] * 5 + [pa.int32(), pa.binary()]
    for batch in batches:
        out: list[list] = [[] for _ in names]

        def flushed() -> pa.RecordBatch:
            arrays = [pa.array(c, k) for c, k in zip(out, kinds)]
            for column in out:
                column.clear()
            return pa.RecordBatch.from_arrays(arrays, names)

        for i in range(batch.num_rows):
            doc, mark = batch["doc_id"][i].as_py(), batch["mark"][i].as_py()
            copies = batch["copies"][i].as_py()
            if copies and mark in copies:
                continue
            octets = batch["text"][i].as_py().encode()
            runs = batch["runs"][i].values
            anchors, places, sizes = (runs.field(c).to_numpy() for c in ("anchor", "place", "n"))
            # A document with the same id but another text has places of its own.
            fits = places + sizes + LENGTH - 1 <= len(octets)
            places, sizes = places[fits].tolist(), sizes[fits].tolist()
            held = [octets[p : p + s + LENGTH - 1] for p, s in zip(places, sizes)]
            digests = np.array([xxhash.xxh64_intdigest(h) for h in held], np.uint64).view(np.int64)
            n = len(held)
            columns = (anchors[fits].tolist(), digests.tolist(), [doc] * n, [mark] * n, places, sizes, held)
            for column, values in zip(out, columns):
                column.extend(values)
            if len(out[0]) >= ROWS:
                yield flushed()
        if out[0]:
            yield flushed()


def _shared_suffixes(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Spans of the suffixes that a run of another, earlier document of its group has too."""
    table = pa.Table.from_batches(rows).combine_chunks()
    octets = [x.as_py() for x in table["octets"]]
    sizes = np.fromiter(map(len, octets), np.int64, len(octets))
    flat = b"".join(octets)
    counts = sizes - LENGTH + 1
    row = np.repeat(np.arange(len(octets)), counts)
    inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = (np.cumsum(sizes) - sizes)[row] + inside
    names = suffix_names(flat)[at]
    anchor, doc = table["anchor"].to_numpy(), table["doc_id"].to_numpy()
    order = np.lexsort((doc[row], anchor[row], names))
    row, inside, at, names = row[order], inside[order], at[order], names[order]
    new = np.ones(len(row), bool)
    new[1:] = (names[1:] != names[:-1]) | (anchor[row[1:]] != anchor[row[:-1]])
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    later = np.flatnonzero(doc[row] > doc[row[first]])
    bytes_ = np.frombuffer(flat, np.uint8)
    span = np.arange(LENGTH)
    same = np.concatenate(
        [np.zeros(0, bool)]
        + [
            (bytes_[at[some][:, None] + span] == bytes_[at[first[some]][:, None] + span]).all(axis=1)
            for some in np.array_split(later, len(later) // ROWS + 1)
        ]
    )
    later = later[same]
    row, inside = row[later], inside[later]
    order = np.lexsort((inside, row))
    row, inside = row[order], inside[order]
    start = np.ones(len(row), bool)
    start[1:] = (row[1:] != row[:-1]) | (inside[1:] != inside[:-1] + 1)
    first = np.flatnonzero(start)
    n = np.diff(np.append(first, len(row)))
    whose = row[first]
    place = table["place"].to_numpy()[whose] + inside[first]
    columns = (doc[whose], table["mark"].to_numpy()[whose], place, n)
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)) for c in columns], ["doc_id", "mark", "place", "n"]
    )


def _by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor in; whole groups are compared together."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < ROWS:
            continue
        # The last group may go on in the next batch.
        table = pa.Table.from_batches(held).combine_chunks()
        anchor = table["anchor"].to_numpy()
        ended = np.flatnonzero(anchor != anchor[-1])
        cut = int(ended[-1]) + 1 if len(ended) else 0
        if cut:
            yield _shared_suffixes(table.slice(0, cut).to_batches())
        held = table.slice(cut).to_batches()
    if held:
        yield _shared_suffixes(held)


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs in; a row for each suffix, with its ``LENGTH`` bytes, out."""
    for batch in batches:
        for few in (batch.slice(i, ROWS // LONGEST) for i in range(0, batch.num_rows, ROWS // LONGEST)):
            held = [x.as_py() for x in few["octets"]]
            counts = np.array([len(x) - LENGTH + 1 for x in held], np.int64)
            row = np.repeat(np.arange(len(held)), counts)
            inside = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            strings = [x[i : i + LENGTH] for x in held for i in range(len(x) - LENGTH + 1)]
            place = few["place"].to_numpy()[row] + inside
            yield pa.RecordBatch.from_arrays(
                [pa.array(strings, pa.binary()), few["doc_id"].take(pa.array(row)),
                 few["mark"].take(pa.array(row)), pa.array(place.astype(np.int64))],
                ["string", "doc_id", "mark", "place"],
            )


def _shared_strings(runs: DataFrame) -> DataFrame:
    """Spans of the suffixes that a run of another, earlier document has too.

    Rows grow with the bytes of the runs. First documents are combined per task, and a string of
    very many runs is split at run time by the skew join.
    """
    suffixes = runs.select("octets", "doc_id", "mark", "place").mapInArrow(
        _suffixes, "string binary, doc_id long, mark long, place long"
    )
    first = suffixes.groupBy("string").agg(
        F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
    )
    first = Step(first.where("first < last").select("string", "first"), "firsts").df
    return suffixes.join(first, "string").where("doc_id > first").select(
        "doc_id", "mark", "place", F.lit(1).cast("long").alias("n")
    )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: list[list] = [[] for _ in range(3)]
        for i in range(batch.num_rows):
            octets = batch["text"][i].as_py().encode()
            spans = np.zeros((0, 2), np.int64)
            if batch["spans"][i].is_valid:
                found = batch["spans"][i].values
                place, n = found.field("place").to_numpy(), found.field("n").to_numpy()
                stop = np.where(n < 0, len(octets), place + n + LENGTH - 1)
                order = np.argsort(place, kind="stable")
                place, stop = place[order], np.maximum.accumulate(stop[order])
                apart = np.append(True, place[1:] > stop[:-1])
                last = np.append(np.flatnonzero(apart)[1:] - 1, len(place) - 1)
                spans = np.stack([place[apart], stop[last]], axis=1)
            bounds = [0, *spans.ravel().tolist(), len(octets)]
            out[0].append(len(octets))
            out[1].append([{"start": a, "stop": b} for a, b in spans.tolist()])
            out[2].append(b"".join(octets[a:b] for a, b in zip(bounds[::2], bounds[1::2])))
        kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [batch["row"], pa.array(out[0], pa.int64()), pa.array(out[1], kind), pa.array(out[2], pa.binary())],
            ["row", "n_bytes", "spans", "kept"],
        )


def without_repeats(docs: DataFrame) -> DataFrame:
    """(row, n_bytes, spans, kept) for each document; ``row`` is it as given, without ``text``.

    Texts are UTF-8 bytes, NULL ones empty. ``spans`` are the removed bytes, in order and apart:
    all that are covered by a string of ``LENGTH`` bytes that also starts in a document with a
    smaller ``doc_id``, as the texts are before any removal. ``kept`` are the remaining bytes,
    which need not be valid UTF-8. A document with a NULL ``doc_id`` is neither before nor after
    others and is kept whole. Rows that share a ``doc_id`` are judged each by its own text and
    remove nothing from one another.

    Whole copies are known by a digest of the text and need no runs. Texts are shuffled twice, to
    meet their repeated runs and their spans; everything else that is shuffled is a few bytes per
    run, and of an anchor with more than ``GROUP`` runs a row per suffix: no task gets them all.
    """
    spark = docs.sparkSession
    ship_code(spark)
    text = empty_if_null("text")
    mark = F.xxhash64(text).alias("mark")
    given = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long"), text.alias("text"), mark
    )

    digests = given.where(F.octet_length("text") >= LENGTH).select(
        "doc_id", "mark", F.unhex(F.sha2("text", 256)).alias("digest")
    )
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    copies = digests.join(first.where("n > 1"), "digest").where(F.col("doc_id") > F.col("first"))
    copies = Step(copies.select("doc_id", "mark").distinct(), "copies").df

    buckets = max(64, 2 * shuffle_partitions(spark))
    dealt = given.select("doc_id", "text").mapInArrow(_dealt(buckets), "bucket int, runs binary")
    runs = dealt.groupBy("bucket").applyInArrow(
        _settled, "doc_id long, anchor long, place long, n int"
    )
    runs = Step(runs, "runs")
    of_doc = runs.df.groupBy("doc_id").agg(
        F.collect_list(F.struct("anchor", "place", "n")).alias("runs")
    )
    whole = copies.groupBy("doc_id").agg(F.collect_list("mark").alias("copies"))
    met = given.join(of_doc.join(whole, "doc_id", "left"), "doc_id")
    held = Step(
        met.select("doc_id", "mark", "text", "runs", "copies").mapInArrow(_with_bytes, RUN_ROWS),
        "held",
    )
    runs.drop()

    equal = Step(
        held.df.groupBy("anchor", "digest").agg(
            F.min("doc_id").alias("first"), F.count("*").alias("n_equal")
        ),
        "equal",
    )
    several = equal.df.groupBy("anchor").agg(F.count("*").alias("n_runs")).where("n_runs > 1")
    # A run that is neither repeated nor like another came only for copies of its document.
    asked = equal.df.join(several, "anchor", "left").where("n_equal > 1 OR n_runs IS NOT NULL")
    judged = held.df.join(asked.drop("n_equal"), ["anchor", "digest"])
    later = F.col("doc_id") > F.col("first")
    judged = judged.where(later | F.col("n_runs").isNotNull()).select(
        "doc_id", "mark", "place", "n", later.alias("later"),
        F.when(~later, F.col("anchor")).alias("anchor"),
        F.when(~later, F.col("n_runs")).alias("n_runs"),
        F.when(~later, F.col("octets")).alias("octets"),
    )
    judged = Step(judged, "judged").df
    held.drop()
    equal.drop()

    open_ = judged.where(~F.col("later"))
    group = open_.where(F.col("n_runs") <= GROUP).select("anchor", "doc_id", "mark", "place", "octets")
    group = group.repartition("anchor").sortWithinPartitions("anchor")
    shared = group.mapInArrow(_by_group, "doc_id long, mark long, place long, n long")
    shared = shared.unionByName(_shared_strings(open_.where(F.col("n_runs") > GROUP)))
    removed = judged.where("later").select("doc_id", "mark", "place", F.col("n").cast("long"))
    copied = copies.select("doc_id", "mark", F.lit(0).cast("long").alias("place"), F.lit(-1).cast("long").alias("n"))
    spans = removed.unionByName(shared).unionByName(copied).groupBy("doc_id", "mark").agg(
        F.collect_list(F.struct("place", "n")).alias("spans")
    )
    kept = [F.col(f"`{c}`") for c in docs.columns if c != "text"]
    rows = docs.select(
        F.struct(*kept).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), mark,
        text.alias("text"),
    )
    final = rows.join(spans, ["doc_id", "mark"], "left").select("row", "text", "spans")
    span = T.StructType().add("start", T.LongType()).add("stop", T.LongType())
    schema = T.StructType([rows.schema["row"]]).add("n_bytes", T.LongType())
    schema = schema.add("spans", T.ArrayType(span)).add("kept", T.BinaryType())
    return final.mapInArrow(_kept, schema)

"""Near-duplicates by bottom-k sketches: the smallest hashes of a set, all from one hash function.

Equal sets are one class. Classes in whose sketches the same two hashes follow each other stand in
one inverted list, and lists give candidates; the sketch of a pair's union estimates its similarity
and drops most of them; what is left is compared on full sets, which are made again from the texts
of those alone. Links within a class, and within what is linked already, have nothing to add and
are never made.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Step, empty_if_null, ship_code
from .components import connected_components

# Words whose hash is remembered; a full memory is emptied.
REMEMBERED = 1_000_000

# Bits that say which documents are candidates, in words of 64; of more documents more texts pass
# and find no partner in the join.
BITS = 1 << 24

# Shingles for each set of a tile; of small sets there are four times as many.
TILED = 512


@dataclass(frozen=True)
class Sketches:
    """Links have ``percent`` * union <= 100 * intersection, over sets of ``words``-word shingles.

    ``kept``: hashes of a sketch. ``listed``: lists in which a set stands, at most. At 80 percent
    a set of ``n`` shingles and one that is linked to it have at most ``d = n / 4`` shingles apart,
    so that two shared ones follow each other among the smallest ``2 * d + 2`` of both; of larger
    sets only the ``listed`` smallest such twos are taken, where a link is missed with a
    probability of ``0.52 ** listed``. Single hashes stand in lists below 75 percent, where two
    need not follow each other. ``slack``: how far an estimate may lie below the limit, in standard
    deviations.

    Of a list with up to ``short`` members all pairs are candidates. A longer one is left to the
    short lists of its members, if they stand in ``enough`` of those, and compared in tiles for the
    rest, in ``hot_listed`` lists of a member at most; a tile has ``tile`` sets of ``TILED``
    shingles, or more that are smaller. ``rounds``: members with which each member of a list is
    compared first.
    """

    words: int = 2
    percent: int = 80
    kept: int = 64
    listed: int = 48
    slack: float = 6.0
    short: int = 24
    enough: int = 36
    hot_listed: int = 48
    tile: int = 1_024
    rounds: int = 2

    @property
    def together(self) -> int:
        """Hashes that follow each other and name a list."""
        return 2 if self.percent >= 75 else 1

    def lists_of(self, n: np.ndarray) -> np.ndarray:
        """In how many lists a set of ``n`` shingles stands."""
        apart = n * (100 - self.percent) // self.percent
        most = np.minimum(self.together * apart + 1, n - self.together + 1)
        return np.clip(most, 0, min(self.listed, self.kept - self.together + 1))


# --- sets -------------------------------------------------------------------------


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 42)
        return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, size: int, known: _Words) -> np.ndarray:
    """Sorted hashes of the distinct shingles of a text, from the hashes of its words.

    A-Z are lower-cased; words are runs without ASCII white space. A text of fewer words than a
    shingle has one shingle, which no longer text has.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    if not len(hashes):
        return hashes
    size = min(size, len(hashes))
    mixed = np.full(len(hashes) - size + 1, size, np.uint64)
    for i in range(size):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + len(mixed)])
    return np.unique(mixed)


def shingle_sets(docs: DataFrame, settings: Sketches, whole: bool = True) -> DataFrame:
    """``row`` (all columns but ``text``), ``doc_id``, ``n``, ``mark`` (of the set), ``members``.

    Unless ``whole``, members are the hashes of the sketch only.
    """
    ship_code(docs.sparkSession)
    rest = T.StructType([f for f in docs.schema if f.name != "text"])
    rows = docs.select(
        F.struct(*[F.col(f"`{f.name}`") for f in rest]).alias("row"), "doc_id",
        empty_if_null("text").alias("text"),
    )
    layout = T.StructType().add("row", rest).add("doc_id", rest["doc_id"].dataType)
    layout = layout.add("n", "long").add("mark", "binary").add("members", "binary")
    held = None if whole else 8 * settings.kept

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        known = _Words()
        for batch in batches:
            sets = [shingle_set(t, settings.words, known) for t in batch.column(2).to_pylist()]
            octets = [s.astype("<u8").tobytes() for s in sets]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(o) for o in octets], pa.binary()),
                    pa.array([o[:held] for o in octets], pa.binary()),
                ],
                layout.names,
            )

    return rows.mapInArrow(read, layout)


def whole_sets(docs: DataFrame, ids: DataFrame, settings: Sketches) -> DataFrame:
    """(doc_id, n, members) of the documents of ``ids`` (doc_id), repeats allowed.

    Texts go through the shuffle, which are half as large as their sets, and of other documents
    only those whose bit of a bitmap of fixed size is set by chance.
    """
    place = F.xxhash64("doc_id").bitwiseAND(BITS - 1)
    bit = F.expr("shiftleft(1L, cast(_place & 63 AS int))")
    wanted = ids.distinct().withColumn("_place", place)
    wanted = wanted.withColumn("_mark", F.shiftright("_place", 6))
    marked = wanted.groupBy("_mark").agg(F.bit_or(bit).alias("_bits"))
    texts = docs.select("doc_id", "text", place.alias("_place"))
    texts = texts.join(F.broadcast(marked), F.shiftright("_place", 6) == F.col("_mark"))
    texts = texts.where(F.col("_bits").bitwiseAND(bit) != 0).select("doc_id", "text", "_mark")
    # With the mark as a key Spark can't put this join before the other.
    texts = texts.join(wanted, ["doc_id", "_mark"], "left_semi").drop("_mark")
    return shingle_sets(texts, settings).where("n > 0").select("doc_id", "n", "members")


def _numbers(octets: bytes) -> np.ndarray:
    return np.frombuffer(octets, "<u8")


# --- comparing pairs --------------------------------------------------------------


def _estimated(a: np.ndarray, b: np.ndarray, kept: int) -> tuple[int, int]:
    """Hashes of the sketch of the union, and how many of those both sets have."""
    both = np.concatenate([a, b])
    both.sort()
    twice = both[1:] == both[:-1]
    union = both[np.concatenate([[True], ~twice])][:kept]
    return len(union), int((both[1:][twice] <= union[-1]).sum())


def _compared(pairs: DataFrame, sets: DataFrame, likely: bool, settings: Sketches) -> DataFrame:
    """Pairs (a, b) that are linked, or ``likely`` so by their sketches, once each."""
    ship_code(pairs.sparkSession)
    sides = [
        sets.select(F.col("doc_id").alias(s), F.col("n").alias(f"n_{s}"), F.col("members").alias(f"m_{s}"))
        for s in "ab"
    ]
    rows = pairs.join(sides[0], "a").join(sides[1], "b").select("a", "b", "n_a", "n_b", "m_a", "m_b")
    limit, kept, slack = settings.percent / 100, settings.kept, settings.slack

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for n_a, n_b, a, b in zip(*(batch.column(i).to_pylist() for i in range(2, 6))):
                whole = 100 * min(n_a, n_b) >= settings.percent * max(n_a, n_b)
                if whole and likely:
                    size, common = _estimated(_numbers(a), _numbers(b), kept)
                    if size == kept:
                        whole = common >= limit * size - slack * (limit * (1 - limit) * size) ** 0.5
                    # A smaller union is known in full.
                    elif max(n_a, n_b) <= kept:
                        whole = 100 * common >= settings.percent * size
                elif whole:
                    common = len(np.intersect1d(_numbers(a), _numbers(b), assume_unique=True))
                    whole = 100 * common >= settings.percent * (n_a + n_b - common)
                keep.append(whole)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    layout = T.StructType([rows.schema["a"], rows.schema["b"]])
    return rows.mapInArrow(judged, layout)


def likely_pairs(pairs: DataFrame, heads: DataFrame, settings: Sketches) -> Step:
    """Those of the candidate pairs (a, b) whose sketches say that they may be linked.

    Only the heads, which hold the sketches, meet all candidates.
    """
    return Step(_compared(pairs, heads, True, settings).distinct(), "likely")


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))


def linked(pairs: DataFrame, sets: DataFrame, settings: Sketches) -> DataFrame:
    """Those of the pairs (a, b) that are linked, verified on full sets."""
    return Step(_compared(pairs, sets, False, settings).distinct(), "linked").df


# --- candidates -------------------------------------------------------------------


def inverted(classes: DataFrame, settings: Sketches) -> DataFrame:
    """(value, id, n, place): the lists in which each class stands, ``place`` from 0."""
    ship_code(classes.sparkSession)
    kind = classes.schema["doc_id"].dataType

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ns = batch.column(0), batch.column(1).to_numpy()
            counts = settings.lists_of(ns)
            heads = [_numbers(m) for m in batch.column(2).to_pylist()]
            at = np.repeat(np.arange(len(ns)), counts)
            values = np.zeros(len(at), np.uint64)
            for i in range(settings.together):
                parts = [h[i : i + c] for h, c in zip(heads, counts)]
                hashes = np.concatenate([*parts, np.zeros(0, np.uint64)]).astype(np.uint64)
                values = _mixed(values * np.uint64(0x9E3779B97F4A7C15) + hashes)
            place = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(values.view(np.int64)), ids.take(pa.array(at)), pa.array(ns[at]),
                 pa.array(place)],
                ["value", "id", "n", "place"],
            )

    layout = T.StructType().add("value", "long").add("id", kind).add("n", "long").add("place", "long")
    return classes.select("doc_id", "n", "members").mapInArrow(listed, layout)


def _lists_of(n: Column, settings: Sketches) -> Column:
    """As :meth:`Sketches.lists_of`."""
    apart = F.floor(n * (100 - settings.percent) / settings.percent)
    most = F.least(settings.together * apart + 1, n - settings.together + 1)
    return F.least(most, F.lit(min(settings.listed, settings.kept - settings.together + 1)))


def _near_sizes(a: str, b: str, settings: Sketches):
    least, most = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    return 100 * least >= settings.percent * most


def pivot_pairs(lists: DataFrame, settings: Sketches) -> DataFrame:
    """Each member of a list with ``rounds`` of its members, the first one among them."""
    keys = [F.xxhash64("id", F.lit(turn)) if turn else F.lit(0) for turn in range(settings.rounds)]
    pivots = lists.groupBy("value").agg(
        F.count("*").alias("size"),
        F.array(*[F.min_by(F.struct("id", "n"), F.struct(k, "id")) for k in keys]).alias("_pivots"),
    ).where("size > 1")
    rows = lists.join(pivots, "value").select("id", "n", F.explode("_pivots").alias("_pivot"))
    rows = rows.where(F.col("id") != F.col("_pivot.id"))
    rows = rows.where(_near_sizes("n", "_pivot.n", settings))
    return rows.select(
        F.least("id", "_pivot.id").alias("a"), F.greatest("id", "_pivot.id").alias("b")
    ).distinct()


def _part_of(lists: DataFrame, edges: DataFrame) -> DataFrame:
    """``lists`` with ``part``: the component that a class is in already."""
    parts = connected_components(edges).withColumnsRenamed({"node": "id", "component": "part"})
    return lists.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))


def _open(lists: DataFrame) -> DataFrame:
    """Lists with members of several parts, ``size``: how many members there are."""
    sizes = lists.groupBy("value").agg(
        F.count("*").alias("size"), F.min("part").alias("_least"), F.max("part").alias("_most")
    )
    several = sizes.where(F.col("_least") != F.col("_most")).select("value", "size")
    return lists.join(several, "value")


def short_list_pairs(lists: DataFrame, settings: Sketches) -> DataFrame:
    """All pairs of different parts in short lists, so no member is in more pairs than those hold."""
    grouped = lists.where(F.col("size") <= settings.short).groupBy("value").agg(
        F.collect_list(F.struct("id", "n", "part")).alias("of")
    )
    pairs = grouped.select(F.explode("of").alias("x"), "of").select("x", F.explode("of").alias("y"))
    pairs = pairs.where((F.col("x.id") < F.col("y.id")) & (F.col("x.part") != F.col("y.part")))
    pairs = pairs.where(_near_sizes("x.n", "y.n", settings))
    return pairs.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def long_members(lists: DataFrame, open_lists: DataFrame, settings: Sketches) -> DataFrame:
    """(value, size, id, n, part): members of long lists that stand in few short ones."""
    long = open_lists.where(F.col("size") > settings.short)
    in_long = lists.join(
        lists.groupBy("value").agg(F.count("*").alias("size")).where(F.col("size") > settings.short),
        "value",
    ).groupBy("id", "n").agg(F.count("*").alias("hot"))
    few = in_long.where(_lists_of(F.col("n"), settings) - F.col("hot") < settings.enough)
    members = long.join(few.select("id").distinct(), "id").select(
        "value", "size", "id", "n", "part", "place"
    )
    nth = F.row_number().over(Window.partitionBy("id").orderBy("place"))
    members = members.withColumn("_nth", nth).where(F.col("_nth") <= settings.hot_listed)
    return members.drop("_nth", "place")


def _tiles(settings: Sketches) -> Column:
    """How many tiles the sets of a group need."""
    return F.ceil(
        F.greatest(F.count("*") / (4 * settings.tile), F.sum("n") / (TILED * settings.tile))
    ).cast("long").alias("tiles")


def long_list_links(members: DataFrame, sets: DataFrame, settings: Sketches) -> DataFrame:
    """Links between parts among the given members of long lists.

    Members of a list are sorted by size and dealt into tiles, and tiles whose sizes are near are
    compared in one task, set by set. Of the links only those that join parts are given, so there
    are fewer than members.
    """
    # A list that is one tile is compared as a whole. Of others, members are put in bands of sizes
    # so wide that partners are in the same band or the next.
    step = F.log(F.lit(100 / settings.percent))
    band = F.floor(F.log(F.col("n").cast("double")) / step).cast("long")
    whole = members.groupBy("value").agg(_tiles(settings))
    band = F.when(F.col("tiles") > 1, band).otherwise(F.lit(0).cast("long"))
    rows = members.join(whole, "value").withColumn("band", band).drop("tiles")
    counts = rows.groupBy("value", "band").agg(_tiles(settings))
    rows = rows.join(counts, ["value", "band"])
    tiles = F.col("tiles")
    rows = rows.withColumn("tile", F.pmod(F.xxhash64("id"), tiles))
    # Tiles of the own and of the next band, in which partners may be.
    near = counts.select(
        "value", (F.col("band") - 1).alias("band"),
        F.col("tiles").alias("next_tiles"),
    )
    own = rows.select(
        "*", F.explode(F.sequence(F.lit(0), tiles - 1)).alias("other"), F.lit(0).alias("step")
    ).select(
        "value", "id", "n", "part", "band", F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"), "step", F.lit(0).alias("side"),
    )
    down = rows.join(near, ["value", "band"]).select(
        "value", "id", "n", "part", "band", F.col("tile").alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("next_tiles") - 1)).alias("j"),
        F.lit(1).alias("step"), F.lit(0).alias("side"),
    )
    below = counts.select(
        F.col("value"), (F.col("band") + 1).alias("band"), tiles.alias("_tiles")
    )
    up = rows.join(below, ["value", "band"]).select(
        "value", "id", "n", "part", (F.col("band") - 1).alias("band"),
        F.explode(F.sequence(F.lit(0), F.col("_tiles") - 1)).alias("i"), F.col("tile").alias("j"),
        F.lit(1).alias("step"), F.lit(1).alias("side"),
    )
    work = own.unionByName(down).unionByName(up)
    work = work.join(sets.select(F.col("doc_id").alias("id"), "members"), "id")
    kind = sets.schema["doc_id"].dataType
    layout = T.StructType().add("a", kind).add("b", kind)

    def compared(table: pa.Table) -> pa.Table:
        return _tile_links(table, settings, layout.names)

    links = work.groupBy("value", "band", "i", "j", "step").applyInArrow(compared, layout)
    return Step(links.distinct(), "long-links").df


def _tile_links(table: pa.Table, settings: Sketches, names: list[str]) -> pa.Table:
    """Links of a group that join parts; of a step between bands only those across."""
    ids, parts = table.column("id").to_pylist(), table.column("part").to_pylist()
    sets = [_numbers(m) for m in table.column("members").to_pylist()]
    side, step = table.column("side").to_numpy(), table.column("step")[0].as_py()
    sizes = np.array([len(s) for s in sets])
    stops = np.cumsum(sizes)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    label = np.unique(parts, return_inverse=True)[1]
    here = np.zeros(flat.max() + 1, bool)
    found: tuple[list, list] = ([], [])
    for x in range(len(ids) - 1):
        others = np.arange(x + 1, len(ids))
        others = others[label[others] != label[x]]
        if step:
            others = others[side[others] != side[x]]
        near = 100 * np.minimum(sizes[others], sizes[x])
        others = others[near >= settings.percent * np.maximum(sizes[others], sizes[x])]
        if not len(others):
            continue
        mine = flat[stops[x] - sizes[x] : stops[x]]
        here[mine] = True
        spans = sizes[others]
        offsets = np.cumsum(spans) - spans
        at = np.repeat(stops[others] - spans - offsets, spans) + np.arange(spans.sum())
        common = np.add.reduceat(here[flat[at]], offsets)
        here[mine] = False
        for y in others[100 * common >= settings.percent * (sizes[x] + spans - common)]:
            if label[y] != label[x]:
                found[0].append(min(ids[x], ids[y]))
                found[1].append(max(ids[x], ids[y]))
                label[label == label[y]] = label[x]
    return pa.table({n: pa.array(f, table.column("id").type) for n, f in zip(names, found)})


# --- the operator -----------------------------------------------------------------


def sketch_duplicates(docs: DataFrame, settings: Sketches = Sketches()) -> DataFrame:
    """``row`` (all columns but ``text``), ``n_shingles``, ``component_id`` and ``kept`` per row.

    Documents are linked if their sets of word shingles are similar enough; a component is named
    by its smallest ``doc_id``, whose document is ``kept``. Whole texts count. NULL and empty texts
    have empty sets and are linked with nothing; rows that share a ``doc_id`` are one document;
    one without ``doc_id`` is in no component and kept.
    """
    sets = Step(shingle_sets(docs, settings, whole=False), "sketches").df
    known = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    # Sets of the same mark are the same.
    classes = known.groupBy("mark").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n").alias("n"),
        F.any_value("members").alias("members"),
    )
    heads = Step(classes, "heads")
    first = heads.df.select("mark", F.col("doc_id").alias("first"))
    named = Step(known.select("doc_id", "mark").join(first, "mark").drop("mark"), "classes").df
    all_lists = inverted(heads.df, settings)
    shared = all_lists.groupBy("value").agg(F.count("*").alias("_n")).where("_n > 1").select("value")
    # What stands in a list alone has no candidates there.
    lists = Step(all_lists.join(shared, "value", "left_semi"), "lists").df

    likely = likely_pairs(pivot_pairs(lists, settings), heads.df, settings)
    held = Step(whole_sets(docs, _ends(likely.df), settings), "needed")
    edges = linked(likely.df, held.df, settings)
    likely.drop()
    held.drop()

    open_lists = Step(_open(_part_of(lists, edges)), "open")
    likely = likely_pairs(short_list_pairs(open_lists.df, settings), heads.df, settings)
    heads.drop()
    long = Step(long_members(lists, open_lists.df, settings), "long-lists")
    open_lists.drop()
    needed = _ends(likely.df).unionByName(long.df.select(F.col("id").alias("doc_id")))
    held = Step(whole_sets(docs, needed, settings), "needed")
    edges = edges.unionByName(linked(likely.df, held.df, settings))
    edges = edges.unionByName(long_list_links(long.df, held.df, settings))
    for step in (likely, long, held):
        step.drop()

    copies = named.where(F.col("doc_id") != F.col("first"))
    edges = edges.unionByName(copies.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    parts = connected_components(edges).withColumnsRenamed({"node": "doc_id", "component": "_part"})
    rows = sets.select("row", "doc_id", F.col("n").alias("n_shingles")).join(parts, "doc_id", "left")
    component = F.coalesce("_part", "doc_id")
    return rows.select(
        "row", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )

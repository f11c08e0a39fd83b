"""Approximate nearest neighbours by inner product: a robustly pruned directed graph per shard.

Vectors are lengthened by one number so that all of a shard have the same norm; the nearest by
distance are then those of largest inner product. A graph grows in batches: a greedy beam search
proposes neighbours of each new vector, and relaxed pruning drops a proposal that lies nearer to
one already kept, by the factor ``alpha``, than to the vector itself, which keeps edges in diverse
directions. A second pass over all vectors settles the edges of early ones. Queries run a beam
search on every shard, and inner products of the beam are then computed exactly.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Step, ship_code

# Vectors per shard at most, on average; small tables have FEW shards for as many tasks.
SHARD_ROWS, FEW, LEAST_ROWS = 32_768, 8, 512

# Queries that one task takes to one shard at most, on average.
SLAB_ROWS = 100_000

# Vectors that are searched for or pruned side by side.
SIDE_BY_SIDE = 256
EXPANDED = 4


@dataclass(frozen=True)
class GraphSettings:
    degree: int = 32
    build_beam: int = 64
    search_beam: int = 128
    alpha: float = 1.2


def lengthened(vectors: np.ndarray) -> np.ndarray:
    """Vectors with one more coordinate that gives all of them the largest norm."""
    squares = (vectors.astype(np.float64) ** 2).sum(axis=1)
    extra = np.sqrt(np.maximum(squares.max(initial=0) - squares, 0))
    return np.concatenate([vectors, extra[:, None]], axis=1).astype(np.float32)


def beam_search(
    points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, width: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each query the ``width`` nearest points met, nearest first, and squared distances.

    Points that were not met are -1 at infinite distance. Each step expands the nearest
    unexpanded points of every beam.
    """
    n, m = len(points), len(queries)
    norms = (points * points).sum(axis=1)
    own = (queries * queries).sum(axis=1)
    met = np.zeros((m, n + 1), bool)
    met[:, n] = True  # where missing edges point to
    met[:, start] = True
    ids = np.full((m, width), -1)
    distance = np.full((m, width), np.inf, np.float32)
    done = np.zeros((m, width), bool)
    ids[:, 0] = start
    distance[:, 0] = norms[start] + own - 2 * queries @ points[start]
    active = np.arange(m)
    while len(active):
        waiting = np.where(done[active], np.inf, distance[active])
        best = np.argsort(waiting, axis=1, kind="stable")[:, :EXPANDED]
        open_ = np.isfinite(np.take_along_axis(waiting, best, axis=1))
        going = open_[:, 0]
        active, best, open_ = active[going], best[going], open_[going]
        if not len(active):
            break
        rows = active[:, None]
        expanded = np.where(open_, ids[rows, best], -1)
        done[rows, best] |= open_
        near = np.where(expanded[:, :, None] >= 0, edges[expanded], -1).reshape(len(active), -1)
        near = np.where(near < 0, n, near)
        near = np.where(met[rows, near], n, near)
        # A point may be the neighbour of several expanded ones.
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = n
        met[rows, near] = True
        found = np.minimum(near, n - 1)
        reach = norms[found] + own[rows] - 2 * np.einsum("rkd,rd->rk", points[found], queries[active])
        reach = np.where(near < n, reach, np.inf)
        all_ids = np.concatenate([ids[active], np.where(near < n, near, -1)], axis=1)
        all_far = np.concatenate([distance[active], reach], axis=1)
        all_done = np.concatenate([done[active], np.zeros(near.shape, bool)], axis=1)
        keep = np.argsort(all_far, axis=1, kind="stable")[:, :width]
        ids[active] = np.take_along_axis(all_ids, keep, axis=1)
        distance[active] = np.take_along_axis(all_far, keep, axis=1)
        done[active] = np.take_along_axis(all_done, keep, axis=1)
    return ids, distance


def robust_prune(
    points: np.ndarray, nodes: np.ndarray, proposed: np.ndarray, degree: int, alpha: float
) -> np.ndarray:
    """At most ``degree`` of the ``proposed`` neighbours of each node; -1 stands for none."""
    proposed = np.sort(proposed, axis=1)
    proposed[:, 1:][proposed[:, 1:] == proposed[:, :-1]] = -1
    proposed[proposed == nodes[:, None]] = -1
    vectors = points[proposed]
    norms = (points * points).sum(axis=1)
    far = norms[proposed] + norms[nodes][:, None]
    far = far - 2 * np.einsum("rkd,rd->rk", vectors, points[nodes])
    between = norms[proposed][:, :, None] + norms[proposed][:, None, :]
    between = between - 2 * vectors @ vectors.transpose(0, 2, 1)
    far = np.where(proposed < 0, np.inf, np.maximum(far, 0))
    out = np.full((len(nodes), degree), -1)
    rows = np.arange(len(nodes))
    left = far.copy()
    for i in range(degree):
        best = left.argmin(axis=1)
        kept = np.isfinite(left[rows, best])
        if not kept.any():
            break
        out[:, i] = np.where(kept, proposed[rows, best], -1)
        covered = alpha * alpha * between[rows, best] <= far
        left = np.where(covered & kept[:, None], np.inf, left)
        left[rows, best] = np.inf
    return out


def _connect_back(
    points: np.ndarray, edges: np.ndarray, nodes: np.ndarray, settings: GraphSettings
) -> None:
    """Give the neighbours of ``nodes`` an edge back, and prune those that have too many."""
    targets = edges[nodes].ravel()
    sources = np.repeat(nodes, edges.shape[1])
    sources, targets = sources[targets >= 0], targets[targets >= 0]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    known = (edges[targets] == sources[:, None]).any(axis=1)
    sources, targets = sources[~known], targets[~known]
    unique, first, count = np.unique(targets, return_index=True, return_counts=True)
    # What a point gets at once beyond its degree is taken in further rounds.
    for taken in range(0, int(count.max(initial=0)), settings.degree):
        some = count > taken
        nodes_, first_, count_ = unique[some], first[some] + taken, count[some] - taken
        slots = np.arange(settings.degree)
        place = np.minimum(first_[:, None] + slots, len(sources) - 1)
        new = np.where(slots < count_[:, None], sources[place], -1)
        for at in range(0, len(nodes_), SIDE_BY_SIDE):
            part = slice(at, at + SIDE_BY_SIDE)
            own = nodes_[part]
            held = np.concatenate([edges[own], new[part]], axis=1)
            room = (held >= 0).sum(axis=1) <= settings.degree
            ordered = -np.sort(-held, axis=1)[:, : settings.degree]
            pruned = robust_prune(points, own, held, settings.degree, settings.alpha)
            edges[own] = np.where(room[:, None], ordered, pruned)


def build_graph(points: np.ndarray, settings: GraphSettings) -> tuple[np.ndarray, int]:
    """Edges of each point, -1 for none, and the point where searches start."""
    n = len(points)
    edges = np.full((n, settings.degree), -1)
    middle = points.mean(axis=0)
    start = int(((points - middle) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    for second in (False, True):
        done, size = (0, SIDE_BY_SIDE) if second else (1, 1)
        while done < n:
            batch = order[done : done + size]
            found, _ = beam_search(points, edges, start, points[batch], settings.build_beam)
            # Those that come in together may propose one another.
            mates = np.broadcast_to(batch[: settings.degree], (len(batch), min(len(batch), settings.degree)))
            proposed = np.concatenate([found, edges[batch], mates], axis=1)
            edges[batch] = robust_prune(points, batch, proposed, settings.degree, settings.alpha)
            _connect_back(points, edges, batch, settings)
            done += size
            size = min(2 * size, SIDE_BY_SIDE)
    return edges, start


GRAPH = (
    "dim int, shard int, start int, n int, vectors binary, edges binary,"
    " ids binary, id_counts binary"
)


def _built(settings: GraphSettings):
    def built(table: pa.Table) -> pa.Table:
        dim = table["dim"][0].as_py()
        flat = table["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = flat.reshape(-1, dim).astype(np.float32)
        edges, start = build_graph(lengthened(vectors), settings)
        ids = table["ids"].combine_chunks()
        row = {
            "dim": [dim],
            "shard": [table["shard"][0].as_py()],
            "start": [start],
            "n": [len(vectors)],
            "vectors": [vectors.tobytes()],
            "edges": [edges.astype(np.int32).tobytes()],
            "ids": [ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64).tobytes()],
            "id_counts": [ids.value_lengths().to_numpy(zero_copy_only=False).astype(np.int32).tobytes()],
        }
        types = {k: pa.int32() for k in ("dim", "shard", "start", "n")}
        types |= {k: pa.binary() for k in ("vectors", "edges", "ids", "id_counts")}
        return pa.table({k: pa.array(v, types[k]) for k, v in row.items()})

    return built


def _searched(k: int, settings: GraphSettings):
    def searched(graphs: pa.Table, queries: pa.Table) -> pa.Table:
        out: dict[str, list] = {"query_id": [], "vec_id": [], "score": []}
        if graphs.num_rows and queries.num_rows:
            _search_shard(graphs.to_pylist()[0], queries, k, settings, out)
        types = {"query_id": pa.int64(), "vec_id": pa.int64(), "score": pa.float64()}
        arrays = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
        return pa.table({c: pa.array(arrays[c]).cast(t) for c, t in types.items()})

    return searched


def _search_shard(
    graph: dict, queries: pa.Table, k: int, settings: GraphSettings, out: dict[str, list]
) -> None:
    n, dim = graph["n"], graph["dim"]
    vectors = np.frombuffer(graph["vectors"], np.float32).reshape(n, dim)
    edges = np.frombuffer(graph["edges"], np.int32).reshape(n, -1)
    counts = np.frombuffer(graph["id_counts"], np.int32).astype(np.int64)
    ids = np.frombuffer(graph["ids"], np.int64)
    first = np.cumsum(counts) - counts
    points = lengthened(vectors)
    exact = vectors.astype(np.float64)
    asked = queries["query_id"].to_numpy()
    flat = queries["embedding"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    flat = flat.reshape(-1, dim).astype(np.float32)
    width = max(settings.search_beam, 2 * k)
    for at in range(0, len(flat), SIDE_BY_SIDE):
        part = flat[at : at + SIDE_BY_SIDE]
        longer = np.concatenate([part, np.zeros((len(part), 1), np.float32)], axis=1)
        found, _ = beam_search(points, edges, graph["start"], longer, width)
        score = np.einsum("rkd,rd->rk", exact[found], part.astype(np.float64))
        score = np.where(found >= 0, score, -np.inf)
        for i, query in enumerate(asked[at : at + SIDE_BY_SIDE].tolist()):
            best = np.argsort(-score[i], kind="stable")[: k + 1]
            # All whose score equals the last one's belong to the choice by id.
            best = np.flatnonzero((score[i] >= score[i][best[-1]]) & (found[i] >= 0))
            rows = found[i][best]
            size = counts[rows]
            place = np.repeat(first[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())
            held, near = ids[place], np.repeat(score[i][best], size)
            held, near = held[held != query], near[held != query]
            order = np.lexsort((held, -near))[:k]
            out["query_id"].append(np.full(len(order), query, np.int64))
            out["vec_id"].append(held[order])
            out["score"].append(near[order])


def takes_part(vector: Column) -> Column:
    """Whether a vector is neither NULL nor zero and has finite numbers only."""
    bad = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20,
    settings: GraphSettings = GraphSettings(),
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest vectors found for each query.

    Both frames have ``vec_id`` and ``embedding``. Nearness is the inner product in double
    precision, ties go to the smaller ``vec_id``, and a query never finds its own. Vectors that
    are NULL or zero or hold NULL or infinite numbers, and rows without ``vec_id``, take no part;
    vectors of another length than the query's are no candidates. Repeated rows count once; a
    table may be empty.

    All vectors are indexed. Equal vectors are one point with its ``k + 1`` smallest ids, which
    are all that can be asked of them. Each query meets each shard's graph once, in slabs.
    """
    spark = vectors.sparkSession
    ship_code(spark)
    usable = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"))
    usable = usable.where(F.col("vec_id").isNotNull() & takes_part(F.col("embedding")))
    rank = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = usable.distinct().withColumn("rank", rank).where(F.col("rank") <= k + 1)
    points = few.groupBy("embedding").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = Step(points.withColumn("dim", F.size("embedding")), "points").df
    n = points.count()
    shards = max(-(-n // SHARD_ROWS), min(FEW, -(-n // LEAST_ROWS)), 1)
    part = F.pmod(F.xxhash64("embedding", F.lit(5)), shards).cast("int")
    graphs = points.withColumn("shard", part).groupBy("dim", "shard").applyInArrow(
        _built(settings), GRAPH
    )
    graphs = Step(graphs, "graphs").df
    asked = queries.select(
        F.col("vec_id").cast("long").alias("query_id"),
        F.col("embedding").cast("array<float>").alias("embedding"),
    ).where(F.col("query_id").isNotNull() & takes_part(F.col("embedding"))).distinct()
    slabs = max(1, -(-asked.count() // SLAB_ROWS))
    asked = asked.select(
        F.size("embedding").alias("dim"),
        F.pmod(F.xxhash64("query_id"), slabs).cast("int").alias("slab"),
        "query_id", "embedding",
    ).withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    copies = graphs.withColumn("slab", F.explode(F.sequence(F.lit(0), F.lit(slabs - 1))))
    key = ["dim", "shard", "slab"]
    found = copies.groupBy(*key).cogroup(asked.groupBy(*key)).applyInArrow(
        _searched(k, settings), "query_id long, vec_id long, score double"
    )
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    place = F.row_number().over(
        Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    )
    return best.withColumn("rank", place).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )

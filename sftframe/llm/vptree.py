"""Nearest neighbours by vantage-point trees, one per shard of rows.

A node holds a vantage point and the median distance to it; inside and outside are its halves.  A query walks to
its nearer half first and enters the other only if the triangle inequality allows a neighbour there:
``|d - median| <= factor * (distance of the k-th found)``.  Factor 1 is exact, smaller ones prune more.  All
queries of a block walk a tree together.  Shards hold at most ``SHARD`` vectors.  Queries are written to the shared
folder in blocks of about ``BLOCK`` vectors; a task builds the tree of a shard once and reads the blocks one after the
other, so neither grows with the table and the driver sees no vector.

Vectors that are null, zero, or hold null or non-finite components, and rows without id, take no part.  Vectors
of another length than the query's are no candidates.  Rows with the query's id are its own and are left out.
Query rows that share an id all ask: the id's ranks run over the neighbours of each of them.  Other repeated rows
stand for themselves; ties go to the smaller id.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sftframe.llm import textcore as X

SHARD = 16_384
BLOCK = 8_192
LEAF = 256
_FOUND = "query_id long, vec_id long, score double"


def usable(vector: Column) -> Column:
    """Whether a vector takes part in a search."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def distances(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, component after component."""
    total = np.zeros((len(queries), len(points)))
    for d in range(points.shape[1]):
        step = np.subtract.outer(queries[:, d], points[:, d])
        step *= step
        total += step
    return np.sqrt(total, out=total)


@dataclass
class Tree:
    """A node with a vantage point, or a leaf with rows."""

    rows: np.ndarray
    point: int = -1
    median: float = 0.0
    inside: Tree | None = None
    outside: Tree | None = None


def build(points: np.ndarray) -> Tree:
    """A tree over all rows of ``points``; a part whose distances are all alike becomes a leaf whatever its size."""
    rng = np.random.default_rng(len(points))

    def grow(rows: np.ndarray) -> Tree:
        if len(rows) <= LEAF:
            return Tree(rows)
        point = rows[rng.integers(len(rows))]
        to = distances(points[point : point + 1], points[rows])[0]
        median = float(np.median(to))
        near = to <= median
        if near.all():
            near = to < median
        if near.all() or not near.any():
            return Tree(rows)
        return Tree(rows[:0], int(point), float(to[near].max()), grow(rows[near]), grow(rows[~near]))

    return grow(np.arange(len(points)))


class Search:
    """The k nearest found so far of every query of a block, in one shard."""

    def __init__(self, points, ids, queries, query_ids, k, factor):
        self.points, self.ids, self.queries, self.query_ids, self.factor = points, ids, queries, query_ids, factor
        self.far = np.full((len(queries), k), np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def leaf(self, rows: np.ndarray, active: np.ndarray) -> None:
        k = self.far.shape[1]
        for part in np.array_split(rows, max(1, len(rows) // (4 * LEAF))):
            to = distances(self.queries[active], self.points[part])
            ids = np.broadcast_to(self.ids[part], to.shape)
            to = np.where(ids == self.query_ids[active][:, None], np.inf, to)
            every = np.concatenate([self.far[active], to], 1)
            names = np.concatenate([self.found[active], np.where(np.isinf(to), np.iinfo(np.int64).max, ids)], 1)
            order = np.lexsort((names, every), axis=-1)[:, :k]
            self.far[active] = np.take_along_axis(every, order, 1)
            self.found[active] = np.take_along_axis(names, order, 1)

    def walk(self, tree: Tree, active: np.ndarray) -> None:
        if not len(active):
            return
        if tree.point < 0:
            self.leaf(tree.rows, active)
            return
        to = distances(self.queries[active], self.points[tree.point : tree.point + 1])[:, 0]
        near = to <= tree.median
        for first, second, mine in ((tree.inside, tree.outside, near), (tree.outside, tree.inside, ~near)):
            self.walk(first, active[mine])
            reach = self.factor * self.far[active[mine], -1]
            self.walk(second, active[mine][np.abs(to[mine] - tree.median) <= reach * (1 + 1e-12) + 1e-12])


def search_shard(tree, points, ids, queries, query_ids, k, factor):
    """``(query row, id, distance)`` of the k nearest that the shard has for every query."""
    run = Search(points, ids, queries, query_ids, k, factor)
    run.walk(tree, np.arange(len(queries)))
    row, rank = np.nonzero(np.isfinite(run.far))
    return row, run.found[row, rank], run.far[row, rank]


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


@functools.lru_cache(1)
def _queries(folder: str, number: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of a stored block by the vectors' length; the last block read stays with the worker."""
    table = X.read_block(folder, "block", number)
    if table is None:
        return {}
    ids, lists = table.column("vec_id").combine_chunks(), table.column("vector").combine_chunks()
    lengths, found = lists.value_lengths().to_numpy(zero_copy_only=False), {}
    for length in np.unique(lengths):
        rows = pa.array(np.flatnonzero(lengths == length))
        found[int(length)] = ids.take(rows).to_numpy(), _matrix(lists.take(rows), int(length))
    return found


def _searcher(folder: str, blocks: int, k: int, factor: float):
    def run(batches):
        ids: dict[int, list] = {}
        kept: dict[int, list] = {}

        def flush(length):
            points, names = np.concatenate(kept.pop(length)), np.concatenate(ids.pop(length))
            tree = build(points)
            for number in range(blocks):
                query_ids, queries = _queries(folder, number).get(length, (None, None))
                if query_ids is not None:
                    row, found, far = search_shard(tree, points, names, queries, query_ids, k, factor)
                    yield pa.record_batch([query_ids[row], found, far], names=["query_id", "vec_id", "score"])

        for batch in batches:
            lists = batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths):
                rows = pa.array(np.flatnonzero(lengths == length))
                points, names = _matrix(lists.take(rows), int(length)), batch.column(0).take(rows).to_numpy()
                for at in range(0, len(names), SHARD):
                    kept.setdefault(length, []).append(points[at : at + SHARD])
                    ids.setdefault(length, []).append(names[at : at + SHARD])
                    if sum(map(len, ids[length])) >= SHARD:
                        yield from flush(length)
        for length in list(ids):
            yield from flush(length)
        X.give_back()

    return run


def nearest(points: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, vec_id: str = "vec_id", vector: str = "embedding", block: int = BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest ``points`` of each of ``queries``."""
    if k < 1 or factor <= 0:
        raise ValueError("k and factor must be positive")
    plain = lambda df: df.where(F.col(vec_id).isNotNull() & usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    asked = plain(queries)
    blocks = max(1, -(-asked.count() // block))
    folder = X.stored_blocks(asked.repartition(blocks).withColumn("block", F.spark_partition_id()), "block", "vptree-queries")
    found = plain(points).mapInArrow(_searcher(folder, blocks, k, factor), _FOUND)
    best = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

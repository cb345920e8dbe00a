"""Approximate nearest neighbours with vantage-point trees.

Every shard of the vectors has a tree over its different unit vectors: a node
holds a vantage point and the median distance to it, its halves hold the points
nearer and farther. A search leaves out a half when the triangle inequality
shows that nothing in it can be nearer than the best found; dividing that best
distance by a factor above one leaves out more. Queries go through a tree in
blocks; a task holds a group of blocks and takes its trees one after the other,
so what a query found in one tree bounds its search in the next. Factor one
gives exact answers.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
LEAF = 64
FACTOR = 1.0
GROUP_BYTES = 64 << 20  # of queries that a task holds
LEAST_MOVED = 1 << 30  # bytes that may be shuffled in copies however small the tables are
_SLACK = 1e-9
_TIES = 8  # different vectors kept beyond the wanted number, for ties
_TIE = 1e-7  # distances that may belong to one cosine


@dataclass
class Tree:
    """vectors: the different ones; ids: the smallest ids of each, and where each one's begin.

    A node is (vantage, radius, inside, outside), a leaf (points,); the root comes last.
    """

    vectors: np.ndarray
    ids: np.ndarray
    first: np.ndarray
    nodes: list[tuple]

    @cached_property
    def units(self) -> np.ndarray:
        return self.vectors / np.linalg.norm(self.vectors, axis=1, keepdims=True)


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector by a power of two near 1: no cosine changes in any bit, and no square overflows."""
    vectors = vectors.astype(float)
    exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))[1]
    return np.ldexp(vectors, -exponent[:, None])


def build(ids: np.ndarray, vectors: np.ndarray, keep: int) -> Tree:
    """Tree of a shard; of equal vectors only the ``keep`` smallest ids can ever be among the nearest."""
    raw = np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).reshape(-1)
    _, one, where = np.unique(raw, return_index=True, return_inverse=True)
    order = np.lexsort((ids, where))
    begin = np.searchsorted(where[order], np.arange(len(one)))
    turn = np.arange(len(order)) - begin[where[order]]
    order = order[turn < keep]
    tree = Tree(scaled(vectors[one]), ids[order], np.searchsorted(where[order], np.arange(len(one) + 1)), [])
    units = tree.units

    def grow(points: np.ndarray) -> int:
        if len(points) > LEAF:
            # the point farthest from one of them splits better than one in the middle
            start = units[points[0]]
            vantage = points[int(np.argmax(((units[points] - start) ** 2).sum(1)))]
            rest = points[points != vantage]
            away = np.sqrt(((units[rest] - units[vantage]) ** 2).sum(1))
            radius = float(np.median(away))
            inside, outside = rest[away < radius], rest[away >= radius]
            if len(inside) and len(outside):
                a, b = grow(inside), grow(outside)
                tree.nodes.append((int(vantage), radius, a, b))
                return len(tree.nodes) - 1
        tree.nodes.append((points,))
        return len(tree.nodes) - 1

    if len(one):
        grow(np.arange(len(one)))
    return tree


def search(tree: Tree, queries: np.ndarray, wanted: int, factor: float = FACTOR, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """For each query the numbers of its nearest vectors of the tree, -1 where there are fewer, and their distances.

    Vectors beyond the ``bound`` of a query are left out. A query first meets
    the leaf it would lie in, then all queries go through the tree together.
    """
    units = tree.units
    asked = queries / np.linalg.norm(queries, axis=1, keepdims=True)
    size = wanted + _TIES
    near = np.full((len(asked), size), np.inf)
    which = np.full((len(asked), size), -1, np.int64)
    cap = np.full(len(asked), np.inf) if bound is None else bound
    home = np.full(len(asked), -1)

    def offer(who: np.ndarray, points: np.ndarray, cosine: np.ndarray) -> None:
        reach = np.minimum(near[who, -1], cap[who])
        some = np.flatnonzero(cosine.max(1) >= 1 - reach * reach / 2 - _SLACK)
        if not len(some):
            return
        who = who[some]
        far = np.sqrt(np.maximum(2 - 2 * cosine[some], 0))
        within = far <= cap[who][:, None]
        both = np.hstack([near[who], np.where(within, far, np.inf)])
        names = np.hstack([which[who], np.where(within, points, -1)])
        best = np.argsort(both, axis=1, kind="stable")[:, :size]
        near[who], which[who] = np.take_along_axis(both, best, 1), np.take_along_axis(names, best, 1)

    def leaf(points: np.ndarray, who: np.ndarray) -> None:
        for a in range(0, len(points), 4096):
            some = points[a : a + 4096]
            offer(who, some, asked[who] @ units[some].T)

    def settle(number: int, who: np.ndarray) -> None:
        node = tree.nodes[number]
        if len(node) == 1:
            home[who] = number
            leaf(node[0], who)
            return
        vantage, radius, inside, outside = node
        nearer = np.sqrt(np.maximum(2 - 2 * (asked[who] @ units[vantage]), 0)) < radius
        for child, some in ((inside, who[nearer]), (outside, who[~nearer])):
            if len(some):
                settle(child, some)

    def visit(number: int, who: np.ndarray) -> None:
        node = tree.nodes[number]
        if len(node) == 1:
            who = who[home[who] != number]
            if len(who):
                leaf(node[0], who)
            return
        vantage, radius, inside, outside = node
        cosine = asked[who] @ units[vantage]
        offer(who, np.array([vantage]), cosine[:, None])
        gap = np.sqrt(np.maximum(2 - 2 * cosine, 0)) - radius
        for child, beyond in ((inside, gap), (outside, -gap)):
            some = who[beyond <= np.minimum(near[who, wanted - 1], cap[who]) / factor + _TIE]
            if len(some):
                visit(child, some)

    if tree.nodes and len(asked):
        root, every = len(tree.nodes) - 1, np.arange(len(asked))
        settle(root, every)
        visit(root, every)
    return which, near


def _points(tree: Tree, queries: np.ndarray, which: np.ndarray, near: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Query number and vector of all that may be among the nearest ``wanted``.

    Where even the last place kept is a tie of the last one wanted, all vectors
    of the shard are looked at once more.
    """
    number, slot = np.nonzero(which >= 0)
    point = which[number, slot]
    full = np.flatnonzero((which[:, -1] >= 0) & (near[:, -1] <= near[:, wanted - 1] + _TIE))
    if len(full):
        keep = ~np.isin(number, full)
        numbers, points = [number[keep]], [point[keep]]
        units, asked = tree.units, queries[full] / np.linalg.norm(queries[full], axis=1, keepdims=True)
        for a in range(0, len(full), 256):
            far = np.sqrt(np.maximum(2 - 2 * (asked[a : a + 256] @ units.T), 0))
            q, p = np.nonzero(far <= near[full[a : a + 256], wanted - 1][:, None] + _TIE)
            numbers.append(full[a + q])
            points.append(p)
        number, point = np.concatenate(numbers), np.concatenate(points)
    return number, point


def _found(tree: Tree, names: np.ndarray, queries: np.ndarray, which: np.ndarray, near: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query number, id and cosine of the ``k`` best rows of a tree for each query, its own id left out."""
    number, point = _points(tree, queries, which, near, k + 1)
    a, b = queries[number], tree.vectors[point]
    score = (a * b).sum(1) / (np.sqrt((a * a).sum(1)) * np.sqrt((b * b).sum(1)))
    count = np.diff(tree.first)[point]
    spread = np.repeat(np.arange(len(point)), count)
    turn = np.arange(len(spread)) - np.repeat(np.cumsum(count) - count, count)
    ids, number, score = tree.ids[tree.first[point[spread]] + turn], number[spread], score[spread]
    other = ids != names[number]
    ids, number, score = ids[other], number[other], score[other]
    order = np.lexsort((ids, -score, number))
    ids, number, score = ids[order], number[order], score[order]
    place = np.arange(len(number)) - np.searchsorted(number, number)
    return number[place < k], ids[place < k], score[place < k]


def _narrow(vectors: np.ndarray) -> np.ndarray:
    """The same numbers in half the bytes, where these hold them."""
    with np.errstate(over="ignore"):
        half = vectors.astype(np.float32)
    return half if (half == vectors).all() else vectors


def _packed(tree: Tree) -> bytes:
    return pickle.dumps((_narrow(tree.vectors), tree.ids, tree.first, tree.nodes))


def _unpacked(blob: bytes) -> Tree:
    vectors, ids, first, nodes = pickle.loads(blob)
    return Tree(vectors.astype(float), ids, first, nodes)


def _index(k: int) -> Callable:
    def run(key: tuple, table: pa.Table) -> pa.Table:
        ids, vectors = _matrix(table, key[0].as_py())
        return _row(key, _packed(build(ids, vectors, k + 1)))

    return run


def _row(key: tuple, data: bytes) -> pa.Table:
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "data": pa.array([data], pa.large_binary()).cast(pa.binary())})


def _matrix(table: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray]:
    flat = pa.concat_arrays([c.flatten() for c in table.column("v").chunks]) if table.num_rows else pa.array([], pa.float64())
    return table.column("id").to_numpy(), flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _block(key: tuple, table: pa.Table) -> pa.Table:
    return _row(key, pickle.dumps(_matrix(table, key[0].as_py())))


class _Block:
    """A block of queries with the ``k`` best rows each has met so far, best first."""

    def __init__(self, blob: bytes, k: int):
        self.names, self.vectors = pickle.loads(blob)
        self.ids = np.full((len(self.names), k), -1, np.int64)
        self.score = np.full((len(self.names), k), -np.inf)

    def meet(self, tree: Tree, factor: float) -> None:
        queries, k = scaled(self.vectors), self.ids.shape[1]
        bound = np.sqrt(np.maximum(2 - 2 * self.score[:, -1], 0)) + _TIE
        which, near = search(tree, queries, k + 1, factor, bound)
        number, ids, score = _found(tree, self.names, queries, which, near, k)
        some, at = np.unique(number, return_inverse=True)
        place = np.arange(len(number)) - np.searchsorted(number, number)
        more, worth = np.full((len(some), k), -1, np.int64), np.full((len(some), k), -np.inf)
        more[at, place], worth[at, place] = ids, score
        ids, score = np.hstack([self.ids[some], more]), np.hstack([self.score[some], worth])
        best = np.lexsort((ids, -score), axis=-1)[:, :k]
        self.ids[some], self.score[some] = np.take_along_axis(ids, best, 1), np.take_along_axis(score, best, 1)

    def rows(self) -> pa.RecordBatch:
        number, place = np.nonzero(self.score > -np.inf)
        return pa.RecordBatch.from_arrays([pa.array(self.names[number]), pa.array(self.ids[number, place]), pa.array(self.score[number, place])], ["query_id", "vec_id", "score"])


def _searched(k: int, factor: float) -> Callable:
    """Rows (cell, dim, kind, part, data) in this order: the blocks of a cell come before its trees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, blocks = None, []
        for batch in batches:
            for cell, dim, kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), batch.column(4)):
                if here != (cell, dim):
                    yield from (b.rows() for b in blocks)
                    here, blocks = (cell, dim), []
                if kind == 0:
                    blocks.append(_Block(data.as_py(), k))
                elif blocks:
                    tree = _unpacked(data.as_py())
                    for b in blocks:
                        b.meet(tree, factor)
        yield from (b.rows() for b in blocks)

    return run


def _cells(tasks: int, size: float, asked: float, shards: int, blocks: int) -> tuple[int, int]:
    """Groups of query blocks and groups of trees; each pair of them is a cell, met by one task.

    Trees are copied for each group of queries, queries for each group of
    trees. A group of queries is at most GROUP_BYTES; beyond that there are as
    many cells as ``tasks``, or fewer where the copies would be many times the
    tables (of ``size`` and ``asked`` bytes).
    """
    least = min(blocks, max(1, math.ceil(asked / GROUP_BYTES)))
    while True:
        across = min(blocks, max(least, math.ceil(math.sqrt(tasks * asked / max(size, 1.0)))))
        down = min(shards, math.ceil(tasks / across))
        if tasks == 1 or across * size + down * asked <= max(4 * size, LEAST_MOVED):
            return across, down
        tasks = math.ceil(tasks / 2)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 5, factor: float = FACTOR, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest rows by cosine, ties to the smaller id.

    Rows without id, and vectors that are null, empty, zero or hold null or
    non-finite numbers take no part; only vectors of the same length are
    compared. Rows with the query's id are not its neighbours. Repeated query
    rows ask once. Fewer candidates give fewer rows.
    """

    def usable(df: DataFrame) -> DataFrame:
        v = F.col("v")
        bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
        rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("v"))
        return rows.filter(F.col("id").isNotNull() & v.isNotNull() & ~F.exists(v, bad) & F.exists(v, lambda x: x != 0)).withColumn("dim", F.size("v"))

    rows, asked = usable(vectors), usable(queries).dropDuplicates(["id", "v"])
    size = F.coalesce(F.sum("dim"), F.lit(0)) * (4 if isinstance(vectors.schema[embedding].dataType.elementType, T.FloatType) else 8)
    (total, held), (count, sought) = (df.agg(F.count("*"), size).first() for df in (rows, asked))
    shards, blocks = max(1, -(-total // shard_rows)), max(1, -(-count // block_rows))
    across, down = _cells(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), held, sought, shards, blocks)
    rows = rows.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("long"))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("long"))
    kept = "dim int, part long, data binary"
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    trees = rows.groupBy("dim", "part").applyInArrow(_index(k), kept).withColumns({"_a": every(across), "_b": F.col("part") % down, "kind": F.lit(1)})
    cut = asked.groupBy("dim", "part").applyInArrow(_block, kept).withColumns({"_a": F.col("part") % across, "_b": every(down), "kind": F.lit(0)})
    met = [df.select((F.col("_a") * down + F.col("_b")).cast("int").alias("cell"), "dim", "kind", "part", "data") for df in (cut, trees)]
    # by its number a cell has a task of its own; there is no join whose side Spark could take for small
    spread = met[0].unionAll(met[1]).repartitionById(across * down, "cell").sortWithinPartitions("cell", "dim", "kind", "part")
    found = spread.mapInArrow(_searched(k, factor), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def neighbour_digest(vectors: DataFrame) -> DataFrame:
    """Queries are the rows whose id is divisible by 50."""
    return nearest(vectors, vectors.filter("vec_id % 50 = 0"))

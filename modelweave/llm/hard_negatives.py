"""Hard negatives by windows of scores, found in multiway hyperplane trees.

The score of two rows is the inner product of their whole-number vectors. One
more component gives all rows of a shard the same length, so that a score is a
distance: a window of scores around an anchor is an annulus. A node of a shard's
tree has a few split points; a row belongs to the nearest of them (the cells are
cut by hyperplanes), and every split point keeps the smallest and largest
distance to each of the sibling cells. A search measures an anchor against the
split points and leaves out the cells whose range of possible distances misses
the annulus, which shrinks from outside while better rows are found. Leaves are
scanned exactly, in whole numbers.

Anchors and windows go through every shard's tree in blocks; the best of each
shard are merged by Spark. Positives are the same search without a window.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.plans.workspace import store

SHARD_ROWS = 16_384
BLOCK_ROWS = 1024
WAYS = 8
LEAF = 512
_SLACK = 1e-6  # of the radius, for distances taken from differences of large numbers
_NEVER = -(1 << 62)  # no score
_NOBODY = (1 << 63) - 1


@dataclass
class Tree:
    """Rows in leaf order; a node is (splits, nearest, farthest, children), a leaf (begin, end)."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    radius: float
    root: tuple


def build(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, ways: int = WAYS, leaf: int = LEAF) -> Tree:
    """Tree of a shard. Equal vectors, which no split can part, share a leaf of any size."""
    points = vectors.astype(float)
    square = (points**2).sum(1)
    most = float(square.max(initial=0))
    extra = np.sqrt(most - square)
    random = np.random.default_rng(0)
    order: list[np.ndarray] = []
    placed = 0

    def away(some: np.ndarray, splits: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(2 * most - 2 * (points[some] @ points[splits].T + np.outer(extra[some], extra[splits])), 0))

    def grow(some: np.ndarray) -> tuple:
        nonlocal placed
        if len(some) > leaf:
            tried = random.choice(some, min(len(some), 3 * ways), replace=False)
            apart = away(tried, tried)
            picked = [0]
            near = apart[0]
            while len(picked) < ways and near.max() > 0:
                picked.append(int(near.argmax()))  # the one farthest from those taken
                near = np.minimum(near, apart[picked[-1]])
            splits = tried[picked]
            far = away(some, splits)
            cell = far.argmin(1)
            inside = [cell == j for j in range(len(splits))]
            if sum(x.any() for x in inside) > 1:
                nearest = np.array([[far[x, i].min(initial=np.inf) for x in inside] for i in range(len(splits))])
                farthest = np.array([[far[x, i].max(initial=-np.inf) for x in inside] for i in range(len(splits))])
                return points[splits], nearest, farthest, [grow(some[x]) for x in inside]
        order.append(some)
        placed += len(some)
        return placed - len(some), placed

    root = grow(np.arange(len(ids)))
    by = np.concatenate(order)
    return Tree(ids[by], labels[by], vectors[by], float(np.sqrt(most)), root)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number vectors, exact also where a double is not; more than 64 bits raise an error."""
    bound = float(np.abs(a.astype(float)).max(initial=0)) * float(np.abs(b.astype(float)).max(initial=0)) * max(a.shape[1], 1)
    if bound < 2**53:
        return a.astype(float) @ b.astype(float).T
    return (a.astype(object) @ b.astype(object).T).astype(np.int64)


def search(
    tree: Tree, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, wanted: int
) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the best ``wanted`` rows per query with low <= score <= high, the same (or another) label and another id."""
    asked = vectors.astype(float)
    square = (asked**2).sum(1)
    total = square + tree.radius**2
    slack = _SLACK * np.sqrt(total)
    distance = lambda who, score: np.sqrt(np.maximum(total[who] - 2 * score.astype(float), 0))
    inner = distance(np.arange(len(asked)), high)
    names = np.full((len(asked), wanted), _NOBODY)
    best = np.full((len(asked), wanted), _NEVER)
    least = low.copy()  # a row below it cannot be among the best any more

    def scan(begin: int, end: int, who: np.ndarray) -> None:
        for a in range(begin, end, 4096):
            part = slice(a, min(a + 4096, end))
            score = _exact(vectors[who], tree.vectors[part])
            query, row = np.nonzero(score >= least[who, None])  # few, once something is found
            score, query, row = score[query, row].astype(np.int64), who[query], row + a
            fits = (score <= high[query]) & (tree.ids[row] != ids[query]) & ((tree.labels[row] == labels[query]) == same)
            # against rounding of the bound in a double
            fits &= score >= least[query]
            score, query, row = score[fits], query[fits], row[fits]
            if not len(query):
                continue
            at = np.unique(query)
            both = np.concatenate([best[at].reshape(-1), score])
            name = np.concatenate([names[at].reshape(-1), tree.ids[row]])
            owner = np.concatenate([np.repeat(at, wanted), query])
            order = np.lexsort((name, -both, owner))
            owner = owner[order]
            turn = np.arange(len(owner)) - np.searchsorted(owner, owner)
            first = order[turn < wanted]
            best[at], names[at] = both[first].reshape(-1, wanted), name[first].reshape(-1, wanted)
            least[at] = np.maximum(low[at], best[at, -1])

    def visit(node: tuple, who: np.ndarray) -> None:
        if len(node) == 2:
            scan(*node, who)
            return
        splits, nearest, farthest, children = node
        to = distance(who[:, None], asked[who] @ splits.T)
        nearer = np.maximum(to[:, :, None] - farthest, nearest - to[:, :, None]).max(1)
        farther = (to[:, :, None] + farthest).min(1)
        reached = farther + slack[who, None] >= inner[who, None]
        # first the cell that begins nearest to the inner edge, for a close bound; then all others at once
        begin = np.where(reached, np.maximum(nearer, inner[who, None]), np.inf) + 1e-3 * to
        first = begin.argmin(1)
        for j, child in enumerate(children):
            mine = (first == j) & reached[:, j] & (nearer[:, j] - slack[who] <= distance(who, least[who]))
            if mine.any():
                visit(child, who[mine])
        for j, child in enumerate(children):
            mine = (first != j) & reached[:, j] & (nearer[:, j] - slack[who] <= distance(who, least[who]))
            if mine.any():
                visit(child, who[mine])

    if len(asked) and len(tree.ids):
        visit(tree.root, np.arange(len(asked)))
    return names, best


def _table(table: pa.Table, dim: int) -> dict[str, np.ndarray]:
    """Columns of a group as arrays, ``v`` as a matrix."""
    flat = pa.concat_arrays([c.flatten() for c in table.column("v").chunks]) if table.num_rows else pa.array([], pa.int64())
    out = {n: table.column(n).to_numpy() for n in table.column_names if n not in ("v", "dim", "part")}
    return out | {"v": flat.to_numpy(zero_copy_only=False).reshape(table.num_rows, dim)}


def _small(vectors: np.ndarray) -> np.ndarray:
    """The narrowest whole-number type that holds the components."""
    most = int(np.abs(vectors).max(initial=0))
    return vectors.astype(np.int16 if most < 2**15 else np.int32 if most < 2**31 else np.int64)


def _grown(key: tuple, table: pa.Table) -> pa.Table:
    rows = _table(table, key[0].as_py())
    blob = pickle.dumps(build(rows["id"], rows["label"], _small(rows["v"])))
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "part": pa.array([key[1].as_py()], pa.int64()), "tree": pa.array([blob], pa.binary())})


def _block(key: tuple, table: pa.Table) -> pa.Table:
    rows = _table(table, key[0].as_py())
    blob = pickle.dumps(rows | {"v": _small(rows["v"])})
    return pa.table({"dim": pa.array([key[0].as_py()], pa.int32()), "block": pa.array([blob], pa.binary())})


def _searched(same: bool, wanted: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, block in zip(batch.column(0), batch.column(1)):
                tree, asked = pickle.loads(tree.as_py()), pickle.loads(block.as_py())
                names, scores = search(tree, asked["id"], asked["label"], asked["v"], asked["low"], asked["high"], same, wanted)
                query, slot = np.nonzero(scores > _NEVER)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked["ask"][query]), pa.array(names[query, slot]), pa.array(scores[query, slot])], ["ask", "found", "score"]
                )

    return run


def _best(index: DataFrame, shards: int, asked: DataFrame, same: bool, wanted: int, block_rows: int) -> DataFrame:
    """(ask, found, score, rank): the first ``wanted`` rows of all shards for each row of ``asked`` (ask, id, label, v, low, high)."""
    blocks = max(1, -(-asked.count() // block_rows))
    cut = asked.withColumn("dim", F.size("v")).withColumn("part", F.pmod(F.xxhash64("ask"), F.lit(blocks)))
    cut = store(cut.groupBy("dim", "part").applyInArrow(_block, "dim int, block binary"), "anchors")
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long")))
    pairs = index.join(cut.select("dim", "block", parts.alias("part")), ["dim", "part"]).select("tree", "block")
    found = pairs.mapInArrow(_searched(same, wanted), "ask long, found long, score long")
    rank = F.row_number().over(Window.partitionBy("ask").orderBy(F.desc("score"), "found"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= wanted)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int, int] = (80, 100, 100),
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
    vec_id: str = "vec_id",
    label: str = "label",
    embedding: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``embedding`` holds whole numbers. An anchor's positives are its first rows
    of the same label by score, ties by id; for each of them come the first rows
    of other labels with window[0] * positive <= window[2] * negative <=
    window[1] * positive. Rows with a null in id, label, vector or a component
    take no part; vectors are compared with those of the same length. Rows with
    the anchor's id are not its partners; repeated anchor rows ask once, other
    repeated rows count each. No row of the window gives no result row. A score
    beyond 64 bits raises an error.
    """
    rows = vectors.select(
        F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"), F.col(f"`{embedding}`").cast("array<bigint>").alias("v"), is_anchor.alias("_a")
    )
    rows = rows.filter("id is not null and label is not null and v is not null and not exists(v, x -> x is null)").withColumn("dim", F.size("v"))
    shards = max(1, -(-rows.count() // shard_rows))
    parted = rows.select("id", "label", "v", "dim", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("part"))
    index = store(parted.groupBy("dim", "part").applyInArrow(_grown, "dim int, part long, tree binary"), "trees")
    anchors = rows.filter("_a").select("id", "label", "v").distinct()
    # an anchor's number tells rows of one id apart
    anchors = store(anchors.withColumn("ask", F.monotonically_increasing_id()), "asked")
    every = anchors.select("ask", "id", "label", "v", F.lit(_NEVER + 1).alias("low"), F.lit(-_NEVER).alias("high"))
    near = _best(index, shards, every, True, positives, block_rows).select(F.col("ask").alias("_ask"), F.col("found").alias("positive_id"), F.col("score").alias("positive_score"))
    low, high, whole = window
    pairs = near.join(anchors, F.col("_ask") == F.col("ask")).drop("ask", "_ask").withColumn("ask", F.monotonically_increasing_id())
    pairs = store(pairs, "windows")
    wide = F.col("positive_score").cast("decimal(30,0)")
    bounds = pairs.select(
        "ask", "id", "label", "v", F.ceil(wide * low / whole).cast("long").alias("low"), F.floor(wide * high / whole).cast("long").alias("high")
    ).filter("low <= high")
    found = _best(index, shards, bounds, False, negatives, block_rows)
    return found.join(pairs.select("ask", F.col("id").alias("anchor_id"), "positive_id", "positive_score"), "ask").select(
        "anchor_id", "positive_id", "rank", F.col("found").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )


def hard_negative_digest(vectors: DataFrame) -> DataFrame:
    """Components as floor(256 x), labels of ids divisible by 7 moved by one, anchors are the ids divisible by 100."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = vectors.filter(~F.exists("embedding", bad)).select("vec_id", label.alias("label"), scaled.alias("embedding"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


SQL = """
with rows as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * x::double)) as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select a.vec_id as anchor_id, r.vec_id, r.label = a.label as same, list_inner_product(a.v, r.v)::bigint as score
    from rows a join rows r on a.vec_id % 100 = 0 and r.vec_id <> a.vec_id and len(a.v) = len(r.v)
),
positive as (
    select anchor_id, vec_id as positive_id, score as positive_score from scored where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select p.anchor_id, p.positive_id,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) as integer) as rank,
    n.vec_id as negative_id, p.positive_score, n.score as negative_score
from positive p join scored n on n.anchor_id = p.anchor_id and not n.same
    and 80 * p.positive_score <= 100 * n.score and 100 * n.score <= 100 * p.positive_score
qualify row_number() over (partition by p.anchor_id, p.positive_id order by n.score desc, n.vec_id) <= 5
"""

"""Trie of conversation prefixes, with subtree totals by time-forward processing.

A node is a sequence of turns with which conversations begin. Nodes come from
one aggregate over (conversation, depth) rows: the key of a prefix is the
exclusive or of hashes of (position, turn) in two 64-bit lanes, which partial
results of different tasks can be put together to, so that one conversation with
a third of all turns spreads over many tasks.

Subtree totals: the nodes are cut into shards by ranges of their path (the first
turns, then the depth), so a hot first turn or a very long conversation is cut
as well. In a shard Spark sorts the nodes by reverse level order, externally;
every node adds what lies for it in a priority queue to its own values and puts
the total into the queue for its parent. The queue writes sorted runs to a
temporary file when it grows. What is meant for a parent of another shard leaves
as one row per parent. These parents, with the next such parent above each of
them, form a much smaller tree, which is solved in the same way; a second pass
of the shards then starts from its totals.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from array import array
from collections.abc import Callable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelweave.plans.positions import dense_index, in_order
from modelweave.plans.workspace import store

SHARD_NODES = 100_000
QUEUE_ITEMS = 200_000
PATH_TURNS = 8  # turns of a path that decide its range
_RUN_ITEMS = 1000
_CHUNK_BYTES = 1 << 16
_KEY = ("depth", "k1", "k2")
_UP = ("up_depth", "up1", "up2")
_ROW_BITS = 33  # of monotonically_increasing_id, below the partition number


class SpillingQueue:
    """Priority queue of tuples; beyond ``limit`` of them its content goes to a temporary file as a sorted run."""

    def __init__(self, limit: int = QUEUE_ITEMS) -> None:
        self.limit = limit
        self.heap: list[tuple] = []
        self.runs: list[tuple] = []  # (head of the run, its number, iterator)
        self.spilled = 0

    def push(self, item: tuple) -> None:
        heapq.heappush(self.heap, item)
        if len(self.heap) > self.limit:
            self._spill()

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()  # has no name, so nothing stays behind
        self.heap.sort()
        for a in range(0, len(self.heap), _RUN_ITEMS):
            pickle.dump(self.heap[a : a + _RUN_ITEMS], file)
        file.seek(0)

        def run() -> Iterator[tuple]:
            with file:
                while True:
                    try:
                        yield from pickle.load(file)
                    except EOFError:
                        return

        self.heap = []
        self._next(run(), self.spilled)
        self.spilled += 1

    def _next(self, run: Iterator[tuple], number: int) -> None:
        head = next(run, None)
        if head is not None:
            heapq.heappush(self.runs, (head, number, run))

    def first(self) -> tuple | None:
        if self.runs and not (self.heap and self.heap[0] < self.runs[0][0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and not (self.heap and self.heap[0] < self.runs[0][0]):
            head, number, run = heapq.heappop(self.runs)
            self._next(run, number)
            return head
        return heapq.heappop(self.heap)


def _forward(limit: int, outgoing: Callable | None) -> Callable:
    """A function of (key, parent, own values) rows in reverse level order that gives (children, leaves, saved) of their subtrees.

    Messages whose parent does not come are handed to ``outgoing``.
    """
    queue = SpillingQueue(limit)

    def leave(before: tuple | None) -> None:
        while (head := queue.first()) is not None and (before is None or head[0] < before):
            queue.pop()
            if outgoing:
                outgoing(*head)

    def step(key: tuple, up: tuple | None, number: int, children: int, leaves: int, saved: int) -> tuple[int, int, int, list[int]]:
        # the order of the stream: deepest first
        here = (-key[0], key[1], key[2])
        leave(here)
        below = []
        while (head := queue.first()) is not None and head[0] == here:
            _, who, more_leaves, more_saved = queue.pop()
            children, leaves, saved = children + 1, leaves + more_leaves, saved + more_saved
            below.append(who)
        if up is not None:
            queue.push(((-up[0], up[1], up[2]), number, leaves, saved))
        return children, leaves, saved, below

    return step, leave


def _rows_of(batch: pa.RecordBatch, names: tuple[str, ...]) -> Iterator[tuple]:
    return zip(*[batch.column(batch.schema.names.index(n)).to_pylist() for n in names])


_STREAM = ("shard", *_KEY, *_UP, "children", "leaves", "saved")


def _totals(limit: int) -> Callable:
    """Appends the totals of each node's subtree within its shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, step = None, None
        for batch in batches:
            out = []
            for row in _rows_of(batch, _STREAM):
                if row[0] != shard:
                    shard, (step, _) = row[0], _forward(limit, None)
                out.append(step(row[1:4], None if row[4] is None else row[4:7], 0, *row[7:])[:3])
            sums = [pa.array(c, pa.int64()) for c in zip(*out)] if out else [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([*batch.columns, *sums], [*batch.schema.names, "all_children", "all_leaves", "all_saved"])

    return run


_OUT = "depth long, k1 long, k2 long, up_depth long, up1 long, up2 long, children long, leaves long, saved long"


def _leaving(limit: int) -> Callable:
    """What leaves each shard, summed by the parent it is for; and for every node the parent above its shard's root."""

    def shard_rows(rows: Iterator[tuple]) -> Iterator[tuple]:
        sums: dict[tuple, list[int]] = {}
        above = array("q")  # number of the parent, or -1 - number of the way out
        ways: list[tuple] = []
        keys = array("q")

        def outgoing(target: tuple, number: int, leaves: int, saved: int) -> None:
            key = (-target[0], target[1], target[2])
            if key not in sums:
                sums[key] = [len(ways), 0, 0, 0]
                ways.append(key)
            total = sums[key]
            total[1], total[2], total[3] = total[1] + 1, total[2] + leaves, total[3] + saved
            above[number] = -2 - total[0]

        step, leave = _forward(limit, outgoing)
        for number, row in enumerate(rows):
            above.append(-1)
            keys.extend(row[1:4])
            for child in step(row[1:4], None if row[4] is None else row[4:7], number, *row[7:])[3]:
                above[child] = number
        leave(None)
        for key, (_, *total) in sums.items():
            yield (*key, None, None, None, *total)
        for number in range(len(above) - 1, -1, -1):  # parents first
            if above[number] >= 0:
                above[number] = above[above[number]]
            if above[number] < -1:
                yield (*keys[3 * number : 3 * number + 3], *ways[-2 - above[number]], None, None, None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = chain.from_iterable(_rows_of(b, _STREAM) for b in batches)
        head = next(rows, None)
        out: list[tuple] = []
        while head is not None:
            shard, after = head[0], [None]

            def own(first: tuple = head, shard: int = shard, after: list = after) -> Iterator[tuple]:
                yield first
                for row in rows:
                    if row[0] != shard:
                        after[0] = row
                        return
                    yield row

            for row in shard_rows(own()):
                out.append(row)
                if len(out) == 20_000:
                    yield _batch(out)
                    out = []
            head = after[0]
        if out:
            yield _batch(out)

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [*_KEY, *_UP, "children", "leaves", "saved"]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)


def _key(names: tuple[str, ...] = _KEY) -> Column:
    return F.struct(*[F.col(n).alias(m) for n, m in zip(names, _KEY)])


def _in_level_order(nodes: DataFrame) -> DataFrame:
    return nodes.sortWithinPartitions("shard", F.desc("depth"), "k1", "k2")


def _by_doubling(ports: DataFrame) -> DataFrame:
    """Totals of a tree that is too large for one shard: each round adds what stands twice as far below."""
    state = store(ports.select(_key().alias("node"), F.when(F.col("up_depth").isNotNull(), _key(_UP)).alias("up"), "leaves", "saved"), "doubling")
    while state.filter("up is not null").limit(1).count():
        below = state.filter("up is not null").groupBy(F.col("up").alias("node")).agg(F.sum("leaves").alias("_leaves"), F.sum("saved").alias("_saved"))
        far = state.select(F.col("node").alias("up"), F.col("up").alias("_far"))
        added = state.join(below, "node", "left").join(far, "up", "left")
        grown = [(F.col(n) + F.coalesce(f"_{n}", F.lit(0))).alias(n) for n in ("leaves", "saved")]
        state = store(added.select("node", F.col("_far").alias("up"), *grown), "doubling")
    return state.select("node.*", F.col("leaves").alias("all_leaves"), F.col("saved").alias("all_saved"))


def subtree_totals(nodes: DataFrame, shard_nodes: int = SHARD_NODES, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """``nodes`` with all_children, all_leaves and all_saved: children of a node, and sums of ``leaves`` and ``saved`` over its subtree.

    nodes: depth, k1, k2 (the key), up_depth, up1, up2 (the parent's key, null
    for a root), path (an array that says where in the tree the node stands),
    leaves, saved, and further columns of other names.
    """
    shards = max(1, -(-nodes.count() // shard_nodes))
    columns = [F.col(f"`{c}`") for c in nodes.columns if c != "path"]
    spread = nodes.repartitionByRange(shards, "path", *_KEY) if shards > 1 else nodes.repartition(1)
    placed = store(spread.select(*columns, F.lit(0).cast("long").alias("children"), F.spark_partition_id().alias("shard")), "shards")
    schema = lambda df: ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    results = "all_children long, all_leaves long, all_saved long"
    if shards > 1:
        left = _in_level_order(placed.repartition("shard")).mapInArrow(_leaving(queue_items), _OUT)
        left = store(left, "leaving")
        sums = left.filter("leaves is not null").groupBy(*_KEY).agg(*[F.sum(c).alias(c) for c in ("children", "leaves", "saved")])
        ways = left.filter("leaves is null").select(*_KEY, *_UP)
        ports = store(sums.join(ways, [*_KEY], "left"), "roots")
        if ports.count() <= shard_nodes:
            one = _in_level_order(ports.withColumn("shard", F.lit(0)).repartition(1))
            solved = one.mapInArrow(_totals(queue_items), f"{schema(one)}, {results}")
        else:
            solved = _by_doubling(ports)
        outside = ports.select(*_KEY, F.col("children").alias("_children")).join(solved.select(*_KEY, "all_leaves", "all_saved"), [*_KEY])
        outside = outside.select(_key().alias("_node"), "_children", "all_leaves", "all_saved")
        joined = placed.join(outside, _key() == F.col("_node"), "left")
        own = {c: F.coalesce(f"_{c}", F.lit(0)) if c == "children" else F.col(c) + F.coalesce(f"all_{c}", F.lit(0)) for c in ("children", "leaves", "saved")}
        placed = joined.withColumns(own).select(*placed.columns)
    stream = _in_level_order(placed.repartition("shard"))
    return stream.mapInArrow(_totals(queue_items), f"{schema(stream)}, {results}").drop("shard", "children")


def turns_of(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, h1, h2, words): the turns without their texts, two hashes of role and text instead.

    A null role or text is empty; rows without conv_id belong to no conversation.
    """
    role, text = F.coalesce(F.col(f"`{role}`"), F.lit("")), F.coalesce(F.col(f"`{text}`"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = conversations.filter(F.col(f"`{conv_id}`").isNotNull())
    return rows.select(
        F.col(f"`{conv_id}`").cast("long").alias("conv_id"),
        F.col(f"`{turn}`").alias("turn"),
        role.alias("role"),
        F.xxhash64(role, text).alias("h1"),
        F.conv(F.substring(digest, 1, 15), 16, 10).cast("long").alias("h2"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )


def share_prefixes(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Rebuilt conversations: (conv_id, pos, h1, h2, words, last) and (conv_id, n_turns).

    Conversation c gets the first h turns of conversation c - c % block, h =
    crc32(decimal c) % most, then its own turns after its first h. Turns of one
    number are ordered by role and then by their hashes.
    """
    placed = store(dense_index(turns, ["conv_id", "turn"], "_i"), "turns")
    own = store(placed.groupBy("conv_id").agg(F.min("_i").alias("_first"), F.count("*").alias("_own")), "conversations")
    base = F.col("conv_id") - F.col("conv_id") % block
    crc = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    # at most most - 1 turns of each conversation are lent
    first = placed.filter(F.col("conv_id") == base).join(own, "conv_id").filter(F.col("_i") - F.col("_first") < most - 1)
    first = first.select("conv_id", F.struct((F.col("_i") - F.col("_first") + 1).alias("pos"), "h1", "h2", "words").alias("_t"))
    lent = first.groupBy("conv_id").agg(F.array_sort(F.collect_list("_t")).alias("_lent")).withColumnRenamed("conv_id", "_base")
    convs = own.withColumn("_base", base).withColumn("_h", F.when(F.col("conv_id") == base, F.lit(0)).otherwise(crc).cast("int"))
    convs = convs.join(lent, "_base", "left").withColumn("_lent", F.coalesce(F.slice("_lent", F.lit(1), F.col("_h")), F.expr("array()")))
    convs = convs.withColumn("n_turns", F.size("_lent") + F.greatest(F.col("_own") - F.col("_h"), F.lit(0)))
    convs = store(convs.select("conv_id", "_first", "_h", "_lent", "n_turns"), "rebuilt")
    pos = F.col("_i") - F.col("_first") + 1 - F.col("_h") + F.size("_lent")
    rest = placed.join(convs, "conv_id").filter(F.col("_i") - F.col("_first") >= F.col("_h"))
    rest = rest.select("conv_id", pos.alias("pos"), "h1", "h2", "words", (pos == F.col("n_turns")).alias("last"))
    heads = convs.select("conv_id", "n_turns", F.explode("_lent").alias("_t"))
    heads = heads.select("conv_id", "_t.pos", "_t.h1", "_t.h2", "_t.words", (F.col("_t.pos") == F.col("n_turns")).alias("last"))
    return rest.unionByName(heads), convs.select("conv_id", "n_turns")


def _prefixes(turns: DataFrame) -> DataFrame:
    """``turns`` with k1, k2 (key of the prefix that ends here) and up1, up2 (without its last turn)."""
    keyed = turns.withColumns({"g1": F.xxhash64("pos", "h1"), "g2": F.xxhash64("h2", "pos", F.lit(7))})
    ordered = in_order(keyed, ["conv_id", "pos"], unique=True).withColumn("_at", F.monotonically_increasing_id())
    placed = store(ordered, "paths").withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    # a conversation may go over several partitions: what its earlier ones add up to
    parts = placed.groupBy("conv_id", "_part").agg(F.bit_xor("g1").alias("c1"), F.bit_xor("g2").alias("c2"))
    earlier = Window.partitionBy("conv_id").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = parts.select("conv_id", "_part", F.bit_xor("c1").over(earlier).alias("c1"), F.bit_xor("c2").over(earlier).alias("c2"))
    carry = F.broadcast(carry.filter("c1 is not null"))  # at most one row per partition, for the conversation it begins with
    here = Window.partitionBy("_part", "conv_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = placed.withColumns({"k1": F.bit_xor("g1").over(here), "k2": F.bit_xor("g2").over(here)}).join(carry, ["conv_id", "_part"], "left")
    rows = rows.withColumns({f"k{i}": F.col(f"k{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0))) for i in (1, 2)})
    return rows.withColumns({f"up{i}": F.col(f"k{i}").bitwiseXOR(F.col(f"g{i}")) for i in (1, 2)})


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered (key, conv_id) rows as comma-joined pieces with their first conversation."""
    key, ids, size, out = None, [], 0, []
    for batch in batches:
        for *here, conv in _rows_of(batch, (*_KEY, "conv_id")):
            if here != key or size > _CHUNK_BYTES:
                if ids:
                    out.append((*key, ids[0], ",".join(map(str, ids))))
                key, ids, size = here, [], 0
            ids.append(conv)
            size += 20
        if len(out) > 1000:
            yield _chunk_batch(out)
            out = []
    if ids:
        out.append((*key, ids[0], ",".join(map(str, ids))))
    if out:
        yield _chunk_batch(out)


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4])], [*_KEY, "first", "ids"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the pieces of each key, one piece in memory at a time."""
    key, state, out = None, None, []
    for batch in batches:
        for *here, ids in _rows_of(batch, (*_KEY, "ids")):
            if here == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = here, hashlib.sha256()
            state.update(ids.encode())
        if len(out) > 1000:
            yield _hash_batch(out)
            out = []
    if key is not None:
        out.append((*key, state.hexdigest()))
    if out:
        yield _hash_batch(out)


def _hash_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3])], [*_KEY, "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame, shard_nodes: int = SHARD_NODES, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    turns: conv_id, pos (from 1, gapless), h1, h2, words, last (its conversation
    ends here); convs: conv_id, n_turns, once for each conversation, also without
    turns. Without conversations there is no node. Turns of equal (h1, h2) are
    one turn.
    """
    rows = _prefixes(turns).select("conv_id", F.col("pos").alias("depth"), "k1", "k2", "up1", "up2", "words", "last")
    zero = F.lit(0).cast("long")
    roots = convs.select("conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), zero.alias("up1"), zero.alias("up2"), zero.alias("words"), (F.col("n_turns") == 0).alias("last"))
    rows = store(rows.unionByName(roots), "prefixes")
    grouped = rows.groupBy(*_KEY).agg(
        F.min("conv_id").alias("conv_id"),
        F.count("*").alias("n_convs"),
        F.count_if("last").alias("_ends"),
        F.max("words").alias("_words"),
        F.max("up1").alias("up1"),
        F.max("up2").alias("up2"),
    )
    begin = turns.filter(F.col("pos") <= PATH_TURNS).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("pos", "h1"))).alias("_path"))
    nodes = grouped.join(begin, "conv_id", "left").select(
        *_KEY,
        F.when(F.col("depth") > 0, F.col("depth") - 1).alias("up_depth"),
        *[F.when(F.col("depth") > 0, F.col(c)).alias(c) for c in ("up1", "up2")],
        F.slice(F.coalesce(F.col("_path.h1"), F.expr("array()")), F.lit(1), F.least(F.col("depth"), F.lit(PATH_TURNS)).cast("int")).alias("path"),
        "conv_id",
        "n_convs",
        # all its conversations end here: a node without children
        (F.col("_ends") == F.col("n_convs")).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("_words")).alias("saved"),
    )
    nodes = store(nodes, "nodes")
    totals = subtree_totals(nodes, shard_nodes, queue_items)
    ends = rows.filter("last").select(*_KEY, "conv_id")
    pieces = ends.repartitionByRange(*_KEY, "conv_id").sortWithinPartitions(*_KEY, "conv_id").mapInArrow(_chunks, "depth long, k1 long, k2 long, first long, ids string")
    hashes = pieces.repartition(*_KEY).sortWithinPartitions(*_KEY, "first").mapInArrow(_hashed, "depth long, k1 long, k2 long, ends_sha256 string")
    parents = nodes.select(*[F.col(c).alias(u) for c, u in zip(_KEY, _UP)], F.col("conv_id").alias("parent_conv_id"))
    found = totals.join(hashes, [*_KEY], "left").join(parents, [*_UP], "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.col("all_children").alias("n_children"),
        F.col("all_leaves").alias("n_leaves"),
        F.col("all_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )


def trie_digest(conversations: DataFrame, shard_nodes: int = SHARD_NODES, queue_items: int = QUEUE_ITEMS) -> DataFrame:
    """The trie of the rebuilt conversations."""
    turns, convs = share_prefixes(turns_of(conversations))
    return prefix_trie(store(turns, "rebuilt"), convs, shard_nodes, queue_items)


SQL = r"""
with recursive ids as (select distinct conv_id as c from conversations where conv_id is not null),
crc(c, s, i, v) as (
    select c, c::varchar, 0, 4294967295::bigint from ids
    union all
    select c, s, i + 1, list_reduce(list_prepend(xor(v, ascii(s[i + 1])::bigint), [0, 0, 0, 0, 0, 0, 0, 0]::bigint[]), lambda x, y: xor(x >> 1, 3988292384::bigint * (x & 1)))
    from crc where i < length(s)
),
heads as (select c, case when c % 20 = 0 then 0 else xor(v, 4294967295::bigint) % 4 end as h from crc where i = length(s)),
turns as (
    select conv_id as c, coalesce(role, '') as r, coalesce(text, '') as t,
        row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as p
    from conversations where conv_id is not null
),
rebuilt as (
    select heads.c, 0 as part, p, r, t from heads join turns on turns.c = heads.c - heads.c % 20 and p <= h
    union all
    select heads.c, 1, p, r, t from heads join turns on turns.c = heads.c and p > h
),
seq as (
    select c, row_number() over w as d, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) as words, md5(len(r) || ':' || r || t) as k
    from rebuilt window w as (partition by c order by part, p)
),
paths as (
    select c, d, words, string_agg(k, '') over (partition by c order by d) as k from seq
    union all
    select c, 0, 0, '' from ids
),
member as (select *, d = max(d) over (partition by c) as last from paths),
nodes as (
    select k, d, min(c) as c, count(*) as n, (count(*) - 1) * max(words) as saved, bool_and(last) as leaf,
        sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (last), '')) as ends
    from member group by k, d
),
above as (select unnest(range(0, d + 1)) as j, k, leaf, saved from nodes),
totals as (select left(k, 32 * j) as k, sum(saved) as saved, count_if(leaf) as leaves from above group by 1),
children as (select left(k, 32 * (d - 1)) as k, count(*) as n from nodes where d > 0 group by 1)
select nodes.c::bigint as conv_id, nodes.d::bigint as depth, up.c::bigint as parent_conv_id, nodes.n::bigint as n_convs,
    coalesce(children.n, 0)::bigint as n_children, totals.leaves::bigint as n_leaves, totals.saved::bigint as saved_tokens, nodes.ends as ends_sha256
from nodes join totals on totals.k = nodes.k left join children on children.k = nodes.k
    left join nodes up on nodes.d > 0 and up.k = left(nodes.k, 32 * (nodes.d - 1))
"""

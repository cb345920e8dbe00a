"""MinHash near-dedup with SetSketch registers.

A register keeps the smallest of the exponentially distributed points that the
shingles of a set throw at it, as a whole number on an exponential scale. Points
come from a Poisson process per shingle, cut into blocks of time, so a set only
looks at as many points as its registers need. Bands of registers name
buckets; in a bucket every text is compared with one pivot, so a group of
copies gives links in proportion to its size. The joint likelihood of the
registers drops pairs that are far from the threshold, the rest is confirmed on
the full sets. Buckets that still hold several components are opened again with
other pivots until a round finds no new link. What is still open then is
settled pair by pair: every two members of different components of a small
bucket become a pair, members of a large one meet in blocks that count common
shingles of all their pairs at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.components import smallest_reachable
from modelweave.llm.tokens import find_words, group_places, group_rows, group_schema, group_size, mix, pieces, run_hashes, tidy
from modelweave.plans.workspace import scratch, store

BANDS, ROWS = 48, 6  # a pair at similarity 0.8 shares no band with probability 5e-7
REGISTERS = BANDS * ROWS
BASE, RATE = 1.001, 20.0
PIVOTS = 4  # of a text in the first rounds
WORTH = 200  # pairs of a round per link, at most, for another round to follow
_POINTS = 300_000  # drawn at once: bounds the memory of a task
_SETS = 1024  # texts whose registers a task holds as floating numbers at once
_OPEN_KEYS = 1 << 18  # band keys that a task groups at once
_TASK_BITS = 32  # of the number of a part of a task
_SURE = 6.0  # a register stays without a point with probability exp(-6)
_NULL_ID = -(1 << 63)
_SET_BYTES = 6  # of a shingle's hash in a stored set
SMALL = 8  # members of a bucket whose pairs become rows in the end
BLOCK = 512  # members of a larger bucket that meet as many others in one piece of work
_COMMON = 16  # a shingle of more sets of a piece of work is counted by matrix product
_COLUMNS = 2048  # of such a matrix at once


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, and where each text's begin.

    A text with fewer words than ``size`` is one shingle, a text without words
    none. A-Z count as a-z.
    """
    words = find_words(texts, lower=True)
    n = np.diff(words.first)
    ends = np.repeat(words.first[1:], n)
    begin = np.arange(len(words.start))
    full = np.flatnonzero(begin + size <= ends)
    short = np.flatnonzero((n > 0) & (n < size))
    sums = words.sums()
    hashes = np.concatenate([run_hashes(sums, full, full + size), run_hashes(sums, words.first[short], words.first[short + 1])])
    doc = np.concatenate([np.repeat(np.arange(len(n)), n)[full], short])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(doc), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    hashes, doc = hashes[new], doc[new]
    return hashes, np.searchsorted(doc, np.arange(len(n) + 1))


@cache
def _block(number: int) -> tuple[float, float, np.ndarray]:
    """Expected points of a shingle before a block of time, within it, and the distribution of their count."""
    before = 0.0 if number == 0 else 2.0**number
    inside = 2.0 if number == 0 else 2.0**number
    top = int(inside + 12 * np.sqrt(inside) + 20)
    logs = np.arange(top) * np.log(inside) - inside - np.concatenate([[0], np.cumsum(np.log(np.arange(1, top)))])
    return before, inside, np.cumsum(np.exp(logs))


def _uniform(h: np.ndarray) -> np.ndarray:
    return ((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def registers(hashes: np.ndarray, first: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """SetSketch registers, one row per set; all 0 for an empty set."""
    count = np.diff(first)
    low = np.full((len(count), m), np.inf)
    flat = low.reshape(-1)
    need = m * (np.log(m) + _SURE) / np.maximum(count, 1)
    doc = np.repeat(np.arange(len(count)), count)
    number = 0
    active = np.arange(len(hashes))
    while len(active):
        before, inside, table = _block(number)
        if before:
            active = active[need[doc[active]] > before]
        for at in range(0, len(active), max(1, int(_POINTS / inside))):
            part = active[at : at + max(1, int(_POINTS / inside))]
            seed = mix(hashes[part] + np.uint64((number + 1) * 0x9E3779B97F4A7C15 % 2**64))
            points = np.searchsorted(table, _uniform(seed))
            which = np.repeat(np.arange(len(part)), points)
            turn = np.arange(len(which)) - np.repeat(np.cumsum(points) - points, points)
            drawn = mix(seed[which] + (turn.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1342543DE82EF95))
            time = (before + inside * _uniform(drawn)) / (m * RATE)
            slot = (mix(drawn) % np.uint64(m)).astype(np.int64)
            np.minimum.at(flat, doc[part][which] * m + slot, time)
        number += 1
    out = np.empty((len(count), m), np.uint16)
    for at in range(0, len(count), _SETS):
        part = low[at : at + _SETS]
        with np.errstate(divide="ignore"):
            value = np.floor(1 - np.log(part) / np.log(BASE))
        out[at : at + _SETS] = np.clip(np.where(np.isfinite(part), value, 0), 0, 65535)
    return out


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def joint_similarity(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Most likely Jaccard similarity of pairs of rows of registers, given both set sizes."""
    more, less = (a > b).sum(1), (a < b).sum(1)
    same = a.shape[1] - more - less
    u, v = na / (na + nb), nb / (na + nb)

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    lo, hi = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5) - 1) / 2

    def likelihood(j: np.ndarray) -> np.ndarray:
        pa_, pb_ = np.maximum(p(u - v * j), 1e-12), np.maximum(p(v - u * j), 1e-12)
        return more * np.log(pa_) + less * np.log(pb_) + same * np.log(np.maximum(1 - pa_ - pb_, 1e-12))

    for _ in range(40):
        left, right = hi - golden * (hi - lo), lo + golden * (hi - lo)
        up = likelihood(left) < likelihood(right)
        lo, hi = np.where(up, left, lo), np.where(up, hi, right)
    return (lo + hi) / 2


def _band_keys(regs: np.ndarray) -> np.ndarray:
    out = np.empty((len(regs), BANDS), np.uint64)
    for band in range(BANDS):
        h = np.full(len(regs), (band + 1) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for r in range(ROWS):
            h = mix(h + regs[:, band * ROWS + r].astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))
        out[:, band] = h
    return out


def _digests(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits that name a set, whatever the order of its members."""
    out = []
    for salt in (0, 0xA24BAED4963EE407):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes + np.uint64(salt)))])
        out.append((sums[first[1:]] - sums[first[:-1]]).view(np.int64))
    return out[0], out[1]


def _list(values: np.ndarray, offsets: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def _banded(size: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_t", rows=_SETS):
            hashes, first = shingle_sets(batch.column(1), size)
            n = np.diff(first)
            one, two = _digests(hashes, first)
            keys = _band_keys(registers(hashes, first))[n > 0].reshape(-1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(one), pa.array(two), _list(keys, np.concatenate([[0], np.cumsum((n > 0) * BANDS)]))],
                ["id", "n", "d1", "d2", "keys"],
            )

    return run


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The buckets of a part of a task: one row per bucket and component, with all its ids.

    However many copies a part holds, a bucket that they share is one row. All
    keys of a text are in one part; a task goes on with the next part when it
    holds _OPEN_KEYS, however many texts its split has.
    """
    texts = max(1, _OPEN_KEYS // BANDS)
    held: list[pa.RecordBatch] = []
    room, number = texts, 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            held.append(batch.slice(at, room))
            at += held[-1].num_rows
            room -= held[-1].num_rows
            if not room:
                yield from _grouped(held, number)
                held, room, number = [], texts, number + 1
    if held:
        yield from _grouped(held, number)


def _grouped(held: list[pa.RecordBatch], number: int) -> Iterator[pa.RecordBatch]:
    table = pa.Table.from_batches(held).combine_chunks()
    lists = table.column(1).combine_chunks()
    n = np.diff(lists.offsets.to_numpy())
    key = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    own, comp = (np.repeat(table.column(i).to_numpy(), n) for i in (0, 2))
    part = (number << _TASK_BITS) + TaskContext.get().partitionId()
    both = mix(key + mix(comp.view(np.uint64)))
    more = {"bucket": key.view(np.int64), "comp": comp, "part": np.full(len(key), part)}
    yield from group_rows(both, more, own, np.zeros(len(own), np.int64))


def _candidates(keyed: DataFrame, comps: DataFrame | None, turn: int, most: int | None) -> DataFrame:
    """(a, b): each text of a bucket with the bucket's pivot, where they are not in one component yet.

    The buckets of a part of a task come together again before their pairs become rows.
    """
    over = Window.partitionBy("bucket")
    schema = group_schema("bucket long", "comp long", "part long")
    if comps is None:
        # the first round: all ids are open, the pivot is the smallest
        met = keyed.select("id", "keys", F.lit(0).cast("long").alias("comp")).mapInArrow(tidy(_buckets), schema)
        met = met.withColumns({"_n": F.sum(group_size()).over(over), "_p": F.min("id").over(over)}).filter("_n > 1")
    else:
        named = keyed.join(comps.select(F.col("node").alias("id"), "comp"), "id", "left").select("id", "keys", F.coalesce("comp", "id").alias("comp"))
        met = named.mapInArrow(tidy(_buckets), schema)
        # one order of all texts, so that a text is the pivot of every bucket it shares with the same others
        pivot = F.min(F.struct(F.xxhash64("id", F.lit(turn)).alias("h"), "id", "comp")).over(over)
        met = met.withColumns({"_x": pivot, "_other": F.min("comp").over(over) != F.max("comp").over(over)})
        met = met.filter(F.col("_other") & (F.col("comp") != F.col("_x.comp"))).withColumn("_p", F.col("_x.id"))
    ids = F.transform(group_places(), lambda x: x["id"])
    pairs = met.select("part", "_p", ids.alias("_ids")).repartition("part").mapInArrow(tidy(_few_pivots(most, turn)), "a long, b long")
    return pairs.distinct()


def _few_pivots(most: int | None, turn: int) -> Callable:
    """``most`` pivots of each text, or all; the smallest ones in the first round, then others each time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for batch in batches:
            lists = batch.column(2)
            a.append(lists.flatten().to_numpy(zero_copy_only=False))
            b.append(np.repeat(batch.column(1).to_numpy(zero_copy_only=False), np.diff(lists.offsets.to_numpy())))
        one, two = np.concatenate(a), np.concatenate(b)
        rank = mix(two.view(np.uint64) + np.uint64(turn)) if turn else two
        order = np.lexsort((rank, one))
        one, two = one[order], two[order]
        new = one != two
        new[1:] &= (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        one, two = one[new], two[new]
        if most is not None:
            few = np.arange(len(one)) - np.searchsorted(one, one) < most
            # and every pivot once, so that each text of a shared bucket is in some pair
            few[np.unique(two, return_index=True)[1]] = True
            one, two = one[few], two[few]
        yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(two)], ["a", "b"])

    return run


def _details(size: int) -> Callable:
    """Registers and set of each wanted text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # repeated rows meet in one task
        for batch in pieces(batches, "_t", rows=_SETS):
            hashes, first = shingle_sets(batch.column(1), size)
            one, _ = _digests(hashes, first)
            new = np.zeros(batch.num_rows, bool)
            for d, i in enumerate(batch.column(0).to_pylist()):
                new[d] = i not in seen and one[d] == batch.column(2)[d].as_py()
                if new[d]:
                    seen.add(i)
            wanted = np.flatnonzero(new)
            regs = registers(hashes, first)
            packed = hashes.view(np.uint8).reshape(-1, 8)[:, :_SET_BYTES]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(wanted)),
                    pa.array(np.diff(first)[wanted], pa.int64()),
                    pa.array([regs[d].tobytes() for d in wanted], pa.binary()),
                    pa.array([packed[first[d] : first[d + 1]].tobytes() for d in wanted], pa.binary()),
                ],
                ["id", "n", "regs", "members"],
            )

    return run


def _likely(threshold: float) -> Callable:
    """Pairs whose likeliest similarity is not below the threshold by five standard errors."""
    least = threshold - 5 * np.sqrt(threshold * (1 - threshold) / REGISTERS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _SETS):
                batch = whole.slice(at, _SETS)
                a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS) for i in (2, 3))
                na, nb = (batch.column(i).to_numpy(zero_copy_only=False).astype(float) for i in (4, 5))
                keep = (np.minimum(na, nb) >= threshold * np.maximum(na, nb) - 1e-6) & (joint_similarity(a, b, na, nb) >= least)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return run


def _unpack(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // _SET_BYTES, 8), np.uint8)
    out[:, :_SET_BYTES] = np.frombuffer(raw, np.uint8).reshape(-1, _SET_BYTES)
    return np.sort(out.view(np.uint64).reshape(-1))


def _confirmed(percent: int) -> Callable:
    """Pairs with 100 * intersection >= percent * union of the full sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, pivot = None, np.zeros(0, np.uint64)
        for batch in batches:
            keep = []
            # a pair at a time: sets of a whole batch would be a second copy of it
            for row, b in enumerate(batch.column(1).to_pylist()):
                if b != last:
                    last, pivot = b, _unpack(batch.column(3)[row].as_py())
                other = _unpack(batch.column(2)[row].as_py())
                at = np.searchsorted(pivot, other)
                both = int((pivot[np.minimum(at, len(pivot) - 1)] == other).sum())
                keep.append(100 * both >= percent * (len(pivot) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _true_links(pairs: DataFrame, details: DataFrame, percent: int) -> DataFrame:
    """The pairs that hold on the full sets; only likely ones get to see these."""

    def side(name: str, column: str) -> DataFrame:
        return details.select(F.col("id").alias(name), F.col(column).alias(f"_{name}"), F.col("n").alias(f"_n{name}"))

    with_regs = pairs.join(side("a", "regs"), "a").join(side("b", "regs"), "b").select("a", "b", "_a", "_b", "_na", "_nb")
    likely = with_regs.mapInArrow(tidy(_likely(percent / 100)), "a long, b long")
    with_sets = likely.join(side("a", "members"), "a").join(side("b", "members"), "b").select("a", "b", "_a", "_b")
    return with_sets.mapInArrow(tidy(_confirmed(percent)), "a long, b long").distinct()


def _open_buckets(keyed: DataFrame, comps: DataFrame) -> DataFrame:
    """Buckets of several components: a row per bucket, component and part of a task, with its ids.

    ``_m`` counts the members, ``_d`` is a large component of the bucket and
    ``_md`` its members.
    """
    over = Window.partitionBy("bucket")
    named = keyed.join(comps.select(F.col("node").alias("id"), "comp"), "id", "left").select("id", "keys", F.coalesce("comp", "id").alias("comp"))
    met = named.mapInArrow(tidy(_buckets), group_schema("bucket long", "comp long", "part long")).withColumn("_s", group_size())
    met = met.withColumns({"_other": F.min("comp").over(over) != F.max("comp").over(over), "_m": F.sum("_s").over(over), "_d": F.max(F.struct("_s", "comp")).over(over)["comp"]})
    met = met.filter("_other").withColumn("_md", F.sum(F.when(F.col("comp") == F.col("_d"), F.col("_s"))).over(over))
    return met.select("bucket", "comp", "_m", "_d", "_md", F.transform(group_places(), lambda x: x["id"]).alias("ids"))


def _all_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b), a < b: every two members of different components of the small buckets of a task."""
    for batch in batches:
        n = np.diff(batch.column(0).offsets.to_numpy())
        comp, own = (batch.column(i).flatten().to_numpy(zero_copy_only=False) for i in (0, 1))
        bucket = np.repeat(np.arange(len(n)), n)
        a, b = [], []
        for ahead in range(1, int(n.max(initial=1))):
            at = np.flatnonzero((bucket[:-ahead] == bucket[ahead:]) & (comp[:-ahead] != comp[ahead:]))
            a.append(np.minimum(own[at], own[at + ahead]))
            b.append(np.maximum(own[at], own[at + ahead]))
        if a:
            both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])


def common_counts(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Size of the intersection of each set of ``left`` with each of ``right``."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    code, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)[1:]
    row, column = (np.full(len(sets), -1) for _ in range(2))
    row[left], column[right] = np.arange(len(left)), np.arange(len(right))
    out = np.zeros(len(left) * len(right), np.int64)

    order = np.argsort(code, kind="stable")
    order = order[(df[code[order]] > 1) & (df[code[order]] <= _COMMON)]
    c, o = code[order], owner[order]
    for ahead in range(1, _COMMON):
        same = np.flatnonzero(c[:-ahead] == c[ahead:])
        if not len(same):
            break
        for x, y in ((o[same], o[same + ahead]), (o[same + ahead], o[same])):
            ok = (row[x] >= 0) & (column[y] >= 0)
            out += np.bincount(row[x[ok]] * len(right) + column[y[ok]], minlength=len(out))
    out = out.reshape(len(left), len(right))

    often = np.flatnonzero(df > _COMMON)
    number = np.full(len(df), -1)
    number[often] = np.arange(len(often))
    at = np.flatnonzero(number[code] >= 0)
    at = at[np.argsort(number[code[at]], kind="stable")]
    col = number[code[at]]
    for a in range(0, len(often), _COLUMNS):
        part = slice(*np.searchsorted(col, [a, a + _COLUMNS]))
        dense = np.zeros((len(sets), min(_COLUMNS, len(often) - a)), np.float32)
        dense[owner[at[part]], col[part] - a] = 1
        out += np.rint(dense[left] @ dense[right].T).astype(np.int64)
    return out


def _settled(percent: int) -> Callable:
    """Of a piece of work: one true link per text and other component, of any two components one."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp, block = (table.column(c).to_numpy() for c in ("id", "comp", "block"))
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        left, right = np.flatnonzero(block == x), np.flatnonzero(block == y)
        links = np.zeros((0, 2), np.int64)
        if len(left) and len(right):
            sets = [_unpack(m) for m in table.column("members").to_pylist()]
            n = np.array([len(m) for m in sets])
            both = common_counts(sets, left, right)
            hit = (100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)) & (comp[left][:, None] != comp[right][None, :])
            i, j = np.nonzero(hit)
            i, j = left[i], right[j]
            ends = np.sort(np.stack([comp[i], comp[j]], 1), axis=1)
            one = np.unique(ends, axis=0, return_index=True)[1]
            links = np.stack([ids[i[one]], ids[j[one]]], 1)
        return pa.table({"a": pa.array(links[:, 0]), "b": pa.array(links[:, 1])})

    return run


def _large_bucket_links(met: DataFrame, details: DataFrame, percent: int) -> DataFrame:
    """True links between the components of large buckets, all pairs compared.

    One of two members of different components is outside the component ``_d``:
    blocks of these others meet each other and blocks of ``_d``, whose members
    do not meet.
    """
    others, large = (F.ceil(F.col(c) / BLOCK).cast("int") for c in ("_mo", "_md"))
    rows = met.withColumns({"_mo": F.col("_m") - F.col("_md"), "_in": F.col("comp") == F.col("_d")}).withColumns({"_go": others, "_gd": large})
    rows = rows.select("bucket", "comp", "_in", "_go", "_gd", F.explode("ids").alias("id"))
    own = F.pmod(F.xxhash64("id", "bucket"), F.when(F.col("_in"), F.col("_gd")).otherwise(F.col("_go"))).cast("int")
    rows = rows.withColumn("block", own + F.when(F.col("_in"), F.col("_go")).otherwise(0))
    to = F.when(F.col("_in"), F.sequence(F.lit(0), F.col("_go") - 1)).otherwise(F.sequence(F.lit(0), F.col("_go") + F.col("_gd") - 1))
    rows = rows.select("bucket", "comp", "id", "block", F.explode(to).alias("_to"))
    rows = rows.select("bucket", "comp", "id", "block", F.least("block", "_to").alias("x"), F.greatest("block", "_to").alias("y"))
    return rows.join(details.select("id", "members"), "id").groupBy("bucket", "x", "y").applyInArrow(_settled(percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: id, n (shingles), component_id and kept.

    Words are runs without white space, A-Z lowered; a set holds the distinct
    runs of ``shingle`` words. Texts whose sets share ``percent`` hundredths of
    their union are linked; component_id is the smallest id reachable. A text
    without words is linked with nothing. A null id counts as the smallest;
    rows that share an id are one document with several sets. The result is a
    stored frame; what led to it is removed.
    """
    with scratch(docs.sparkSession):
        return store(_classes(docs, shingle, percent, doc_id, text), "classes", keep=True)


def _classes(docs: DataFrame, shingle: int, percent: int, doc_id: str, text: str) -> DataFrame:
    texts = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL_ID)).alias("id"), F.col(f"`{text}`").alias("_t"))
    base = store(texts.mapInArrow(tidy(_banded(shingle)), "id long, n long, d1 long, d2 long, keys array<long>"), "bands")
    # equal sets are one node, named by the smallest id
    sets = base.filter("n > 0").groupBy("d1", "d2").agg(F.min("id").alias("rep"))
    named = base.filter("n > 0").join(sets, ["d1", "d2"])
    nodes = store(named.select("id", "d1", "d2", "rep").distinct(), "nodes")

    keyed = store(named.filter("id = rep").select("id", "keys"), "keys")

    tested = links = comps = details = None
    turn, most = 0, PIVOTS
    while True:
        pairs = _candidates(keyed, comps, turn, most)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = store(pairs, "pairs")
        if turn == 0:
            wanted = pairs.select(F.col("a").alias("_id")).union(pairs.select("b")).distinct()
            wanted = wanted.join(nodes.filter("id = rep").select(F.col("id").alias("_id"), F.col("d1").alias("_d1")), "_id")
            chosen = texts.join(wanted, texts["id"] == wanted["_id"]).select("id", "_t", "_d1")
            details = store(chosen.mapInArrow(tidy(_details(shingle)), "id long, n long, regs binary, members binary"), "details")
        found = store(_true_links(pairs, details, percent), "links")
        new, asked = found.count(), pairs.count()
        tested = pairs if tested is None else tested.union(pairs)
        if new or comps is None:
            links = found if links is None else links.union(found)
            comps = smallest_reachable(links)
        # a round that links few of its pairs costs more than it saves below
        if turn and new * WORTH <= asked:
            break
        most = PIVOTS if new and turn < 2 else None
        turn += 1

    # pivots may miss links between members that are none: what is still open is compared pair by pair
    met = store(_open_buckets(keyed, comps), "open")
    both_ways = tested.select("a", "b").union(tested.select("b", "a"))
    lists = F.flatten(F.collect_list(F.transform("ids", lambda i: F.struct(F.col("comp").alias("c"), i.alias("i")))))
    few = met.filter(F.col("_m") <= SMALL).groupBy("bucket").agg(lists.alias("_l")).select(F.col("_l.c"), F.col("_l.i"))
    pairs = few.mapInArrow(tidy(_all_pairs), "a long, b long").distinct().join(both_ways, ["a", "b"], "left_anti")
    found = store(_true_links(pairs, details, percent).union(_large_bucket_links(met.filter(F.col("_m") > SMALL), details, percent)), "links")
    if found.limit(1).count():
        comps = smallest_reachable(links.union(found))

    reps = nodes.select(F.col("id").alias("_i"), F.col("d1").alias("_1"), F.col("d2").alias("_2"), "rep")
    own = (base["id"] == reps["_i"]) & (base["d1"] == reps["_1"]) & (base["d2"] == reps["_2"])
    out = base.select("id", "n", "d1", "d2").join(reps, own, "left")
    out = out.join(comps.select(F.col("node").alias("rep"), "comp"), "rep", "left")
    out = out.select("id", "n", F.coalesce("comp", "rep", "id").alias("component_id"))
    real = lambda c: F.when(F.col(c) != _NULL_ID, F.col(c))
    return out.select(real("id").alias("id"), F.col("n").alias("n_shingles"), real("component_id").alias("component_id"), (F.col("id") == F.col("component_id")).alias("kept"))


def near_duplicate_digest(docs: DataFrame) -> DataFrame:
    """What the registered query returns: two-word shingles."""
    return near_duplicates(docs, shingle=2).withColumnRenamed("id", "doc_id")


def keep_one_of_each(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows whose component has a smaller id; of rows that share an id, all stay or go."""
    judged = near_duplicates(docs, shingle, percent)
    gone = judged.filter(~F.col("kept")).select(F.col("id").alias("_mw_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_mw_gone"], "left_anti")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, s FROM (SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
link AS (SELECT a, b FROM both_of JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
edge AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, e.b FROM reach r JOIN edge e ON e.a = r.y)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) c USING (doc_id)
"""

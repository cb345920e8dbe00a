"""Packing of documents into fixed sequences by cutting-stock column generation.

A document longer than a sequence fills whole sequences; what is left of it is
one piece below the sequence length. The lengths of these pieces are counted in
classes. A linear program over patterns (how many pieces of each class share a
sequence) is solved by column generation: a knapsack dynamic program over the
dual prices finds the best new pattern. The rounded patterns, and a greedy fill
for what rounding leaves over, say how many sequences of each pattern there
are. Pieces are ranked within their class and the rank decides the sequence.
Only the class counts and the patterns pass the driver, both bounded by the
number of classes.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.tokens import pieces, tidy
from modelweave.plans.workspace import store

SEQUENCE = 2048
STEP = 8  # width of a length class in tokens
END = 1  # id behind each document
_ENCODE_BYTES = 1 << 20
_LONG_PIECE = 4096  # a run without white space beyond this goes to the library that merges it in n log n


def vocabulary_path() -> str:
    """The installed byte-level vocabulary; other files go in as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@cache
def _encoders(path: str):
    """The vocabulary in both libraries: the ids are the same, the second one is four times as fast."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ["RAYON_NUM_THREADS"] = "1"
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer, pre_tokenizers

    whole = Tokenizer.from_file(path)
    whole.encode_special_tokens = True  # their strings in a text are ordinary text
    # byte-level vocabularies write each byte as a printable character; the pre-tokenizer says which
    letters = {}
    shown = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for byte in range(128):
        letters[shown.pre_tokenize_str(chr(byte))[0][0]] = byte
    for code in (*range(0x80, 0x800), *range(0x800, 0x10000, 0x400), *range(0x10000, 0x110000, 0x4000)):
        if not 0xD800 <= code < 0xE000:
            letters.update(zip(shown.pre_tokenize_str(chr(code))[0][0], chr(code).encode()))
    missing = set(range(256)) - set(letters.values())
    spare = [c for c in whole.get_vocab(with_added_tokens=False) if len(c) == 1 and c not in letters]
    letters.update(zip(sorted(spare), sorted(missing)))  # bytes that stand in no UTF-8 text
    ranks = {bytes(letters[c] for c in token): i for token, i in whole.get_vocab(with_added_tokens=False).items() if all(c in letters for c in token)}
    fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return whole, fast


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text without special tokens."""
    whole, fast = _encoders(path)
    if len(text) > _LONG_PIECE and max(map(len, text.split()), default=0) > _LONG_PIECE:
        return np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    return np.array(fast.encode_ordinary(text), "<u4")


def _pieces(path: str, length: int, step: int) -> Callable:
    """Pieces of each document with their checksum; the last one with its class and its number in task and class."""
    classes = length // step

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(classes + 1, np.int64)
        for batch in pieces(batches, "_t", _ENCODE_BYTES):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            rows: list[tuple] = []
            for doc, own in zip(batch.column(0).to_pylist(), texts):
                ids = np.append(token_ids(own, path), np.array([END], "<u4"))
                for start in range(0, len(ids), length):
                    part = ids[start : start + length]
                    kind = 0 if len(part) == length else -(-len(part) // step)
                    rows.append((doc, start, len(part), zlib.crc32(part.tobytes()), len(ids), kind, task, int(seen[kind])))
                    seen[kind] += 1
            if rows:
                columns = list(zip(*rows))
                types = [batch.schema.types[0]] + [pa.int64()] * 4 + [pa.int32(), pa.int32(), pa.int64()]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "kind", "task", "turn"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    return run


def best_pattern(prices: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: item i has size i + 1; largest price sum and the counts that reach it."""
    value = np.zeros(capacity + 1)
    pick = np.full(capacity + 1, -1)
    for room in range(1, capacity + 1):
        sizes = min(room, len(prices))
        gain = prices[:sizes] + value[room - 1 :: -1][:sizes] if room > 1 else prices[:1] + value[:1]
        i = int(np.argmax(gain))
        value[room] = value[room - 1]
        if gain[i] > value[room] + 1e-12:
            value[room], pick[room] = gain[i], i
    counts, room = np.zeros(len(prices), np.int64), capacity
    while room > 0:
        if pick[room] < 0:
            room -= 1
        else:
            counts[pick[room]] += 1
            room -= pick[room] + 1
    return float(value[capacity]), counts


def cutting_stock(demand: np.ndarray, capacity: int, rounds: int = 2000) -> list[tuple[int, np.ndarray]]:
    """Patterns with the number of sequences each, together holding exactly ``demand`` pieces of each class.

    Class i stands for pieces of i + 1 steps, ``capacity`` is the sequence in
    steps. The revised simplex starts from one pattern per class; its answer is
    rounded down, what is left is packed greedily, largest first.
    """
    live = np.flatnonzero(demand)
    if not len(live):
        return []
    size = live + 1
    basis = np.diag(capacity // size).astype(float)  # column p: pieces of each class in pattern p
    inverse = np.diag(1.0 / np.diag(basis))
    amount = demand[live] / np.diag(basis)
    for _ in range(rounds):
        price = np.zeros(len(demand))
        price[live] = np.maximum(inverse.sum(0), 0)
        value, counts = best_pattern(price, capacity)
        if value <= 1 + 1e-9:
            break
        column = counts[live].astype(float)
        change = inverse @ column
        rows = np.flatnonzero(change > 1e-9)
        if not len(rows):
            break
        ratio = amount[rows] / change[rows]
        leave = rows[int(np.argmin(ratio))]
        enter = float(ratio.min())
        amount = np.maximum(amount - enter * change, 0)
        amount[leave] = enter
        basis[:, leave] = column
        inverse[leave] /= change[leave]
        others = np.arange(len(live)) != leave
        inverse[others] -= np.outer(change[others], inverse[leave])
    plan: list[tuple[int, np.ndarray]] = []
    left = demand.astype(np.int64).copy()
    for p in np.argsort(-amount):
        pattern = np.zeros(len(demand), np.int64)
        pattern[live] = basis[:, p].astype(np.int64)
        used = pattern > 0
        times = int(min(np.floor(amount[p] + 1e-9), (left[used] // pattern[used]).min())) if used.any() else 0
        if times > 0:
            plan.append((times, pattern))
            left -= times * pattern
    while left.any():
        pattern, room = np.zeros(len(demand), np.int64), capacity
        for i in np.flatnonzero(left)[::-1]:
            fit = min(int(left[i]), room // (i + 1))
            pattern[i] = fit
            room -= fit * (i + 1)
        used = pattern > 0
        times = int((left[used] // pattern[used]).min())
        plan.append((times, pattern))
        left -= times * pattern
    return plan


def pack(docs: DataFrame, length: int = SEQUENCE, step: int = STEP, path: str | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A null text is empty and gives one piece, the end id alone. Repeated rows
    and ids are packed row by row. No documents give no rows.
    """
    spark = docs.sparkSession
    columns = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("_t"))
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, kind int, task int, turn long"
    made = store(columns.mapInArrow(tidy(_pieces(path or vocabulary_path(), length, step)), schema), "pieces")

    # rank of a piece in its class: pieces of the tasks before, then its number in its own task
    per_task = made.groupBy("kind", "task").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("kind").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = made.join(per_task.select("kind", "task", before.alias("_before")), ["kind", "task"]).withColumn("_rank", F.col("_before") + F.col("turn"))

    counts = {r["kind"]: r["n"] for r in per_task.groupBy("kind").agg(F.sum("_n").alias("n")).collect()}
    demand = np.array([counts.get(i + 1, 0) for i in range(length // step)], np.int64)
    rows, first, given = [(0, 0, 0, counts.get(0, 0), 1)], counts.get(0, 0), np.zeros(len(demand), np.int64)
    for times, pattern in cutting_stock(demand, length // step):
        for i in np.flatnonzero(pattern):
            rows.append((int(i) + 1, int(given[i]), first, times, int(pattern[i])))
            given[i] += times * pattern[i]
        first += times
    # broadcast is bounded: a row per pattern and class in it
    table = F.broadcast(spark.createDataFrame(rows, "_kind int, _from long, _first long, _times long, _each long"))
    inside = (F.col("kind") == F.col("_kind")) & (F.col("_rank") >= F.col("_from")) & (F.col("_rank") < F.col("_from") + F.col("_times") * F.col("_each"))
    placed = ranked.join(table, inside)
    where = (F.col("_rank") - F.col("_from")) % F.col("_times")
    placed = placed.withColumn("sequence_id", (F.col("_first") + where).cast("long"))
    ahead = Window.partitionBy("sequence_id").orderBy(F.col("length").desc(), "kind", "_rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.coalesce(F.sum("length").over(ahead), F.lit(0)).cast("long").alias("offset")
    )

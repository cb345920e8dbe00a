"""Words of whole Arrow batches as arrays: spans and 64-bit hashes, without a loop over words.

A word's hash is a polynomial over its bytes modulo 2^64, read off a running sum
over the batch and then mixed; a run of words is hashed the same way over the
hashes of its words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PIECE_BYTES = 1 << 20

_ODD = 0x9E3779B97F4A7C15
_BYTE = 0xD1B54A32D192ED03


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BYTE))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, made longer when needed."""

    def __init__(self, base: int) -> None:
        self.base, self.back = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", self.base), ("down", self.back)):
                full = np.full(n, base, np.uint64)
                full[0] = 1
                setattr(self, name, np.multiply.accumulate(full))
        return self.up, self.down


_OVER_BYTES, _OVER_WORDS = _Powers(_ODD), _Powers(0xC2B2AE3D27D4EB4F)


def _sums(values: np.ndarray, powers: _Powers) -> np.ndarray:
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers.get(len(values) + 1)[0][: len(values)], out=out[1:])
    return out


@dataclass
class Words:
    """Word i is bytes start[i]:end[i] of ``data``; document d has words first[d]:first[d + 1]."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    hash: np.ndarray

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def sums(self) -> np.ndarray:
        return _sums(self.hash, _OVER_WORDS)


def run_hashes(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words start[i]:end[i], from ``Words.sums()``; never 0 and never the largest value."""
    h = mix((sums[end] - sums[start]) * _OVER_WORDS.get(len(sums))[1][start] + (end - start).astype(np.uint64))
    return np.clip(h, np.uint64(1), np.uint64(2**64 - 2))


def find_words(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of bytes other than space and 0x09 to 0x0D; null has none."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None and offsets[-1] > offsets[0] else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0]
    if lower:
        data = LOWER[data]
    n = len(data)
    word = ~SPACE[data]
    opens, closes = word.copy(), word.copy()
    if n:
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        inner = offsets[1:-1]
        inner = inner[(inner > 0) & (inner < n)]
        opens[inner] = word[inner]
        closes[inner - 1] = word[inner - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    sums = _sums(_CODES[data], _OVER_BYTES)
    back = _OVER_BYTES.get(n + 1)[1]
    hashes = mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))
    return Words(data, start, end, np.searchsorted(start, offsets), hashes)


def pieces(batches: Iterator[pa.RecordBatch], column: str, limit: int = PIECE_BYTES, rows: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most ``limit`` bytes of text each, or with one row; of ``rows`` rows at most."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(batch.schema.names.index(column))), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = sizes[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(sizes, before + limit, "right")))
            to = to if rows is None else min(to, at + rows)
            yield batch.slice(at, to - at)
            at = to


def tidy(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; the memory of its task goes back to the system at the end.

    A Python worker waits for the next task with all that its allocators keep,
    beside an executor whose other stages need the room.
    """

    @wraps(run)
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:  # only the GNU library has it
            trim(0)

    return tidied


def group_rows(
    key: np.ndarray, columns: dict[str, np.ndarray], ids: np.ndarray, places: np.ndarray, same: str | None = None
) -> Iterator[pa.RecordBatch]:
    """One row per key of a task: the first (id, place), and the other places if there are any."""
    order = np.lexsort((places, ids, key))
    key, ids, places = key[order], ids[order], places[order]
    head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    count = np.diff(np.append(head, len(key)))
    out = {}
    for name, values in columns.items():
        values = values[order]
        if name == same and len(key):
            # the common value of the group, 0 if it differs
            lo, hi = np.minimum.reduceat(values, head), np.maximum.reduceat(values, head)
            out[name] = np.where(lo == hi, lo, 0)
        else:
            out[name] = values[head]
    for a in range(0, len(head), 20_000):
        part = slice(a, a + 20_000)
        begin, size = head[part], count[part]
        rest = size - 1
        offsets = np.concatenate([[0], np.cumsum(rest)])
        take = np.repeat(begin + 1 - offsets[:-1], rest) + np.arange(offsets[-1])
        # id and place by turns: plain numbers are half as long in a shuffle as structs
        turns = np.stack([ids[take], places[take]], 1).reshape(-1)
        more = pa.ListArray.from_arrays(pa.array(2 * offsets, pa.int32()), pa.array(turns, pa.int64()), mask=pa.array(rest == 0))
        # numbers with leading zeros stand side by side, which halves what a shuffle of these rows takes
        yield pa.RecordBatch.from_arrays(
            [pa.array(key[begin].view(np.int64)), *[pa.array(v[part]) for v in out.values()]]
            + [pa.array(places[begin], pa.int64()), pa.array(ids[begin], pa.int64()), more],
            ["key", *out, "at", "id", "more"],
        )


def group_schema(*more: str) -> str:
    """Schema of ``group_rows`` with its further columns."""
    return ", ".join(["key long", *more, "at long, id long, more array<long>"])


def group_size() -> Column:
    """How many rows a row of ``group_rows`` stands for."""
    return F.when(F.col("more").isNull(), F.lit(1)).otherwise(F.size("more") / 2 + 1).cast("long")


def group_places() -> Column:
    """All (id, at) of a row of ``group_rows``."""
    pairs = F.transform(F.sequence(F.lit(0), F.size("more") - 2, F.lit(2)), lambda i: F.struct(F.get("more", i).alias("id"), F.get("more", i + 1).alias("at")))
    one = F.array(F.struct("id", "at"))
    return F.when(F.col("more").isNull(), one).otherwise(F.concat(one, pairs))

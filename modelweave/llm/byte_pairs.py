"""Byte-level byte-pair encoding and decoding of whole texts.

Texts are cut before the merges without a regular expression. Every code point
gets a class (letter, number, white space ...), which a look at the next two
code points makes finer, and each class is a function from the state before it
to the state behind it. Composition of these functions is associative, so the
states of a whole batch come from a scan: the functions of blocks are composed
side by side, then the prefixes of blocks by doubling, then all blocks run at
once from their own first state. A boundary is a pair of class and state. The
slices between boundaries go through pair merging with a cache; the ids keep the
byte offset at which their token begins, and decoding puts the tokens back
there.

Null texts are empty, empty texts have no ids. Repeated rows are encoded row by
row; bytes that are no UTF-8 become U+FFFD, as in the library that this follows.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.tokens import pieces

_PIECE_BYTES = 1 << 20
_CACHED_IDS = 1 << 21  # a task's cache starts anew beyond so many ids
_AT_ONCE = 200_000  # ids put back in one step

# classes of code points: the last two stand for white space before something else
LETTER, NUMBER, OTHER, SHORT, LONG, SPACE, BLANK, LAST = range(8)
# states: an open run of letters, numbers, others or white space; a blank that
# opens the next run; nothing open; one or two letters of a contraction to come
_RUN_L, _RUN_N, _RUN_O, _RUN_S, _OPEN, _NONE, _ONE, _TWO = range(8)
_FIRST, _STAY = 8, 16  # added to the class of a text's first code point; the class that changes nothing


def _machine() -> tuple[np.ndarray, np.ndarray]:
    """State behind and boundary before a code point, by class and state before."""
    after, cut = np.zeros((17, 8), np.uint8), np.ones((17, 8), bool)
    starts = {LETTER: _RUN_L, NUMBER: _RUN_N, OTHER: _RUN_O, SHORT: _ONE, LONG: _TWO, SPACE: _RUN_S, BLANK: _OPEN, LAST: _NONE}
    for kind, state in starts.items():
        after[kind] = after[kind + _FIRST] = state
    for kind, run in ((LETTER, _RUN_L), (NUMBER, _RUN_N), (OTHER, _RUN_O)):
        cut[kind, [run, _OPEN]] = False
    for kind in (SHORT, LONG):
        # inside a run of others, or behind its blank, an apostrophe is one of them
        after[kind, [_RUN_O, _OPEN]] = _RUN_O
        cut[kind, [_RUN_O, _OPEN]] = False
    after[LETTER, _TWO], after[LETTER, _ONE] = _ONE, _NONE
    cut[LETTER, [_TWO, _ONE]] = False
    cut[SPACE, _RUN_S] = False
    after[_STAY], cut[_STAY] = np.arange(8), False
    return after, cut


_AFTER, _CUT = _machine()


@cache
def _kinds() -> np.ndarray:
    """LETTER, NUMBER, SPACE or OTHER of every code point.

    Asked from the library whose ids are wanted, so that both follow one Unicode
    version: with a pattern of one class it gives back just the code points of
    that class.
    """
    import tiktoken

    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    single = {bytes([b]): b for b in range(256)}
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        found = bytes(tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every))
        out[np.frombuffer(found.decode().encode("utf-32-le"), np.uint32)] = kind
    return out


def classes(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Class of each code point; text d has the points first[d]:first[d + 1]."""
    kind = _kinds()[points]
    n = len(points)
    starts = first[:-1][np.diff(first) > 0]
    begin = np.zeros(n + 2, bool)
    begin[starts] = begin[n:] = True
    ahead = np.concatenate([points, np.zeros(2, points.dtype)])
    space = np.concatenate([kind == SPACE, [True]])
    ends = (kind == SPACE) & ~space[1 : n + 1] & ~begin[1 : n + 1]
    kind[ends] = np.where(points[ends] == 0x20, BLANK, LAST)
    at = np.flatnonzero((points == 0x27) & ~begin[1 : n + 1])
    a, b = ahead[at + 1], np.where(begin[at + 2], 0, ahead[at + 2])
    two = np.isin(a, np.frombuffer(b"stmd", np.uint8))
    three = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    kind[at[two]], kind[at[three]] = SHORT, LONG
    kind[starts] += _FIRST
    return kind


def boundaries(kind: np.ndarray, width: int = 512) -> np.ndarray:
    """Numbers of the code points that begin a slice, by a scan over transition functions."""
    n = len(kind)
    blocks = max(1, -(-n // width))
    grid = np.full(blocks * width, _STAY, np.uint8)
    grid[:n] = kind
    columns = np.ascontiguousarray(grid.reshape(blocks, width).T)
    whole = np.broadcast_to(np.arange(8, dtype=np.uint8), (blocks, 8))
    for column in columns:
        whole = _AFTER[column[:, None], whole]
    before = 1
    while before < blocks:
        whole = np.concatenate([whole[:before], np.take_along_axis(whole[before:], whole[:-before].astype(np.intp), 1)])
        before *= 2
    state = np.concatenate([[_NONE], whole[:-1, _NONE]])
    cut = np.empty((width, blocks), bool)
    for j, column in enumerate(columns):
        cut[j] = _CUT[column, state]
        state = _AFTER[column, state]
    return np.flatnonzero(cut.T.reshape(-1)[:n])


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a slice: the pair of lowest rank, the leftmost of equal ones, becomes one part until no pair has a rank."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n = len(piece)
    after, before = [*range(1, n + 1), -1], [*range(-1, n)]  # after[i]: end of the part that begins at i
    heap = [(ranks[pair], i, i + 1, i + 2) for i in range(n - 1) if (pair := piece[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, middle, end = heapq.heappop(heap)
        if after[i] != middle or after[middle] != end:
            continue  # one of the two is gone
        after[i], after[middle], before[end] = end, -1, i
        if end < n and (rank := ranks.get(piece[i : after[end]])) is not None:
            heapq.heappush(heap, (rank, i, end, after[end]))
        left = before[i]
        if left >= 0 and (rank := ranks.get(piece[left:end])) is not None:
            heapq.heappush(heap, (rank, left, i, end))
    out, at = [], 0
    while at < n:
        out.append(ranks[piece[at : after[at]]])
        at = after[at]
    return out


class Vocabulary:
    """Ranks of a file, the bytes of every id, and the merged slices met so far."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.ends = array("i"), array("q", [0])

    def _learn(self, piece: bytes) -> int:
        self.ids.extend(merge(piece, self.ranks))
        self.ends.append(len(self.ids))
        number = self.known[piece] = len(self.ends) - 2
        return number

    def encode(self, data: bytes, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices of ``data`` that begin at ``cuts``, and how many each slice has."""
        if len(self.ids) > _CACHED_IDS:
            self._forget()
        known, learn, numbers = self.known, self._learn, array("q")
        edges = [*cuts.tolist(), len(data)]
        for a, b in zip(edges, edges[1:]):
            piece = data[a:b]
            number = known.get(piece)
            numbers.append(learn(piece) if number is None else number)
        numbers = np.frombuffer(numbers, np.int64) if numbers else np.zeros(0, np.int64)
        ends = np.array(self.ends)
        begin, count = ends[numbers], ends[numbers + 1] - ends[numbers]
        take = np.repeat(begin - (np.cumsum(count) - count), count) + np.arange(count.sum())
        return np.array(self.ids, np.int32)[take], count

    def place(self, ids: np.ndarray, at: np.ndarray, out: np.ndarray) -> None:
        """Writes the bytes of each id at its offset."""
        for a in range(0, len(ids), _AT_ONCE):
            some, where = ids[a : a + _AT_ONCE], at[a : a + _AT_ONCE]
            size = self.sizes[some]
            inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            out[np.repeat(where, size) + inside] = self.bytes[np.repeat(self.begins[some], size) + inside]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def rank_file() -> str:
    """The installed byte-level ranks; other files go in as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def encode_batch(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, ids, starts): text d has the ids first[d]:first[d + 1], which begin at its bytes ``starts``."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    edges = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = raw.to_pybytes()[edges[0] : edges[-1]] if raw is not None else b""
    edges = edges - edges[0]
    if not data:
        return np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
    points = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32)
    where = np.flatnonzero((np.frombuffer(data, np.uint8) & 0xC0) != 0x80)
    cuts = where[boundaries(classes(points, np.searchsorted(where, edges)))]
    words = vocabulary(path)
    ids, count = words.encode(data, cuts)
    first = np.concatenate([[0], np.cumsum(count)])[np.searchsorted(cuts, edges)]
    size = words.sizes[ids]
    starts = np.cumsum(size) - size - np.repeat(edges[:-1], np.diff(first))
    return first, ids, starts.astype(np.int32)


def _encoded(path: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_text", _PIECE_BYTES):
            first, ids, starts = encode_batch(batch.column(batch.num_columns - 1), path)
            ends = pa.array(first, pa.int32())
            lists = [pa.ListArray.from_arrays(ends, pa.array(x, pa.int32())) for x in (ids, starts)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *lists], [*batch.schema.names[:-1], "ids", "starts"])

    return run


def _decoded(path: str, limit: int = 4 * _AT_ONCE) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for whole in batches:
            counts = np.cumsum(pc.fill_null(pc.list_value_length(whole.column(whole.num_columns - 2)), 0).to_numpy(zero_copy_only=False))
            a = 0
            while a < whole.num_rows:
                b = max(a + 1, int(np.searchsorted(counts, (counts[a - 1] if a else 0) + limit, "right")))
                batch, a = whole.slice(a, b - a), b
                lists, at = batch.columns[-2:]
                ids = lists.flatten().to_numpy(zero_copy_only=False)
                owner = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
                size = np.bincount(owner, words.sizes[ids], len(lists)).astype(np.int64)
                ends = np.concatenate([[0], np.cumsum(size)])
                out = np.zeros(ends[-1], np.uint8)
                words.place(ids, at.flatten().to_numpy(zero_copy_only=False) + ends[owner], out)
                column = pa.Array.from_buffers(pa.large_binary(), len(lists), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(out.tobytes())]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *batch.columns[-2:], column], [*batch.schema.names, "decoded"])

    return run


def _own_names(df: DataFrame, names: tuple[str, ...]) -> None:
    clash = {c.lower() for c in df.columns} & set(names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} would come twice; rename them first")


def encode(docs: DataFrame, path: str = "", text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` with ``ids`` and ``starts``, the byte of the text at which each token begins.

    One pass without a shuffle. A batch is cut by bytes of text; only a text that
    is longer by itself is held whole.
    """
    _own_names(docs.select(*[F.col(f"`{c}`") for c in keep]), ("ids", "starts", "_text"))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.make_valid_utf8(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_encoded(path or rank_file()), f"{schema}, ids array<int>, starts array<int>")


def decode(encoded: DataFrame, path: str = "") -> DataFrame:
    """The frame of ``encode`` with ``decoded``, the bytes of its ids put back at their offsets."""
    _own_names(encoded, ("decoded",))
    last = encoded.select(*[F.col(f"`{c}`") for c in encoded.columns if c not in ("ids", "starts")], "ids", "starts")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in last.schema.fields)
    return last.mapInArrow(_decoded(path or rank_file()), f"{schema}, decoded binary")


def ids_text(ids: Column) -> Column:
    """Decimal ids with one space between."""
    return F.array_join(ids.cast("array<string>"), " ")


def encoding_digest(docs: DataFrame, path: str = "") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text."""
    return decode(encode(docs, path), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids_text(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

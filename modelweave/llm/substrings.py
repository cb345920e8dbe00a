"""Substring dedup: repeated spans of words through a compacted de Bruijn graph.

Nodes are anchors: k-mers of words that are the smallest in some window (the
sparse form of the graph), edges the words from one anchor to the next. An
anchor whose every occurrence is followed by the same edge, and which occurs as
often as the next one, does not branch; chains of such anchors are one path.
Two equal windows hold the same anchor at the same place, so

1. every anchor occurrence meets the others of its k-mer (one shuffle; within a
   task the occurrences of a k-mer are one row, so a key has at most a row per
   task),
2. windows inside a path are repeated exactly where the path is: only its first
   source keeps them,
3. windows that cross the end of a path are compared one by one, by hash of all
   their words, in a second shuffle of the same form.

The texts are shuffled once: both joins use the same exchange.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from modelweave.llm.tokens import Words, find_words, group_places, group_rows, group_schema, group_size, mix, pieces, run_hashes, tidy

MER = 4
_PIECE_BYTES = 1 << 18  # arrays over the bytes of a piece are many times as large
# a place: a tag of the text, above it the position of the first word, above it the words of a path (0: a window)
_TAG, _POSITION, _WORDS = 22, 28, 13
_MASK = (1 << _TAG) - 1
_LONGEST = (1 << _WORDS) - 1
_NULL_ID = -(1 << 63)
_LARGEST = np.uint64(2**64 - 1)


def _anchors(words: Words, window: int, mer: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """k-mer hashes, smallest hash of the window at each word, where windows start, and positions of anchors."""
    n = len(words.start)
    ends = np.repeat(words.first[1:], np.diff(words.first))
    at = np.arange(n)
    x = np.full(n, _LARGEST)
    ok = at + mer <= ends
    x[ok] = run_hashes(words.sums(), at[ok], at[ok] + mer)
    width = window - mer + 1
    low = _sliding(x, width, np.minimum, _LARGEST)
    starts = at + window <= ends
    held = np.where(starts, low, 0)
    # the largest of the windows that hold a k-mer; it is that k-mer if one of them has it as smallest
    reach = _sliding(held[::-1], width, np.maximum, 0)[::-1]
    return x, low, starts, np.flatnonzero((reach == x) & ok)


def _sliding(x: np.ndarray, width: int, of: Callable, fill: int) -> np.ndarray:
    """of(x[i:i + width]) for each i, by doubling."""
    pad = np.concatenate([x, np.full(width, fill, x.dtype)])
    span = 1
    while 2 * span <= width:
        pad[:-span] = of(pad[:-span], pad[span:])
        span *= 2
    if span < width:
        shift = width - span
        pad[:-shift] = of(pad[:-shift].copy(), pad[shift:])
    return pad[: len(x)]


def _find(batch: pa.RecordBatch) -> tuple[Words, np.ndarray]:
    """The words of a batch, and the tag of each text, which keeps rows that share an id apart."""
    words = find_words(batch.column(1))
    if len(words.first) > 1 and np.diff(words.first).max() >= 1 << _POSITION:
        raise ValueError(f"a text has more than {(1 << _POSITION) - 1} words")
    return words, batch.column(2).to_numpy(zero_copy_only=False)


def _occurrences(window: int, mer: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nexts, ids, places = [], [], [], []
        for batch in pieces(batches, "_mw_text", _PIECE_BYTES):
            words, tags = _find(batch)
            x, _, _, at = _anchors(words, window, mer)
            doc = np.searchsorted(words.first, at, "right") - 1
            follows = np.zeros(len(at), np.uint64)
            linked = np.flatnonzero(doc[1:] == doc[:-1])
            follows[linked] = run_hashes(words.sums(), at[linked], at[linked + 1] + mer)
            keys.append(x[at])
            nexts.append(follows.view(np.int64))
            ids.append(batch.column(0).to_numpy(zero_copy_only=False)[doc])
            places.append(((at - words.first[doc]) << _TAG) + tags[doc])
        if keys:
            yield from group_rows(np.concatenate(keys), {"follows": np.concatenate(nexts)}, np.concatenate(ids), np.concatenate(places), "follows")

    return run


def _crossing(window: int, mer: int) -> Callable:
    """Repeated paths that are not the first of their kind, and the windows that still have to be compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ids, places = [], [], []

        def put(k: np.ndarray, i: np.ndarray, p: np.ndarray) -> None:
            keys.append(k)
            ids.append(i)
            places.append(p)

        for batch in pieces(batches, "_mw_text", _PIECE_BYTES):
            words, tags = _find(batch)
            x, low, starts, at = _anchors(words, window, mer)
            if not len(at):
                continue
            own = batch.column(0).to_numpy(zero_copy_only=False)
            doc = np.searchsorted(words.first, at, "right") - 1
            # what the first shuffle found, laid beside the anchors
            owner, told = _list(batch.column(3))
            _, code = _list(batch.column(4))
            spot = np.searchsorted(at, words.first[owner] + (told >> _TAG))
            times, goes_on, is_first = np.zeros(len(at), np.int64), np.zeros(len(at), bool), np.zeros(len(at), bool)
            times[spot], goes_on[spot], is_first[spot] = code >> 2, code & 2, code & 1

            link = (times[:-1] > 1) & goes_on[:-1] & (times[:-1] == times[1:]) & (doc[:-1] == doc[1:])
            head = np.concatenate([[True], ~link])
            path = np.cumsum(head) - 1
            heads = np.flatnonzero(head)
            lasts = np.append(heads[1:], len(at)) - 1
            begin, end = at[heads], at[lasts] + mer
            inner = np.flatnonzero((end - begin >= window) & (times[heads] > 1) & ~is_first[heads])
            # a very long path goes in parts
            parts = -(-(end[inner] - begin[inner]) // _LONGEST)
            inner = np.repeat(inner, parts)
            p = begin[inner] + _LONGEST * (np.arange(len(inner)) - np.repeat(np.cumsum(parts) - parts, parts))
            length, d = np.minimum(end[inner] - p, _LONGEST), doc[heads[inner]]
            # the keys of these rows are their own: nothing else may have them
            own_key = mix(own[d].view(np.uint64) + mix(((p << np.int64(20)) + tags[d]).view(np.uint64)))
            put(own_key, own[d], (length << (_TAG + _POSITION)) + ((p - words.first[d]) << _TAG) + tags[d])

            s = np.flatnonzero(starts)
            best, where = x[s].copy(), s.copy()
            for j in range(1, window - mer + 1):
                less = x[s + j] < best
                best[less], where[less] = x[s + j][less], s[less] + j
            anchor = np.searchsorted(at, where)
            keep = times[anchor] > 1
            own_path = path[anchor]
            keep &= ~((s >= begin[own_path]) & (s + window <= end[own_path]))
            s, d = s[keep], doc[anchor[keep]]
            put(run_hashes(words.sums(), s, s + window), own[d], ((s - words.first[d]) << _TAG) + tags[d])
        if keys:
            yield from group_rows(np.concatenate(keys), {}, np.concatenate(ids), np.concatenate(places))

    return run


def _meet(rows: DataFrame, *more: tuple[str, object]) -> DataFrame:
    """Rows of a key with the count and the first place over all tasks; a key has a row per task at most."""
    over = Window.partitionBy("key")
    first = F.min(F.struct("id", "at")).over(over)
    met = rows.withColumns({"_n": F.sum(group_size()).over(over), "_first": first, **dict(more)})
    return met.withColumn("_p", group_places())


def _keyed(docs: DataFrame, doc_id: str, text: str, *more: str) -> DataFrame:
    """Rows as (id, text, tag of the text), and further columns by number."""
    key = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.lit(_NULL_ID)).alias("_mw_id")
    tag = F.pmod(F.xxhash64(F.col(f"`{text}`")), F.lit(1 << _TAG)).alias("_mw_tag")
    return docs.select(key, F.col(f"`{text}`").alias("_mw_text"), tag, *[F.col(f"`{c}`").alias(f"_mw_{i}") for i, c in enumerate(more)])


def repeated_stretches(texts: DataFrame, window: int = 20, mer: int = MER) -> DataFrame:
    """(_mw_key, _mw_mark, _mw_spans): per id and tag of ``_keyed`` rows the stretches to remove.

    A stretch is the position of its first word with the tag, and its number of
    words. Lazy; two shuffles of anchors and windows, one of the texts, with all
    columns of ``texts`` so that a later join can use the same one.
    """
    over = Window.partitionBy("key")
    seen = texts.mapInArrow(tidy(_occurrences(window, mer)), group_schema("follows long"))
    lo, hi = F.min("follows").over(over), F.max("follows").over(over)
    met = _meet(seen, ("_go", (lo == hi) & (lo != 0))).filter("_n > 1")
    flat = met.select("_n", "_go", "_first", F.explode("_p").alias("_p"))
    code = F.col("_n") * 4 + F.when(F.col("_go"), 2).otherwise(0) + F.when(F.col("_p") == F.col("_first"), 1).otherwise(0)
    flat = flat.select(F.col("_p.id").alias("_k"), F.col("_p.at").alias("_at"), code.cast("long").alias("_code"))
    # two lists of one aggregate keep one order
    own_tag = F.col("_at").bitwiseAND(F.lit(_MASK)).alias("_t")
    per_doc = flat.groupBy("_k", own_tag).agg(F.collect_list("_at").alias("_at"), F.collect_list("_code").alias("_code"))
    none = F.array().cast("array<long>")
    beside = texts.join(per_doc, (texts["_mw_id"] == per_doc["_k"]) & (texts["_mw_tag"] == per_doc["_t"]), "left")
    others = [F.col(f"`{c}`") for c in texts.columns[3:]]
    beside = beside.select("_mw_id", "_mw_text", "_mw_tag", F.coalesce("_at", none).alias("_at"), F.coalesce("_code", none).alias("_code"), *others)
    windows = beside.mapInArrow(tidy(_crossing(window, mer)), group_schema())
    judged = _meet(windows).select("_first", F.explode("_p").alias("_p"))
    path = F.shiftright(F.col("_p.at"), _TAG + _POSITION) > 0
    gone = judged.filter(path | (F.col("_p") != F.col("_first"))).select(F.col("_p.id").alias("_mw_key"), F.col("_p.at").alias("_at"))
    return gone.groupBy("_mw_key", F.col("_at").bitwiseAND(F.lit(_MASK)).alias("_mw_mark")).agg(F.collect_list("_at").alias("_mw_spans"))


def _with_stretches(texts: DataFrame, window: int) -> DataFrame:
    """The keyed rows with their stretches as fourth column."""
    gone = repeated_stretches(texts, window)
    none = F.array().cast("array<long>")
    others = [F.col(f"`{c}`") for c in texts.columns[3:]]
    met = texts.join(gone, (texts["_mw_id"] == gone["_mw_key"]) & (texts["_mw_tag"] == gone["_mw_mark"]), "left")
    return met.select("_mw_id", "_mw_text", "_mw_tag", F.coalesce("_mw_spans", none).alias("_mw_spans"), *others)


def _list(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every entry of a list column."""
    return np.repeat(np.arange(len(column)), np.diff(column.offsets.to_numpy())), column.flatten().to_numpy(zero_copy_only=False).copy()


def _gone(words: Words, spans: pa.ListArray, window: int) -> np.ndarray:
    """True for each word of a batch that a stretch of its text covers."""
    owner, at = _list(spans)
    length = at >> (_TAG + _POSITION)
    length[length == 0] = window
    begin = words.first[owner] + ((at >> _TAG) & ((1 << _POSITION) - 1))
    steps = np.zeros(len(words.start) + 1, np.int64)
    np.add.at(steps, begin, 1)
    np.add.at(steps, begin + length, -1)
    return np.cumsum(steps[:-1]) > 0


def _digest(window: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_mw_text", _PIECE_BYTES):
            words = find_words(batch.column(1))
            gone = _gone(words, batch.column(3), window)
            sums = np.concatenate([[0], np.cumsum(gone)])
            removed = sums[words.first[1:]] - sums[words.first[:-1]]
            hashes = []
            for d, text in enumerate(batch.column(1).to_pylist()):
                own = (text or "").encode().split()
                if removed[d]:
                    drop = gone[words.first[d] : words.first[d + 1]]
                    own = [w for w, g in zip(own, drop.tolist()) if not g]
                hashes.append(hashlib.sha256(b" ".join(own)).hexdigest())
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(words.first), pa.int64()), pa.array(removed, pa.int64()), pa.array(hashes)], ["doc_id", "n_words", "n_removed", "kept_sha256"]
            )

    return run


def substring_digest(docs: DataFrame, window: int = 20) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed and the SHA-256 of the words kept, joined by a space.

    Null and empty texts have no words. Rows that share an id and differ in text
    are documents of their own, told apart by a hash of 22 bits; equal rows count
    as one document. Ids must be whole numbers or null, which comes before all
    others.
    """
    found = _with_stretches(_keyed(docs, "doc_id", "text"), window).mapInArrow(tidy(_digest(window)), "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return found.withColumn("doc_id", F.when(F.col("doc_id") != _NULL_ID, F.col("doc_id")))


def _kept_text(raw: bytes, begin: np.ndarray, drop: np.ndarray) -> str:
    """The bytes of the kept words, each with the space behind it."""
    end = np.append(begin[1:], len(raw))
    kept = [raw[: begin[0]]] + [raw[s:e] for s, e, g in zip(begin.tolist(), end.tolist(), drop.tolist()) if not g]
    return b"".join(kept).strip().decode()


def _cut(names: list[str], text: str, length: str | None, window: int) -> Callable:
    others = [n for n in names if n != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_mw_text", _PIECE_BYTES):
            words = find_words(batch.column(1))
            gone = _gone(words, batch.column(3), window)
            texts = batch.column(1).to_pylist()
            sums = np.concatenate([[0], np.cumsum(gone)])
            touched = np.flatnonzero(sums[words.first[1:]] > sums[words.first[:-1]])
            for d in touched.tolist():
                raw, a, b = texts[d].encode(), words.first[d], words.first[d + 1]
                lead = len(raw) - len(raw.lstrip())
                texts[d] = _kept_text(raw, words.start[a:b] - words.start[a] + lead, gone[a:b])
            columns = {n: None if n == text else batch.column(4 + others.index(n)) for n in names}
            columns[text] = pa.array(texts, pa.string())
            if length in columns:
                sizes = columns[length].to_pylist()
                for d in touched.tolist():
                    sizes[d] = len(texts[d])
                columns[length] = pa.array(sizes, columns[length].type)
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    return run


def remove_repeats(docs: DataFrame, window: int = 20, doc_id: str = "doc_id", text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` without the words of repeated windows but for their first source, all columns and rows kept.

    A touched text loses those words and the space behind them; ``length``, if
    it is a column, is counted anew there. Other texts stay as they are, byte
    for byte. A text of which nothing is left is empty.
    """
    keyed = _keyed(docs, doc_id, text, *[c for c in docs.columns if c != text])
    beside = _with_stretches(keyed, window)
    return beside.mapInArrow(tidy(_cut(docs.columns, text, length, window)), docs.schema)


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
cov AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM rep),
word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
sums AS (SELECT word.doc_id, count(cov.p) AS n_removed, string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE cov.p IS NULL) AS kept
         FROM word LEFT JOIN cov ON cov.doc_id = word.doc_id AND cov.p = word.p GROUP BY word.doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN sums USING (doc_id)
"""

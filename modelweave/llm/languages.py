"""Language ID by prediction by partial matching.

Every language has a tree of byte contexts up to three bytes long, with the
counts of what follows. The tree is frozen after learning: the cost of a byte in
a context is its code length with escapes (method C) down to a uniform order
over all 256 bytes. Spark joins the costs order by order into one sparse table:
a row per byte seen in a context, and a row per context for its escape. A text's
code length under a language is the sum over all its bytes; the shortest code
wins.

The table grows with the corpus. Tasks get it in parts of bounded size, cut by
the last two bytes of the context, so that all rows a byte may need stand in one
part (contexts of up to one byte stand in all). With one part a text is read
once; with more it is read once for each, and the sums are added.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.llm.tokens import pieces
from modelweave.plans.workspace import scratch, store

ORDER = 3
PART_ROWS = 2_000_000  # rows of the longer contexts in a part, 12 bytes each in a task
UNKNOWN = "und"
_TEXT_BYTES = 1 << 20


def held_out(doc_id: str = "doc_id"):
    """Column: the row is kept from learning."""
    return F.coalesce(F.crc32(F.col(f"`{doc_id}`").cast("string")) % 3 == 1, F.lit(False))


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of each byte with the three before it, per language, over a task; a text begins behind three zero bytes."""
    totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}

    def add(lang: str, codes: np.ndarray, counts: np.ndarray) -> None:
        if lang in totals:
            codes, counts = np.concatenate([totals[lang][0], codes]), np.concatenate([totals[lang][1], counts])
            codes, where = np.unique(codes, return_inverse=True)
            counts = np.bincount(where, counts).astype(np.int64)
        totals[lang] = codes, counts

    for batch in pieces(batches, "text", 1 << 23):
        langs = np.array(batch.column(1).to_pylist(), object)
        for lang in set(langs):
            data, first = _bytes(batch.column(0).filter(pa.array(langs == lang)))
            if len(data):
                codes, counts = np.unique(_codes(data, first), return_counts=True)
                add(lang, codes, counts)
    for lang, (codes, counts) in totals.items():
        for a in range(0, len(codes), 50_000):
            part = slice(a, a + 50_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(codes[part])), pa.array(codes[part].astype(np.int64)), pa.array(counts[part])], ["lang", "code", "n"]
            )


def _bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins."""
    texts = pc.fill_null(texts, "").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[offsets[0] : offsets[-1]] if raw is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


def _codes(data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each byte with the three before it, as one number."""
    n = len(data)
    out = data.astype(np.uint32)
    begin = first[:-1][(first[:-1] < n) & (np.diff(first) > 0)]
    for back in (1, 2, 3):
        shifted = np.zeros(n, np.uint32)
        shifted[back:] = data[: n - back] if n > back else 0
        for j in range(back):
            at = begin + j
            shifted[at[at < n]] = 0  # before the text
        out |= shifted << np.uint32(8 * back)
    return out


def learn(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """Costs of all rows with a language and a text: (lang, ord, escape, code, bits), stored.

    code is the context and the byte after it, or the context alone where
    ``escape``. A text begins behind three zero bytes. No rows, no costs.
    """
    rows = docs.filter(F.col(f"`{lang}`").isNotNull() & (F.length(F.col(f"`{text}`")) > 0))
    rows = rows.select(F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    counted = rows.mapInArrow(_grams, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    with scratch(docs.sparkSession):
        return freeze(counted)


def freeze(counted: DataFrame) -> DataFrame:
    """Costs from the counts of (lang, four bytes), from the shortest context up.

    Method C: a byte has the share n / (total + kinds) of its context, and the
    context's escape kinds / (total + kinds) times its chance in the next
    shorter one. What was seen in a context was seen in all shorter ones, so
    each order is an inner join with the one below.
    """
    counts = {ORDER: store(counted, "counts")}
    for k in reversed(range(ORDER)):
        shorter = F.col("code").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1)).alias("code")
        counts[k] = counts[k + 1].groupBy("lang", shorter).agg(F.sum("n").alias("n"))
    out = []
    below = None
    for k in range(ORDER + 1):
        seen = counts[k].withColumn("ctx", F.shiftright("code", 8))
        contexts = seen.groupBy("lang", "ctx").agg(F.sum("n").alias("_total"), F.count("*").alias("_kinds"))
        seen = seen.join(contexts, ["lang", "ctx"])
        whole = F.col("_total") + F.col("_kinds")
        if below is None:
            lower = F.lit(1 / 256)
        else:
            seen = seen.withColumn("_short", F.col("code").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(below, ["lang", "_short"])
            lower = F.col("_chance")
        chance = F.col("n") / whole + F.col("_kinds") / whole * lower
        seen = store(seen.select("lang", "code", chance.alias("chance")), "chances")
        out.append(seen.select("lang", F.lit(k).alias("ord"), F.lit(False).alias("escape"), "code", (-F.log2("chance")).alias("bits")))
        escapes = contexts.select("lang", F.lit(k).alias("ord"), F.lit(True).alias("escape"), F.col("ctx").alias("code"), F.log2(whole / F.col("_kinds")).alias("bits"))
        out.append(escapes)
        below = seen.select("lang", F.col("code").alias("_short"), F.col("chance").alias("_chance"))
    costs = out[0]
    for more in out[1:]:
        costs = costs.unionByName(more)
    return store(costs, "costs", keep=True)


@dataclass
class Part:
    """Costs of the contexts whose last two bytes lie in low:high; keys are language number << 32 | code, sorted."""

    langs: list[str]
    low: int
    high: int
    keys: list[np.ndarray]
    bits: list[np.ndarray]
    escape_keys: list[np.ndarray]
    escape_bits: list[np.ndarray]

    def costs(self, codes: np.ndarray) -> np.ndarray:
        """Bits of each four-byte run under each language."""
        out = np.zeros((len(codes), len(self.langs)))
        for i in range(len(self.langs)):
            open_ = np.arange(len(codes))
            for k in range(ORDER, -1, -1):
                key = (np.uint64(i) << np.uint64(32)) | (codes[open_].astype(np.uint64) & np.uint64((1 << 8 * (k + 1)) - 1))
                hit, found = _find(self.keys[k], self.bits[k], key)
                out[open_[hit], i] += found[hit]
                open_, key = open_[~hit], key[~hit]
                context = (key >> np.uint64(32) << np.uint64(32)) | ((key & np.uint64(0xFFFFFFFF)) >> np.uint64(8))
                hit, found = _find(self.escape_keys[k], self.escape_bits[k], context)
                out[open_[hit], i] += found[hit]
            out[open_, i] += 8
        return out


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(keys):
        return np.zeros(len(wanted), bool), np.zeros(len(wanted))
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return keys[at] == wanted, values[at]


def parts(costs: DataFrame, part_rows: int = PART_ROWS) -> Iterator[Part]:
    """The table in parts of bounded size: ``part_rows`` rows, what one pair of bytes has beyond that (at most 65,792 a language), and the short contexts.

    The driver sees the number of rows per pair of bytes (65,536 at most) and one part at a time.
    """
    langs = sorted(r[0] for r in costs.filter("ord = 0").select("lang").distinct().collect())
    if not langs:
        return
    pair = F.when(F.col("escape"), F.col("code")).otherwise(F.shiftright("code", 8)).bitwiseAND(F.lit(0xFFFF))
    sizes = np.zeros(1 << 16, np.int64)
    for r in costs.filter("ord >= 2").groupBy(pair.alias("p")).count().collect():
        sizes[r["p"]] = r["count"]
    edges, held = [0], 0
    for p in np.flatnonzero(sizes).tolist():
        if held and held + sizes[p] > part_rows:
            edges.append(p)
            held = 0
        held += int(sizes[p])
    number = F.array_position(F.array(*[F.lit(x) for x in langs]), F.col("lang")) - 1
    for low, high in zip(edges, [*edges[1:], 1 << 16]):
        mine = costs.filter((F.col("ord") < 2) | (pair >= low) & (pair < high))
        table = mine.select("ord", "escape", (F.shiftleft(number, 32) + F.col("code")).alias("key"), F.col("bits").cast("float").alias("bits")).toArrow()
        order, escape = table.column("ord").to_numpy(), table.column("escape").to_numpy(zero_copy_only=False)
        key, bits = table.column("key").to_numpy().astype(np.uint64), table.column("bits").to_numpy()
        lists: dict[bool, list[list[np.ndarray]]] = {False: [[], []], True: [[], []]}
        for kind, (keys, values) in lists.items():
            for k in range(ORDER + 1):
                mask = (order == k) & (escape == kind)
                by = np.argsort(key[mask])
                keys.append(key[mask][by])
                values.append(bits[mask][by])
        yield Part(langs, low, high, *lists[False], *lists[True])


def code_lengths(part: Part, texts: pa.Array) -> np.ndarray:
    """Bits of each whole text under each language, as far as the part has the contexts of its bytes."""
    data, first = _bytes(texts)
    out = np.zeros((len(first) - 1, len(part.langs)))
    codes, where = np.unique(_codes(data, first), return_inverse=True)
    pair = (codes >> np.uint32(8)) & np.uint32(0xFFFF)
    inside = (pair >= part.low) & (pair < part.high)
    cost = np.zeros((len(codes), len(part.langs)))
    cost[inside] = part.costs(codes[inside])
    if len(data):
        full = np.flatnonzero(np.diff(first) > 0)
        for i in range(len(part.langs)):
            out[full, i] = np.add.reduceat(cost[:, i][where], first[full])
    return out


def _scored(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, "_t", _TEXT_BYTES):
            bits = code_lengths(shared.value, batch.column(batch.num_columns - 1))
            ends = pa.array(np.arange(len(bits) + 1) * bits.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(bits.reshape(-1)))], [*batch.schema.names[:-1], "bits"])

    return run


def identify(docs: DataFrame, costs: DataFrame, doc_id: str = "doc_id", text: str = "text", part_rows: int = PART_ROWS) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, lang_pred, score.

    score is the share of the best language in the likelihood of all. A null
    text or one without a letter is ``und`` with score 0, as is every text if
    nothing was learned. Ties go to the name that comes first; repeated rows
    and ids give a row each.
    """
    own = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), held_out(doc_id).alias("held_out"), F.coalesce(own.rlike(r"\p{L}"), F.lit(False)).alias("_letter"), F.coalesce(own, F.lit("")).alias("_t")
    )
    context = docs.sparkSession.sparkContext
    kind = docs.schema[doc_id].dataType.simpleString()
    langs: list[str] = []
    scored: list[DataFrame] = []
    keyed = rows.withColumn("_h", F.xxhash64("_t", F.length("_t")))
    for part in parts(costs, part_rows):
        langs = part.langs
        shared = context.broadcast(part)  # bounded, see ``parts``
        named = keyed.select("doc_id", "held_out", "_letter", "_h", "_t")
        scored.append(named.mapInArrow(_scored(shared), f"doc_id {kind}, held_out boolean, _letter boolean, _h long, bits array<double>"))
    if not scored:
        return rows.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if len(scored) == 1:
        sums = scored[0]
    else:
        # one row per text and part, added up and put back to every row of the text
        each = [df.select("_h", F.lit(i).alias("_part"), "bits") for i, df in enumerate(scored)]
        stacked = each[0]
        for more in each[1:]:
            stacked = stacked.unionByName(more)
        one = stacked.groupBy("_h", "_part").agg(F.first("bits").alias("bits"))
        totals = one.groupBy("_h").agg(*[F.sum(F.get("bits", F.lit(i))).alias(f"_b{i}") for i in range(len(langs))])
        totals = totals.select(F.col("_h").alias("_k"), F.array(*[F.col(f"_b{i}") for i in range(len(langs))]).alias("bits"))
        sums = keyed.select("doc_id", "held_out", "_letter", "_h").join(totals, F.col("_h") == F.col("_k"))
    least = F.array_min("bits")
    best = F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("bits", least).cast("int"))
    likely = F.aggregate(F.transform("bits", lambda b: F.exp(-F.least((b - least) * float(np.log(2)), F.lit(700.0)))), F.lit(0.0), lambda a, x: a + x)
    return sums.select("doc_id", "held_out", F.when(F.col("_letter"), best).otherwise(F.lit(UNKNOWN)).alias("lang_pred"), F.when(F.col("_letter"), 1 / likely).otherwise(F.lit(0.0)).alias("score"))


def language_digest(docs: DataFrame) -> DataFrame:
    """Learns from the rows that are not held out and predicts all."""
    return identify(docs, learn(docs.filter(~held_out())))

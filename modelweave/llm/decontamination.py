"""Benchmark decontamination: a hash set of normalised n-grams of the test items meets the windows of every document.

The set of n-grams is broadcast while its counted size stays under a bound and
shuffled beyond it. A document is looked at word by word only if it holds one
of the anchors (the longest word of each n-gram), since no n-gram can occur
without its anchor. Every hash hit is verified on the words themselves, in the
row that carries them: one scan, and one shuffle of a narrow row per document.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.words import literal_array, right_keys, words_of
from modelweave.plans.workspace import store

BROADCAST_GRAMS = 500_000  # rows of about 150 bytes
ANCHOR_WORDS = 20_000  # more anchors than this, and every document is scanned


def item_grams(benchmark: DataFrame, n: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, gram, _len, _h): every window of ``n`` words; a shorter item is one window, an empty one none."""
    words = benchmark.select(F.col(f"`{item_id}`").alias("item_id"), words_of(F.col(f"`{text}`")).alias("_w"))
    words = words.filter(F.size("_w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (n - 1), F.lit(1)))
    grams = words.select("item_id", F.explode(F.transform(starts, lambda i: F.slice("_w", i, n))).alias("gram"))
    return grams.select("item_id", "gram", F.size("gram").alias("_len"), F.xxhash64("gram").alias("_h")).distinct()


_WINDOWS = "array<struct<s:int,k:int,h:bigint,g:array<string>>>"
_CHUNK = 4096  # window starts per row between the two explodes: bounds a row of a very long text


def _windows(k: int, every: bool) -> Column:
    """Start from 0, length, hash and words of the windows of ``k`` words that start in the chunk and hold an anchor."""
    last = F.least(F.size("_c") - (k - 1), F.lit(_CHUNK))

    def around(p: Column) -> Column:
        low, high = F.greatest(p - (k - 1), F.lit(1)), F.least(p, last)
        return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    starts = F.sequence(F.lit(1), last) if every else F.array_distinct(F.flatten(F.transform("_p", around)))
    cut = F.transform(starts, lambda i: F.struct(i.alias("i"), F.slice("_c", i, k).alias("g")))
    made = F.transform(
        cut, lambda x: F.struct((F.col("_at") + x["i"] - 1).alias("s"), F.lit(k).alias("k"), F.xxhash64(x["g"]).alias("h"), x["g"].alias("g"))
    )
    return F.when(F.size("_c") >= k, made).otherwise(F.array().cast(_WINDOWS))


def _longest(gram: Column) -> Column:
    return F.array_max(F.transform(gram, lambda w: F.struct(F.char_length(w).alias("n"), w.alias("w"))))["w"]


def judge(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One narrow row per row of ``docs``: (_id, _th, n_words, n_hit, spans, n_items, items_sha256, contaminated).

    _th is a hash of the text. spans lists the hit stretches as (start, end)
    word positions from 0, end exclusive. A document is contaminated if at
    least 1/``share`` of its words are hit. Null and empty texts have no words
    and no hits; items without words never hit; repeated rows and ids are
    judged row by row. An empty benchmark leaves all clean.
    """
    grams = store(item_grams(benchmark, n), "grams")
    found = grams.agg(F.count("*"), F.collect_set("_len")).first()
    lengths = sorted(found[1] or [])
    anchors = [r[0] for r in grams.select(_longest(F.col("gram")).alias("a")).distinct().limit(ANCHOR_WORDS + 1).collect()]
    texts = grams.groupBy("_h", "gram").agg(F.collect_set(F.col("item_id").cast("string")).alias("items"))
    if found[0] <= BROADCAST_GRAMS:
        texts = F.broadcast(texts)

    key = ["_id", "_th"]
    words = docs.select(
        F.col(f"`{doc_id}`").alias("_id"),
        F.xxhash64(F.col(f"`{text}`")).alias("_th"),
        words_of(F.col(f"`{text}`")).alias("_w"),
    )
    every = len(anchors) > ANCHOR_WORDS
    maybe = F.lit(True) if every else F.arrays_overlap("_w", literal_array(anchors))
    ats = F.when(maybe, F.sequence(F.lit(0), F.greatest(F.size("_w") - 1, F.lit(0)), F.lit(_CHUNK))).otherwise(F.array(F.lit(0)))
    reach = _CHUNK + max(lengths, default=1) - 1
    chunk = F.transform(ats, lambda i: F.struct(i.alias("at"), F.when(maybe, F.slice("_w", i + 1, reach)).otherwise(F.array().cast("array<string>")).alias("c")))
    chunks = words.select(*key, F.size("_w").cast("long").alias("n_words"), F.explode(chunk).alias("_x"))
    chunks = chunks.select(*key, "n_words", F.col("_x.at").alias("_at"), F.col("_x.c").alias("_c"))
    if not every:
        chunks = chunks.withColumn("_a", F.when(F.size("_c") > 0, F.array_intersect("_c", literal_array(anchors))).otherwise(F.array().cast("array<string>")))
        at = F.filter(F.sequence(F.lit(1), F.size("_c")), lambda i: F.array_contains(F.col("_a"), F.get("_c", i - 1)))
        chunks = chunks.withColumn("_p", F.when(F.size("_a") > 0, at).otherwise(F.array().cast("array<int>")))
    # one row more per text, so that every text has a row behind the join
    mark = F.when(F.col("_at") == 0, F.array(F.struct(F.lit(-1), F.lit(0), F.lit(None).cast("long"), F.lit(None).cast("array<string>"))).cast(_WINDOWS))
    windows = F.concat(F.coalesce(mark, F.array().cast(_WINDOWS)), *[_windows(k, every) for k in lengths])
    rows = chunks.select(*key, "n_words", F.explode(windows).alias("_x")).select(*key, "n_words", "_x.s", "_x.k", F.col("_x.h").alias("_h"), "_x.g")
    met = rows.join(texts, "_h", "left").filter((F.col("s") < 0) | (F.col("g") == F.col("gram")))
    hit = F.col("s") >= 0
    told = met.groupBy(*key).agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(~hit, 1)).alias("_copies"),
        F.collect_set(F.when(hit, F.struct("s", "k"))).alias("_hits"),
        F.collect_set(F.when(hit, F.col("items"))).alias("_items"),
    )
    covered = F.array_distinct(F.flatten(F.transform("_hits", lambda x: F.sequence(x["s"], x["s"] + x["k"] - 1))))
    items = F.array_sort(F.array_distinct(F.flatten("_items")))
    judged = told.select(
        *key, "n_words", F.size(covered).cast("long").alias("n_hit"), _merged(F.col("_hits")).alias("spans"),
        F.size(items).cast("long").alias("n_items"), F.sha2(F.concat_ws(",", items), 256).alias("items_sha256"), "_copies",
    )
    judged = judged.withColumn("contaminated", (F.col("n_hit") > 0) & (F.lit(share) * F.col("n_hit") >= F.col("n_words")))
    repeated = judged.withColumn("_copies", F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int"))))
    return repeated.drop("_copies")


def _merged(hits: Column) -> Column:
    """Overlapping or touching hits as one (start, end), word positions from 0."""
    order = F.array_sort(F.transform(hits, lambda x: F.struct(x["s"].alias("start"), (x["s"] + x["k"]).alias("end"))))
    none = F.array().cast("array<struct<start:int,end:int>>")

    def step(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        touches = (F.size(done) > 0) & (x["start"] <= last["end"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(joined))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(order, none, step)


def find_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the columns of ``judge``; of columns named like an added one, the added one stays."""
    judged = judge(docs, benchmark, n, share, doc_id, text).dropDuplicates(["_id", "_th"])
    added = [c for c in judged.columns if c[0] != "_"]
    kept = [c for c in docs.columns if c not in added]
    right = judged.select(*right_keys(["_id", "_th"]), *[F.col(c).alias(f"_r_{c}") for c in added])
    met = docs.join(right, _same_text(docs, right, doc_id, text))
    return met.select(*[docs[f"`{c}`"] for c in kept], *[right[f"_r_{c}"].alias(c) for c in added])


def _same_text(docs: DataFrame, right: DataFrame, doc_id: str, text: str) -> Column:
    return docs[f"`{doc_id}`"].eqNullSafe(right["_r__id"]) & (F.xxhash64(docs[f"`{text}`"]) == right["_r__th"])


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 13, share: int = 20) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, their columns unchanged.

    Only the keys of contaminated documents are shuffled against the texts.
    """
    bad = judge(docs, benchmark, n, share).filter("contaminated").select(*right_keys(["_id", "_th"])).distinct()
    return docs.join(bad, _same_text(docs, bad, "doc_id", "text"), "left_anti")


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document without its text: what the registered query returns."""
    found = judge(docs.select("doc_id", "text"), benchmark)
    return found.select(F.col("_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, w[i:i + 12] AS gram FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
k AS (SELECT DISTINCT len(gram) AS k FROM g),
win AS (SELECT doc_id, i, k, w[i:i + k - 1] AS gram FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, k WHERE len(w) >= k)),
hit AS (SELECT win.doc_id, win.i, win.k, g.item_id FROM win JOIN g USING (gram)),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(s, ',' ORDER BY s)) AS items_sha256 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN it USING (doc_id)
"""

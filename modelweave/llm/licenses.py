"""License scans: exact set-similarity join of text blocks with license templates.

Tokens of the templates are ordered by how many documents hold them, rarest
first. A block that contains at least ``threshold`` of a template must hold one
of the template's first tokens (prefix filter), enough distinct tokens (length
filter) and enough of them from the first shared one on (positional filter);
what is left is verified on the whole sets.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.llm.words import literal_array, right_keys, same, words_of
from modelweave.plans.workspace import store

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# public notices, as their licenses ask users to write them
TEMPLATES = {
    "agpl-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-sa-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "cc0-1.0": "To the extent possible under law, the author has dedicated all copyright and related rights to the public domain worldwide",
    "gpl-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "spdx-mit": "SPDX-License-Identifier: MIT",
}
THRESHOLD = 0.8
LINES = 5  # the longest notice at 50 letters a line


def _tokens(text: str) -> list[str]:
    """Distinct words of a template (plain ASCII)."""
    cut = "".join(c if c.isalnum() else " " for c in text.lower())
    return list(dict.fromkeys(cut.split()))


def _needed(size: int, threshold: float) -> int:
    return max(1, math.ceil(size * threshold - 1e-9))


def _places(words: Column, phrase: list[str]) -> Column:
    """Positions from 0 at which the words of ``phrase`` stand consecutively."""

    def here(i: Column) -> Column:
        out = F.lit(True)
        for j, w in enumerate(phrase):
            out = out & (F.get(words, i + j) == w)
        return out

    return F.when(F.arrays_overlap(words, F.array(F.lit(phrase[0]))), F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)).otherwise(
        F.array().cast("array<int>")
    )


def scan_licenses(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    phrases: dict[str, str] | None = None,
    threshold: float = THRESHOLD,
    block: str = "\n",
    lines: int = LINES,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: n_words, n_base, first_word, last_word, base_labels, labels, score.

    A block is a run of ``lines`` pieces of the text between ``block`` marks, one
    run from each piece on, so that a notice that is wrapped stands in one block;
    a text of fewer pieces is one block. labels adds to
    the phrases' labels those of the templates of which some block holds at
    least ``threshold``; score is the largest such share, 1 where a phrase
    stands, else 0. Null and empty texts have no words and no labels. Repeated
    rows and ids give a row each; other columns are not read.
    """
    templates = TEMPLATES if templates is None else templates
    phrases = PHRASES if phrases is None else phrases
    sets = {label: _tokens(t) for label, t in templates.items() if _tokens(t)}
    every = sorted({w for ts in sets.values() for w in ts})
    key = ["_id", "_th"]
    raw = docs.select(F.col(f"`{doc_id}`").alias("_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    raw = raw.withColumn("_th", F.xxhash64("_t"))

    # how many documents hold each template token: at most one row per token and task is shuffled
    counts = raw.select(F.explode(F.array_intersect(literal_array(every), words_of(F.col("_t")))).alias("w")).groupBy("w").count()
    seen = {r["w"]: r["count"] for r in counts.collect()} if every else {}
    order = sorted(every, key=lambda w: (seen.get(w, 0), w))
    rank = {w: i for i, w in enumerate(order)}
    rows, prefix = [], set()
    for label, ts in sorted(sets.items()):
        need = _needed(len(ts), threshold)
        sorted_set = sorted(ts, key=rank.__getitem__)
        for p, w in enumerate(sorted_set[: len(ts) - need + 1]):
            prefix.add(w)
            rows.append((w, label, p, len(ts), need, sorted_set))

    starts = [(label, _places(F.col("_w"), name.split())) for name, label in phrases.items()]
    all_places = F.array_sort(F.concat(*[p for _, p in starts])) if starts else F.array().cast("array<int>")
    named = F.filter(F.array(*[F.when(F.size(p) > 0, F.lit(label)) for label, p in starts]), lambda x: x.isNotNull())
    first = raw.withColumn("_w", words_of(F.col("_t")))
    maybe = F.arrays_overlap("_w", literal_array(sorted(prefix))) if prefix else F.lit(False)
    scanned = first.select(
        *key, F.size("_w").cast("long").alias("n_words"), all_places.alias("_p"),
        (named if starts else F.array().cast("array<string>")).alias("_base"), F.when(maybe, F.col("_t")).alias("_t"),
    )
    scanned = store(scanned, "license_scan")

    split = scanned.filter("_t is not null").dropDuplicates(key).select(*key, F.split("_t", block).alias("_l"))
    begin = F.sequence(F.lit(1), F.greatest(F.size("_l") - (lines - 1), F.lit(1)))
    runs = F.transform(begin, lambda i: F.array_join(F.slice("_l", i, F.lit(lines)), " "))
    blocks = split.select(*key, F.explode(F.array_distinct(runs)).alias("_b"))
    blocks = blocks.withColumn("_b", F.array_distinct(words_of(F.col("_b"))))
    blocks = blocks.filter(F.arrays_overlap("_b", literal_array(sorted(prefix)))) if prefix else blocks.filter("false")
    # the shared tokens of a block in global order, rarest first
    blocks = blocks.withColumn("_v", F.array_intersect(literal_array(order), F.col("_b")))
    blocks = blocks.select(*key, "_v", F.size("_b").alias("_n"), F.posexplode("_v").alias("_q", "w"))
    table = docs.sparkSession.createDataFrame(rows, "w string, label string, p int, size int, need int, tokens array<string>")
    # broadcast is bounded by the template list given in code
    met = blocks.join(F.broadcast(table), "w").filter("_n >= need and size - p >= need and size(_v) - _q >= need")
    shared = F.size(F.array_intersect("_v", "tokens"))
    met = met.filter(shared >= F.col("need")).select(*key, "label", (shared / F.col("size")).alias("score"))
    met = met.groupBy(*key).agg(F.collect_set("label").alias("_more"), F.max("score").alias("_s"))
    right = met.select(*right_keys(key), "_more", "_s")
    out = scanned.join(right, same(scanned, right, key), "left")
    joined = F.array_sort(F.array_distinct(F.concat("_base", F.coalesce("_more", F.array().cast("array<string>")))))
    score = F.greatest(F.coalesce("_s", F.lit(0.0)), F.when(F.size("_p") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))
    return out.select(
        F.col("_id").alias("doc_id"), "n_words", F.size("_p").cast("long").alias("n_base"),
        F.array_min("_p").cast("long").alias("first_word"), F.array_max("_p").cast("long").alias("last_word"),
        F.concat_ws(",", F.array_sort(F.array_distinct("_base"))).alias("base_labels"),
        F.concat_ws(",", joined).alias("labels"), score.alias("score"),
    )


_WORDS = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _sql() -> str:
    """The same rows by comparing every run of lines with every template."""
    sets = ", ".join(f"('{label}', {_tokens(t)!r}, {_needed(len(_tokens(t)), THRESHOLD)})" for label, t in TEMPLATES.items())
    phrases = ", ".join(f"('{label}', {name.split()!r})" for name, label in PHRASES.items())
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS.format("text")} AS w FROM documents),
t(label, tokens, need) AS (VALUES {sets}),
p(label, words) AS (VALUES {phrases}),
hit AS (SELECT doc_id, label, i - 1 AS pos FROM (SELECT doc_id, w, label, words, unnest(range(1, len(w) + 1)) AS i FROM d, p WHERE list_contains(w, words[1])) WHERE w[i:i + len(words) - 1] = words),
base AS (SELECT doc_id, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM hit GROUP BY doc_id),
line AS (SELECT DISTINCT doc_id, {_WORDS.format("line")} AS b FROM (
  SELECT doc_id, array_to_string(l[i:i + {LINES - 1}], ' ') AS line FROM (SELECT doc_id, l, unnest(range(1, greatest(len(l) - {LINES - 1}, 1) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM d)))),
sim AS (SELECT doc_id, label, len(list_intersect(b, tokens)) AS n, len(tokens) AS size, need FROM line, t WHERE len(b) > 0),
met AS (SELECT doc_id, label, n / size AS score FROM sim WHERE n >= need),
best AS (SELECT doc_id, max(score) AS s FROM met GROUP BY doc_id),
lab AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM met UNION ALL SELECT doc_id, label FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(greatest(coalesce(s, 0.0), CASE WHEN n_base > 0 THEN 1.0 ELSE 0.0 END) AS DOUBLE) AS score
FROM d LEFT JOIN base USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN lab USING (doc_id)
"""


SQL = _sql()

"""License scan, decontamination, substring dedup and near-duplicates against brute force."""

import hashlib
import random
import re
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelweave.llm import decontamination, licenses, near_duplicates, substrings
from tests.llm.conftest import frame, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, ties, nulls, empties and a long text."""
    r = random.Random(7)
    passage = words(r, 60)
    base = words(r, 120).split()
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one"), (6, "One two"), (7, words(r, 19)), (8, words(r, 20))]
    rows += [(9, rows[7][1]), (10, rows[7][1] + " " + rows[7][1])]
    for i in range(11, 31):
        edited = list(base)
        for _ in range(i % 7):
            edited[r.randrange(len(edited))] = "edit%d" % r.randrange(50)
        rows.append((i, " ".join(edited)))
    rows += [(i, words(r, 30) + "\n" + passage + " " + words(r, i)) for i in range(31, 41)]
    rows += [(41, "na " * 200), (42, words(r, 6000) + " " + passage), (43, rows[20][1]), (44, "ÀÉ  " + passage.upper()), (45, None)]
    rows.append(rows[5])  # a repeated row
    return rows


def test_substrings(spark, corpus):
    got = sorted(substrings.substring_digest(frame(spark, corpus)).collect(), key=str)
    seen, first = set(), {}
    want = []
    for i, text in sorted({(i, t) for i, t in corpus}, key=lambda x: x[0]):
        w = (text or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - 19):
            window = b" ".join(w[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        first[i] = (i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest())
    want = sorted((first[i] for i, _ in corpus), key=str)
    assert [tuple(x) for x in got] == [tuple(x) for x in want]
    assert sum(x[2] for x in want) > 500


def test_substrings_are_cut_from_texts(spark, corpus):
    docs = frame(spark, corpus).withColumnRenamed("source", "_mw_id")  # a clashing name
    kept = {r["doc_id"]: r for r in substrings.remove_repeats(docs).collect()}
    sizes = {r[0]: (r[1], r[2]) for r in substrings.substring_digest(docs).select("doc_id", "n_words", "n_removed").collect()}
    assert len(kept) == len({i for i, _ in corpus})
    for i, text in corpus:
        if not sizes[i][1]:
            assert kept[i]["text"] == text
        else:
            assert len(kept[i]["text"].encode().split()) == sizes[i][0] - sizes[i][1]
            assert kept[i]["n_chars"] == len(kept[i]["text"])
    assert kept[40]["text"].count("\n") == 1  # line breaks of kept words stay


def test_substrings_of_nothing(spark):
    empty = frame(spark, [])
    assert substrings.substring_digest(empty).count() == 0
    assert substrings.remove_repeats(empty).columns == empty.columns
    assert substrings.substring_digest(frame(spark, [(None, "a b"), (None, None)])).count() == 2


@pytest.mark.parametrize("shingle", [2, 5])
def test_near_duplicates(spark, corpus, shingle):
    got = {r["id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.near_duplicates(frame(spark, corpus), shingle).collect()}
    sets = {}
    for i, text in corpus:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    assert got == {i: (len(sets[i]), root(i), root(i) == i) for i in sets}
    assert len({root(i) for i in sets}) < len(sets) - 10


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates.near_duplicates(frame(spark, [])).count() == 0
    alone = near_duplicates.near_duplicates(frame(spark, [(1, None), (2, ""), (None, "a"), (3, "b")])).collect()
    assert sorted((r["id"], r["component_id"], r["kept"]) for r in alone if r["id"]) == [(1, 1, True), (2, 2, True), (3, 3, True)]
    assert [r["kept"] for r in alone if r["id"] is None] == [True]


def test_keep_one_of_each_keeps_columns(spark):
    docs = frame(spark, [(3, "a b c d e f g"), (1, "a b c d e f g"), (2, None), (2, None)])
    kept = near_duplicates.keep_one_of_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 2]


def test_registers_merge_and_estimate():
    import numpy as np

    r = np.random.default_rng(1)
    a, b = r.integers(1, 2**63, 900).astype(np.uint64), r.integers(1, 2**63, 300).astype(np.uint64)
    one, two = np.concatenate([a, b]), np.concatenate([a, b[:100]])
    sets = np.concatenate([one, two, a, b])
    first = np.cumsum([0, len(one), len(two), len(a), len(b)])
    regs = near_duplicates.registers(sets, first)
    assert (near_duplicates.merge(regs[2], regs[3]) == regs[0]).all()
    got = near_duplicates.joint_similarity(regs[:1], regs[1:2], np.array([1200.0]), np.array([1000.0]))[0]
    assert abs(got - 1000 / 1200) < 0.08


def test_buckets_are_grouped_part_by_part(monkeypatch):
    import numpy as np
    import pyarrow as pa

    class Task:
        get = staticmethod(lambda: type("Context", (), {"partitionId": lambda self: 5})())

    monkeypatch.setattr(near_duplicates, "TaskContext", Task)
    monkeypatch.setattr(near_duplicates, "_OPEN_KEYS", 48 * 10, raising=False)
    read = []

    def batches():
        for at in range(0, 70, 7):
            read.append(at)
            ids = np.arange(at, at + 7)
            keys = pa.ListArray.from_arrays(pa.array(np.arange(8) * 48, pa.int32()), pa.array(np.concatenate([np.arange(48) + 1000 * (i % 3) for i in ids])))
            yield pa.RecordBatch.from_arrays([pa.array(ids), keys, pa.array(ids % 2)], ["id", "keys", "comp"])

    out = near_duplicates._buckets(batches())
    first = next(out)
    # a task of any size holds a part of its texts at once
    assert len(read) <= 2
    found, parts = [], set()
    for batch in [first, *out]:
        for r in batch.to_pylist():
            more = r["more"][::2] if r["more"] else []
            found += [(r["bucket"], r["comp"], i) for i in (r["id"], *more)]
            parts.add(r["part"])
    assert sorted(found) == sorted((k + 1000 * (i % 3), i % 2, i) for i in range(70) for k in range(48))
    assert len(parts) == 7 and {p % 2**32 for p in parts} == {5}


def test_decontamination(spark):
    r = random.Random(3)
    item, short = words(r, 40), "unusualone unusualtwo"
    items = [(1, item), (2, short), (3, None), (4, ""), (5, item), (6, words(r, 13)), (7, " ".join(item.split()[:13]))]
    docs = [(1, None), (2, ""), (3, item.upper()), (4, words(r, 300) + " " + " ".join(item.split()[5:20])), (5, "Unusualone, unusualtwo!"), (6, words(r, 9000))]
    docs += [(7, words(r, 6000) + " " + item), (8, words(r, 12)), (8, "x " + items[5][1]), (3, item.upper())]
    bench = spark.createDataFrame(items, "item_id long, text string")
    grams = {}
    for i, text in items:
        w = WORD.findall(low(text))
        for k in range(max(len(w) - 12, 1) if w else 0):
            grams.setdefault(tuple(w[k : k + 13]), set()).add(str(i))
    want = []
    for i, text in docs:
        w = WORD.findall(low(text))
        hit, found = set(), set()
        for size in {len(g) for g in grams}:
            for k in range(len(w) - size + 1):
                if tuple(w[k : k + size]) in grams:
                    hit.update(range(k, k + size))
                    found |= grams[tuple(w[k : k + size])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        want.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    got = [tuple(x) for x in decontamination.contamination_digest(frame(spark, docs), bench).collect()]
    assert sorted(got) == sorted(want) and sum(x[5] for x in want) >= 4
    found = decontamination.find_contamination(frame(spark, docs).withColumnRenamed("source", "n_hit"), bench)
    assert found.count() == len(docs)
    assert {(s["start"], s["end"]) for x in found.filter("doc_id = 7").collect() for s in x["spans"]} == {(6000, 6040)}
    clean = decontamination.drop_contaminated(frame(spark, docs), bench)
    assert sorted(x["doc_id"] for x in clean.collect()) == sorted(x[0] for x in want if not x[5])
    none = decontamination.contamination_digest(frame(spark, docs), bench.limit(0)).collect()
    assert len(none) == len(docs) and not any(x["contaminated"] for x in none)
    assert decontamination.contamination_digest(frame(spark, []), bench).count() == 0


def test_license_scan(spark):
    docs = [(1, None), (2, ""), (3, "All Rights Reserved. CC-BY, all rights reserved"), (4, "x\nLicensed under the Apache License Version 2.0 indeed\ny"), (5, "the General  public license")]
    docs += [(6, "Licensed under the\nApache License"), (7, "permission is hereby granted free of charge to any person obtaining a copy of this software and"), (3, "cc by")]
    got = sorted(tuple(r) for r in licenses.scan_licenses(frame(spark, docs)).collect())
    assert got == sorted(
        [
            (1, 0, 0, None, None, "", "", 0.0),
            (2, 0, 0, None, None, "", "", 0.0),
            (3, 8, 3, 0, 5, "cc-by,reserved", "cc-by,reserved", 1.0),
            (3, 2, 1, 0, 0, "cc-by", "cc-by", 1.0),
            (4, 11, 0, None, None, "", "apache-2.0", 1.0),
            (5, 4, 1, 1, 1, "gpl", "gpl", 1.0),
            (6, 5, 0, None, None, "", "", 0.0),
            (7, 17, 0, None, None, "", "mit", 16 / 19),
        ],
        key=lambda x: (x[0], x[1]),
    )
    assert licenses.scan_licenses(frame(spark, [])).count() == 0


def test_near_duplicates_among_edited_copies(spark):
    """Copies of one text that are mostly no links: pairs without a bucket of their own are still found."""
    r = random.Random(11)
    base = [words(r, 1) + str(i) for i in range(100)]
    rows, sets = [], []
    for i in range(3000):
        sets.append([w if r.random() < 0.85 else f"own{i}x{k}" for k, w in enumerate(base)])
        rows.append((i, " ".join(sets[-1])))
    places = np.array([[hash(w) for w in s] for s in sets])
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        common = (places[:i] == places[i]).sum(1)
        for j in np.flatnonzero(100 * common >= 80 * (200 - common)):
            a, b = root(i), root(int(j))
            parent[max(a, b)] = min(a, b)
    want = {i: root(i) for i in range(len(sets))}
    got = {x["id"]: x["component_id"] for x in near_duplicates.near_duplicates(frame(spark, rows), 1).collect()}
    assert got == want
    assert len(set(want.values())) < len(sets) - 10


def test_common_counts():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 400, 60).astype(np.uint64) ** np.uint64(2)) for _ in range(50)]
    left, right = np.arange(20), np.arange(10, 50)
    got = near_duplicates.common_counts(sets, left, right)
    for i, a in enumerate(left):
        for j, b in enumerate(right):
            if a != b:
                assert got[i, j] == len(np.intersect1d(sets[a], sets[b]))


def test_rows_of_one_id_are_documents_of_their_own(spark):
    """Rows that share an id, null too, repeat each other like any others, and cost no more."""
    r = random.Random(4)
    passage = words(r, 25)
    texts = [words(r, 20) + f" own{i} " + passage + f" end{i}" for i in range(50)]
    shared = {x["n_removed"] for x in substrings.substring_digest(frame(spark, [(None, t) for t in texts])).collect()}
    assert shared == {0, 25}
    got = substrings.substring_digest(frame(spark, [(7, t) for t in texts])).groupBy("n_removed").count().collect()
    assert {x["n_removed"]: x["count"] for x in got} == {0: 1, 25: 49}
    docs = frame(spark, [(7, t) for t in texts]).withColumn("text_2", F.col("text")).withColumn("_k", F.lit(1))
    kept = substrings.remove_repeats(docs)
    assert kept.columns == docs.columns
    assert kept.filter(F.col("text") == F.col("text_2")).count() == 1
    assert kept.filter("n_chars = length(text)").count() == 50


def test_texts_are_shuffled_once(spark):
    passage = words(random.Random(6), 30)
    docs = frame(spark, [(i, f"a {i} {passage} b c {i}") for i in range(10)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for df in (substrings.remove_repeats(docs), substrings.substring_digest(docs)):
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString()
            final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
            assert "ReusedExchange" in final
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_wrapped_notices(spark):
    """A notice that is broken over lines is found; one whose words lie lines apart is not."""
    tail = ", to deal in the Software without restriction"
    mit = (licenses.TEMPLATES["mit"] + tail).split()
    wrap = lambda k: "\n".join(" ".join(mit[i : i + k]) for i in range(0, len(mit), k))
    docs = [(1, "head\nline\nmore\n" + wrap(12) + "\nend"), (2, "\n".join(mit)), (3, wrap(30)), (4, "\n" * 9 + wrap(9)), (5, wrap(6).replace("\n", "\n" * 6))]
    got = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan_licenses(frame(spark, docs)).collect()}
    assert got[1] == got[3] == got[4] == ("mit", 1.0)
    assert got[2] == got[5] == ("", 0.0)
    one = {r["doc_id"]: r["labels"] for r in licenses.scan_licenses(frame(spark, docs), lines=1).collect()}
    assert one == {1: "", 2: "", 3: "mit", 4: "", 5: ""}


_KEPT = """
import re
import numpy as np, pyarrow as pa
from modelweave.llm.substrings import _occurrences
from modelweave.llm.tokens import tidy

def own():
    return int(re.search("Pss_Anon: +([0-9]+)", open("/proc/self/smaps_rollup").read()).group(1)) / 1024

rng = np.random.default_rng(1)
texts = [" ".join(f"w{x}" for x in rng.integers(0, 50_000, 300)) for _ in range(10_000)]
batch = pa.RecordBatch.from_arrays([pa.array(range(10_000)), pa.array(texts), pa.array(range(10_000))], ["_mw_id", "_mw_text", "_mw_tag"])
sink = pa.BufferOutputStream()
with pa.ipc.new_stream(sink, batch.schema) as out:
    out.write_batch(batch)
stream = sink.getvalue().to_pybytes()
del texts, batch, sink, out
list(tidy(lambda batches: batches)(iter([])))
before = own()
for _ in range(2):
    for _ in tidy(_occurrences(20, 4))(iter(pa.ipc.open_stream(stream))):
        pass
print(own() - before)
"""


def test_a_worker_gives_back_what_a_task_took():
    # MB that a Python worker keeps beside the JVM of its executor when the next stage runs there
    folder = str(Path(__file__).resolve().parents[2])
    said = subprocess.run([sys.executable, "-c", _KEPT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert float(said.stdout) < 30, said.stderr

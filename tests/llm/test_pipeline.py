"""The pipeline stage by stage against brute force on a small corpus, and its registration."""

import random

import numpy as np
import pytest

import corpus_pipeline
from modelweave.llm import packing
from modelweave.llm.queries import QUERIES, SQL
from tests.llm.conftest import frame, words

BAD = ("blorkface", "snargle", "grumpwit")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(21)
    folder = str(tmp_path_factory.mktemp("sf"))
    docs, labels = [], []
    for i in range(240):
        text = words(r, 50).split()
        if i % 6 == 0:
            for w in BAD:
                text.insert(r.randrange(40), w)
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(i % 6 == 0)))
    base = words(r, 100)
    docs += [(300 + i, base + f" end{i}") for i in range(5)] + [(310, base + " end0")]
    passage, item = words(r, 60), words(r, 40)
    docs += [(400 + i, words(r, 30) + " " + passage + " " + words(r, 30)) for i in range(4)]
    docs += [(500, words(r, 10) + " " + item), (501, words(r, 2000) + " " + item), (600, None), (601, ""), (602, " "), (603, words(r, 3000))]
    frame(spark, docs).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(docs), passage


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near-duplicates", "repeated substrings", "benchmark decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14)) and set(SQL) <= set(QUERIES)


def test_each_stage(spark, corpus):
    folder, texts, passage = corpus
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {x["doc_id"]: x["text"] for x in docs.collect()}
    clean = {i: t for i, t in texts.items() if i >= 240 or i % 6}
    assert kept["toxicity"] == clean
    assert set(kept["near-duplicates"]) == set(clean) - {301, 302, 303, 304, 310}
    spans = kept["repeated substrings"]
    assert set(spans) == set(kept["near-duplicates"])
    assert passage in spans[400] and all(57 <= len(spans[400 + i].split()) <= 60 for i in (1, 2, 3))
    assert all(spans[i] == clean[i] for i in spans if i not in (401, 402, 403, 501))
    # 501 repeats the passage of 500, so its words are gone before the benchmark is looked for
    assert set(kept["benchmark decontamination"]) == set(spans) - {500}
    packed = packing.pack(docs).collect()
    ids = sum(len(packing.token_ids(t or "", packing.vocabulary_path())) + 1 for t in kept["benchmark decontamination"].values())
    assert sum(x["length"] for x in packed) == ids


def test_run_gives_the_last_stage(spark, corpus):
    folder, texts, _ = corpus
    got = corpus_pipeline.run(spark, folder).collect()
    assert {x["doc_id"] for x in got} == {i for i in texts if (i >= 240 or i % 6) and i not in (301, 302, 303, 304, 310, 500)}
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append(x["length"])
    assert max(map(sum, by.values())) <= 2048 and np.mean(list(map(sum, by.values()))) > 1900


def test_runs_of_one_session_do_not_meet(spark, corpus):
    one, two = corpus_pipeline.run(spark, corpus[0]), corpus_pipeline.run(spark, corpus[0])
    assert one.count() == two.count() > 0
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_empty_tables(spark, corpus, tmp_path):
    folder = corpus[0]
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0

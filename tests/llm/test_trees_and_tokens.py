"""Byte-pair encoding, prefix tries and hard negatives against plain versions."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from modelweave.llm import byte_pairs, hard_negatives, prefix_tries
from tests.llm.conftest import frame, words


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def strange_texts(n, seed=3):
    r = random.Random(seed)
    letters = ["'", "s", "t", "re", "ve", "ll", "m", "d", "a", "é", " ", "  ", "\n", "\t", " ", "　", "1", "٣", "½", "!", "…", "漢", "😀", "‍", "\x1c", "\x85", "é", "ǅ", "\x00"]
    return ["".join(r.choice(letters) for _ in range(r.randrange(40))) for _ in range(n)]


def test_ids_are_those_of_the_library(library):
    texts = [*strange_texts(5000), None, "", "<|endoftext|>", "a" * 30000, "ab" * 5000, " " * 3000 + "x", "it's they'll we'RE 'sound '' 've", words(random.Random(1), 3000)]
    first, ids, starts = byte_pairs.encode_batch(pa.array(texts), byte_pairs.rank_file())
    for d, text in enumerate(texts):
        own = ids[first[d] : first[d + 1]].tolist()
        assert own == library.encode_ordinary(text or ""), text
        sizes = [len(library.decode_single_token_bytes(i)) for i in own]
        assert starts[first[d] : first[d + 1]].tolist() == [sum(sizes[:n]) for n in range(len(sizes))] or len(sizes) > 500


@pytest.mark.parametrize("width", [1, 2, 7, 512])
def test_scan_is_the_same_in_any_blocks(width):
    text = "".join(strange_texts(60))
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    kind = byte_pairs.classes(points, np.array([0, len(points)]))
    state, want = byte_pairs._NONE, []
    for i, k in enumerate(kind.tolist()):  # one after the other
        if byte_pairs._CUT[k, state]:
            want.append(i)
        state = byte_pairs._AFTER[k, state]
    assert byte_pairs.boundaries(kind, width).tolist() == want


def test_cache_starts_anew(monkeypatch, library):
    monkeypatch.setattr(byte_pairs, "_CACHED_IDS", 50)
    for text in strange_texts(200, 4):
        first, ids, _ = byte_pairs.encode_batch(pa.array([text, text]), byte_pairs.rank_file())
        assert ids.tolist() == 2 * library.encode_ordinary(text)


def test_encoding_digest(spark, library):
    texts = [*strange_texts(50), None, "", "doc " * 4000]
    docs = frame(spark, [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again")])
    docs = docs.withColumn("ids", F.lit("x")).withColumn("_text", F.lit(1)).withColumn("decoded", F.lit(2))
    got = sorted((tuple(r) for r in byte_pairs.encoding_digest(docs).collect()), key=repr)
    hexed = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, text in [*enumerate(texts), (None, "no id"), (3, "again"), (3, "again")]:
        ids = library.encode_ordinary(text or "")
        want.append((i, len(ids), hexed(" ".join(map(str, ids)).encode()), hexed((text or "").encode())))
    assert got == sorted(want, key=repr)
    assert byte_pairs.encoding_digest(docs.limit(0)).collect() == []
    with pytest.raises(ValueError):
        byte_pairs.encode(docs, keep=("doc_id", "ids"))


def test_bytes_that_are_no_text(spark, library):
    docs = spark.sql("select 1L as doc_id, cast(unhex('61FF62C3') as string) as text")
    got = byte_pairs.decode(byte_pairs.encode(docs)).first()
    assert bytes(got["decoded"]).decode().replace("�", "?") == "a?b?"
    assert got["ids"] == library.encode_ordinary(bytes(got["decoded"]).decode())


CONVERSATION = "conv_id long, turn long, role string, text string"


def plain_trie(rows):
    """Every node by itself, every member and every subtree looked at one by one."""
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    for turns in own.values():
        turns.sort()
    rebuilt = {}
    for c, turns in own.items():
        base = c - c % 20 if c >= 0 else c + -c % 20
        h = 0 if base == c else zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(t[1:] for t in own.get(base, [])[:h] + turns[h:])
    members = {}
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    count = lambda turns: len(re.findall(r"[^\x20\x09-\x0D]+", turns[-1][1])) if turns else 0
    out = []
    for node, who in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = lambda n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n]
        ends = ",".join(map(str, sorted(c for c in who if len(rebuilt[c]) == len(node))))
        out.append(
            (
                min(who),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(who),
                len(children(node)),
                sum(not children(n) for n in below),
                sum((len(members[n]) - 1) * count(n) for n in below),
                hashlib.sha256(ends.encode()).hexdigest(),
            )
        )
    return sorted(out, key=repr)


def conversations(seed=2):
    r = random.Random(seed)
    rows = []
    for c in [*range(45), *range(-25, 0), 100, 121]:
        if r.random() < 0.15:
            continue
        for turn in range(r.choice([1, 1, 2, 3, 4, 12])):
            rows.append((c, turn, r.choice(["user", "assistant"][turn % 2 :][:1] + [None]), r.choice(["hi", "hello there", "", None, "a  b\tc"])))
    rows += [(7, 0, "user", "hi"), (7, None, "user", "first"), (7, None, None, None), (None, 0, "user", "nobody"), (300, 0, "u", "long " * 30000)]
    rows += [(400, t, "user", "x y") for t in range(60)] + [(440, t, "user", "x y") for t in range(60)]
    return rows


@pytest.mark.parametrize("shard_nodes, queue_items", [(100_000, 100_000), (20, 2), (3, 1)])
def test_trie_is_the_plain_one(spark, shard_nodes, queue_items):
    rows = conversations()
    df = spark.createDataFrame(rows, CONVERSATION).withColumn("depth", F.lit("x")).withColumn("k1", F.lit(1)).repartition(3)
    got = prefix_tries.trie_digest(df, shard_nodes, queue_items)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_trie(rows)


def test_trie_without_turns(spark):
    assert prefix_tries.trie_digest(spark.createDataFrame([], CONVERSATION)).collect() == []
    assert prefix_tries.trie_digest(spark.createDataFrame([(None, 1, "user", "a")], CONVERSATION)).collect() == []


def test_queue_spills_and_stays_in_order():
    r = random.Random(0)
    queue, want = prefix_tries.SpillingQueue(10), []
    for _ in range(500):
        if want and r.random() < 0.4:
            want.sort()
            assert queue.first() == want[0] and queue.pop() == want.pop(0)
        else:
            item = (r.randrange(100), r.randrange(10))
            queue.push(item)
            want.append(item)
    assert queue.spilled
    assert [queue.pop() for _ in range(len(want))] == sorted(want) and queue.first() is None


def plain_negatives(rows, positives=5, negatives=5):
    used = [(i, lab, v) for i, v, lab in rows if i is not None and lab is not None and v is not None and None not in v and np.isfinite(v).all()]
    used = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [int(np.floor(256 * float(x))) for x in v]) for i, lab, v in used]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, v in used:
        if a % 100:
            continue
        others = sorted((-dot(v, w), i, lab) for i, lab, w in used if i != a and len(w) == len(v))
        for score, p, _ in [o for o in others if o[2] == label][:positives]:
            fits = [o for o in others if o[2] != label and 80 * -score <= 100 * -o[0] <= 100 * -score][:negatives]
            out += [(a, p, n + 1, o[1], -score, -o[0]) for n, o in enumerate(fits)]
    return sorted(out)


def test_negatives_are_the_plain_ones(spark):
    r = np.random.default_rng(5)
    v = r.normal(size=(700, 6)) * r.choice([0.2, 1, 3], size=(700, 1))
    v[200:330] = v[100]  # a hot vector
    rows = [(i, [float(x) for x in v[i]], int(r.integers(0, 4))) for i in range(700)]
    rows += [(1000, None, 1), (1100, [1.0] * 6, None), (1200, [1.0, None] * 3, 2), (1300, [float("nan")] * 6, 2), (1400, [float("inf")] * 6, 2), (None, [1.0] * 6, 2)]
    rows += [(1500, [2.0, 1.0], 1), (1501, [1.0, 1.0], 1), (1502, [1.0, 0.9], 2), (1600, [0.0] * 6, 3), (1700, [], 1), (1701, [], 1), (1702, [], 2), (2100, [-1.0] * 6, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit("x")).withColumn("low", F.lit(1))
    small = df.select("vec_id", "embedding", "label", "id", "low")
    want = plain_negatives(rows)
    assert len(want) > 50
    got = hard_negatives.hard_negative_digest(small)
    assert sorted(tuple(x) for x in got.collect()) == want
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    scaled = small.filter(~F.exists("embedding", bad)).select("vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x * 256)).alias("embedding"))
    cut = hard_negatives.hard_negatives(scaled, F.col("vec_id") % 100 == 0, shard_rows=60, block_rows=4)
    assert sorted(tuple(x) for x in cut.collect()) == want
    assert hard_negatives.hard_negative_digest(small.limit(0)).collect() == []


def test_trees_leave_out_cells():
    r = np.random.default_rng(1)
    centres = r.integers(-2000, 2000, size=(30, 5))
    v = np.concatenate([c + r.integers(-20, 20, size=(80, 5)) for c in centres])
    ids, labels = np.arange(len(v)), np.zeros(len(v), int)
    tree = hard_negatives.build(ids, labels, v, leaf=32)
    asked = v[::100]
    scores = asked @ v.T
    low, high = np.quantile(scores, 0.95, axis=1).astype(int), np.quantile(scores, 0.99, axis=1).astype(int)
    looked = []
    plain = hard_negatives._exact
    try:
        hard_negatives._exact = lambda a, b: looked.append(len(a) * len(b)) or plain(a, b)
        names, best = hard_negatives.search(tree, ids[::100], labels[::100], asked, low, high, True, 5)
    finally:
        hard_negatives._exact = plain
    for q in range(len(asked)):
        fits = sorted((-s, i) for i, s in enumerate(scores[q].tolist()) if low[q] <= s <= high[q] and i != 100 * q)[:5]
        assert list(zip((-best[q]).tolist(), names[q].tolist())) == fits
    assert sum(looked) < len(asked) * len(v) / 2


def test_large_components_stay_exact():
    v = np.array([[2**31, 1], [2**31, 2], [-(2**31), 3]])
    assert hard_negatives._exact(v, v).tolist() == [[int(a[0]) * int(b[0]) + int(a[1]) * int(b[1]) for b in v] for a in v]

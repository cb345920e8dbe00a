"""Documents out of tables and back: rights, conflicts, deletes, tags, pages."""

import dataclasses
import json
import os

import pytest
from pyspark.sql import functions as F

from modelweave.model import DocField, DocNode, Tags
from modelweave.operators import documents as D
from modelweave.operators.writeback import write_documents
from modelweave.sources.live import create_tables, open_tables
from tests.conftest import rows

ALL = Tags(insert=True, update=True, delete=True)


def fields(text, **tags):
    return tuple(DocField(c, tags=tags.get(c)) for c in text.split())


def spec(order=ALL, line=ALL, customer=ALL, **column_tags):
    return DocNode(
        "orders",
        (DocField("id", key="_id"), DocField("cust"), DocField("state", tags=column_tags.get("state"))),
        key=("id",),
        tags=order,
        children=(
            DocNode("customer", fields("c name"), "buyer", "object", (("cust", "c"),), key=("c",), tags=customer),
            DocNode("lines", fields("n qty", **column_tags), "lines", "array", (("id", "o"),), order=("n",), key=("o", "n"), tags=line),
        ),
    )


@pytest.fixture(scope="module")
def frames(spark):
    return {
        "orders": spark.createDataFrame([(1, 7, "new"), (2, 7, "new"), (3, 8, "new")], "id int, cust int, state string"),
        "customer": spark.createDataFrame([(7, "Ann", "x"), (8, "Bob", "y")], "c int, name string, hidden string"),
        "lines": spark.createDataFrame([(1, 1, 10), (1, 2, 20), (2, 1, 30)], "o int, n int, qty int"),
    }


def edited(spark, frames, root, edit):
    """Documents changed as JSON by a plain function, read back with their schema."""
    docs = D.build_documents(root, frames)
    texts = [edit(json.loads(r[0])) for r in docs.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).collect()]
    lines = spark.createDataFrame([(json.dumps(t),) for t in texts if t is not None], "t string")
    return lines.select(F.from_json("t", docs.schema).alias("d")).select("d.*")


def test_round_trip(frames):
    got, conflicts = D.shred(D.build_documents(spec(), frames), spec())
    assert rows(got["orders"], "id", "cust", "state") == rows(frames["orders"])
    assert rows(got["customer"], "c", "name") == rows(frames["customer"], "c", "name")
    assert rows(got["lines"], "o", "n", "qty") == rows(frames["lines"])
    assert conflicts["customer"].count() == 0


def test_unchanged_documents_change_nothing(frames):
    after, rejects = D.apply_documents(frames, D.build_documents(spec(), frames), spec())
    assert rejects.count() == 0
    for name, df in frames.items():
        assert rows(after[name]) == rows(df)


def change(doc):
    """Order 1: state, line 1 gone, line 2 doubled, line 9 new, buyer renamed in both documents."""
    doc["buyer"]["name"] = doc["buyer"]["name"].upper()
    if doc["_id"] == 1:
        doc["state"] = "done"
        doc["lines"] = [{"n": 2, "qty": 40}, {"n": 9, "qty": 1}]
    return doc


def test_everything_allowed(spark, frames):
    after, rejects = D.apply_documents(frames, edited(spark, frames, spec(), change), spec())
    assert rejects.count() == 0
    assert rows(after["orders"]) == [(1, 7, "done"), (2, 7, "new"), (3, 8, "new")]
    assert rows(after["customer"]) == [(7, "ANN", "x"), (8, "BOB", "y")]
    assert rows(after["lines"]) == [(1, 2, 40), (1, 9, 1), (2, 1, 30)]


@pytest.mark.parametrize(
    "right, action, lines",
    [
        ("insert", "added", [(1, 2, 40), (2, 1, 30)]),
        ("update", "modified", [(1, 2, 20), (1, 9, 1), (2, 1, 30)]),
        ("delete", "removed", [(1, 1, 10), (1, 2, 40), (1, 9, 1), (2, 1, 30)]),
    ],
)
def test_each_right_off(spark, frames, right, action, lines):
    root = spec(line=dataclasses.replace(ALL, **{right: False}))
    after, rejects = D.apply_documents(frames, edited(spark, frames, root, change), root)
    assert rows(rejects, "table_name", "action") == [("lines", action)]
    assert rows(after["lines"]) == lines


def test_column_right_wins_over_table_right(spark, frames):
    docs = edited(spark, frames, spec(), change)
    after, rejects = D.apply_documents(frames, docs, spec(state=Tags(update=False)))
    assert rows(rejects, "table_name", "row_key", "action") == [("orders", '{"id":"1"}', "modified")]
    after, rejects = D.apply_documents(frames, docs, spec(order=Tags(), state=Tags(update=True)))
    assert rejects.count() == 0 and rows(after["orders"])[0] == (1, 7, "done")


def test_conflicting_contents_of_a_shared_row(spark, frames):
    def edit(doc):
        doc["buyer"]["name"] += str(doc["_id"])
        return doc

    after, rejects = D.apply_documents(frames, edited(spark, frames, spec(), edit), spec())
    assert rows(rejects, "table_name", "row_key", "action") == [("customer", '{"c":"7"}', "conflict")]
    assert rows(after["customer"], "c", "name") == [(7, "Ann"), (8, "Bob3")]


def test_new_and_deleted_documents(spark, frames):
    def edit(doc):
        if doc["_id"] == 3:
            return {"_id": 4, "cust": 9, "state": "new", "buyer": {"c": 9, "name": "Cy"}, "lines": [{"n": 1, "qty": 5}], "_page": 0}
        return None

    docs = edited(spark, frames, spec(), edit)
    gone = spark.createDataFrame([(1,)], "id int")
    after, rejects = D.apply_documents(frames, docs, spec(), gone)
    assert rejects.count() == 0
    assert rows(after["orders"], "id") == [(2,), (3,), (4,)]
    assert rows(after["lines"]) == [(2, 1, 30), (4, 1, 5)]
    assert rows(after["customer"]) == sorted([(7, "Ann", "x"), (8, "Bob", "y"), (9, "Cy", None)])
    _, rejects = D.apply_documents(frames, docs, spec(order=Tags(insert=True, update=True)), gone)
    assert rows(rejects, "table_name", "action") == [("orders", "removed")]


def test_double_keys_in_a_document_are_rejected(spark, frames):
    def edit(doc):
        doc["lines"] = doc["lines"] + doc["lines"]
        return doc

    after, rejects = D.apply_documents(frames, edited(spark, frames, spec(), edit), spec())
    assert rows(rejects, "table_name", "action") == [("lines", "ambiguous")] * 3
    assert rows(after["lines"]) == rows(frames["lines"])


def test_etag_follows_the_checked_columns(spark, frames):
    root = spec(order=Tags(check="CHECK", etag=True), state=Tags(check="NOCHECK", etag=True))
    before = D.etag(D.build_documents(root, frames), root)
    state = {**frames, "orders": frames["orders"].withColumn("state", F.lit("other"))}
    lines = {**frames, "lines": frames["lines"].withColumn("qty", F.when(F.col("o") == 2, 0).otherwise(F.col("qty")))}
    assert D.etag_conflicts(D.build_documents(root, state), before, root, ["_id"]).count() == 0
    assert rows(D.etag_conflicts(D.build_documents(root, lines), before, root, ["_id"]), "_id") == [(2,)]


def test_paged_documents_write_back(spark, frames):
    small = D.build_documents(spec(), frames, page_rows=1)
    assert small.filter("_page > 0").count() == 1
    after, rejects = D.apply_documents(frames, small, spec())
    assert rejects.count() == 0 and rows(after["lines"]) == rows(frames["lines"])


def test_unnested_object_and_name_clash(frames):
    root = dataclasses.replace(
        spec(), children=(dataclasses.replace(spec().children[0], unnest=True), spec().children[1])
    )
    docs = D.build_documents(root, frames)
    assert docs.columns == ["_id", "cust", "state", "c", "name", "lines", "_page"]
    got, _ = D.shred(docs, root)
    assert rows(got["customer"], "c", "name") == rows(frames["customer"], "c", "name")
    clash = dataclasses.replace(root, fields=(*root.fields, DocField("state", key="name")))
    with pytest.raises(ValueError, match="name"):
        D.build_documents(clash, frames)


def test_flex_entries_stand_beside_the_fields(spark):
    df = spark.createDataFrame([(1, '{"id":9,"z":[1,{"a":null}]}'), (2, "{}"), (3, None)], "id int, more string")
    root = DocNode("t", (DocField("id"), DocField("more", flex=True)), key=("id",))
    docs = [r[0] for r in D.build_documents(root, {"t": df}, as_json=True).select("doc").collect()]
    assert [json.loads(d) for d in docs] == [{"id": 1, "z": [1, {"a": None}]}, {"id": 2}, {"id": 3}]
    assert rows(D.shred(D.build_documents(root, {"t": df}), root)[0]["t"]) == rows(df)
    merged = D.flex_merge(df, ["id"], "more").select("id", F.map_keys("doc").alias("k"))
    assert rows(merged) == [(1, ["id", "z"]), (2, ["id"]), (3, ["id"])]


def test_write_back_of_a_stream_of_documents(spark, frames, tmp_path):
    edited(spark, frames, spec(), change).write.parquet(str(tmp_path / "in"))
    seen = []

    def batch(docs, _):
        after, rejects = D.apply_documents(frames, docs, spec())
        seen.append((rejects.count(), rows(after["lines"])))

    stream = spark.readStream.schema(spark.read.parquet(str(tmp_path / "in")).schema).parquet(str(tmp_path / "in"))
    query = stream.writeStream.foreachBatch(batch).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True)
    query.start().awaitTermination()
    assert seen == [(0, [(1, 2, 40), (1, 9, 1), (2, 1, 30)])]


def test_a_table_at_two_places_is_not_written_back(frames):
    twice = dataclasses.replace(spec(), children=(*spec().children, dataclasses.replace(spec().children[0], name="seller")))
    with pytest.raises(ValueError, match="two places"):
        D.apply_documents(frames, frames["orders"], twice)


def live_frames(spark, frames, tmp_path, partitions=3):
    keys = {"orders": ["id"], "customer": ["c"], "lines": ["o", "n"]}
    return create_tables(spark, str(tmp_path / "live"), frames, keys, partitions)


def times(live):
    return {f: os.stat(f"{live.folder}/{f}").st_mtime_ns for names in live.files.values() for f in names}


def test_only_touched_files_are_written_anew(spark, frames, tmp_path):
    live = live_frames(spark, frames, tmp_path)
    before = times(live)

    def edit(doc):
        if doc["_id"] != 2:
            return None
        doc["lines"] = [{"n": 1, "qty": 31}, {"n": 5, "qty": 1}]
        return doc

    after, rejects = write_documents(live, edited(spark, frames, spec(), edit), spec())
    assert rejects.count() == 0
    assert rows(after.read("lines")) == [(1, 1, 10), (1, 2, 20), (2, 1, 31), (2, 5, 1)]
    assert after.files["orders"] == live.files["orders"] and after.files["customer"] == live.files["customer"]
    kept = set(live.files["lines"]) & set(after.files["lines"])
    assert len(kept) == len(live.files["lines"]) - 1 and len(live.files["lines"]) == 3
    assert all(os.stat(f"{live.folder}/{f}").st_mtime_ns == before[f] for f in kept)
    # the old version still reads as it was, and the new one is what a reader finds
    assert rows(live.read("lines")) == rows(frames["lines"])
    assert rows(open_tables(spark, live.folder).read("lines")) == rows(after.read("lines"))
    with pytest.raises(Exception, match="(?i)exist"):
        live.commit({}, {})


def test_writing_is_applying(spark, frames, tmp_path):
    docs = edited(spark, frames, spec(), change)
    want, _ = D.apply_documents(frames, docs, spec(line=dataclasses.replace(ALL, delete=False)))
    live, rejects = write_documents(live_frames(spark, frames, tmp_path), docs, spec(line=dataclasses.replace(ALL, delete=False)))
    assert rows(rejects, "table_name", "action") == [("lines", "removed")]
    for name in frames:
        assert rows(live.read(name), *frames[name].columns) == rows(want[name], *frames[name].columns)


def test_stale_documents_are_refused_whole(spark, frames, tmp_path):
    root = spec()
    live = live_frames(spark, frames, tmp_path)
    read = D.etag(D.build_documents(root, frames), root)
    lines = F.transform("lines", lambda x: x.withField("qty", x["qty"] + 1))
    first = read.filter("_id = 1").withColumn("lines", lines)
    live, rejects = write_documents(live, first, root, tag="_etag")
    assert rejects.count() == 0 and rows(live.read("lines")) == [(1, 1, 11), (1, 2, 21), (2, 1, 30)]
    late = read.withColumn("state", F.lit("late"))
    live, rejects = write_documents(live, late, root, tag="_etag")
    assert rows(rejects) == [("orders", '{"id":"1"}', "stale")]
    assert rows(live.read("orders")) == [(1, 7, "new"), (2, 7, "late"), (3, 8, "late")]
    # without a tag a stored document is not overwritten; deleted meanwhile is stale as well
    gone = spark.createDataFrame([(3,)], "id int")
    live, _ = write_documents(live, read.limit(0), root, gone)
    assert rows(live.read("orders"), "id") == [(1,), (2,)]
    again = read.withColumn("_etag", F.when(F.col("_id") == 3, F.col("_etag")))
    live, rejects = write_documents(live, again, root, tag="_etag")
    assert rows(rejects, "row_key", "action") == [('{"id":"1"}', "stale"), ('{"id":"2"}', "stale"), ('{"id":"3"}', "stale")]


def test_hidden_rows_are_not_deleted(spark, frames, tmp_path):
    root = dataclasses.replace(spec(), children=(spec().children[0], dataclasses.replace(spec().children[1], where="qty < 20")))
    docs = D.build_documents(root, frames).withColumn("lines", F.filter("lines", lambda x: x["n"] > 1))
    live, rejects = write_documents(live_frames(spark, frames, tmp_path), docs, root)
    assert rejects.count() == 0 and rows(live.read("lines")) == [(1, 2, 20), (2, 1, 30)]


def test_a_scan_reads_the_range_of_the_keys(spark, frames, tmp_path):
    wide = {**frames, "orders": spark.range(1000).selectExpr("cast(id as int) id", "7 as cust", "'new' as state")}
    live = live_frames(spark, wide, tmp_path, 20)
    docs = D.build_documents(spec(), {**wide, "orders": wide["orders"].filter("id in (500, 501)")}).withColumn("state", F.lit("x"))
    after, _ = write_documents(live, docs, spec())
    assert len(set(live.files["orders"]) - set(after.files["orders"])) <= 2
    assert after.read("orders").filter("state = 'x'").count() == 2 and after.read("orders").count() == 1000


def test_empty_live_tables(spark, frames, tmp_path):
    none = {n: df.limit(0) for n, df in frames.items()}
    live = live_frames(spark, none, tmp_path)
    assert live.read("lines").count() == 0
    live, rejects = write_documents(live, D.build_documents(spec(), frames), spec())
    assert rejects.count() == 0 and rows(live.read("lines")) == rows(frames["lines"])
    with pytest.raises(ValueError, match="already"):
        create_tables(spark, live.folder, frames, {})


def test_flex_at_every_level_and_back(spark):
    tables = {
        "a": spark.createDataFrame([(1, 7, '{"z":[1,{"q":null}],"id":5}'), (2, None, None), (3, 8, "{}")], "id int, up int, more string"),
        "u": spark.createDataFrame([(7, 'x"y', '{"free":true,"l":1}'), (8, None, None)], "k int, name string, extra string"),
        "i": spark.createDataFrame([(1, 1, "1.50", '{"deep":{"m":[[]]}}'), (1, 2, None, None), (3, 1, "2.00", '{"n":9,"o":"é"}')], "o int, n int, p string, rest string"),
        "j": spark.createDataFrame([(1, 1, '{"w":1}'), (2, 1, None)], "j int, own int, f string"),
    }
    tables["i"] = tables["i"].withColumn("p", F.col("p").cast("decimal(8,2)"))
    leaf = DocNode("j", (DocField("j"), DocField("f", flex=True)), "leaves", "array", (("n", "own"),), order=("j",), key=("j",))
    for unnest in (False, True):
        up = DocNode("u", (DocField("k"), DocField("name"), DocField("extra", flex=True)) if not unnest else (DocField("k"), DocField("name")), "buyer", "object", (("up", "k"),), key=("k",), unnest=unnest)
        items = DocNode("i", (DocField("n"), DocField("p", key="price"), DocField("rest", flex=True)), "items", "array", (("id", "o"),), order=("n",), key=("o", "n"), children=(leaf,))
        root = DocNode("a", (DocField("id"), DocField("up"), DocField("more", flex=True)), key=("id",), children=(up, items))
        texts = D.build_documents(root, tables, as_json=True)
        docs = {r["id"]: json.loads(r["doc"]) for r in texts.collect()}
        assert docs[1]["z"] == [1, {"q": None}] and docs[1]["id"] == 1
        assert docs[1]["items"][0]["deep"] == {"m": [[]]} and docs[1]["items"][0]["leaves"] == [{"j": 1, "w": 1}, {"j": 2}]
        assert docs[3]["items"][0] == {"n": 1, "price": 2.0, "_page": 0, "leaves": [{"j": 1, "w": 1}, {"j": 2}], "o": "é"}
        if not unnest:
            assert docs[1]["buyer"] == {"k": 7, "name": 'x"y', "free": True, "l": 1} and docs[2]["buyer"] is None
        back = D.parse_documents(texts, root, tables)
        got, _ = D.shred(back, root)
        assert rows(got["i"], "o", "n", "p") == rows(tables["i"], "o", "n", "p")
        assert rows(got["i"], "o", "n", "rest") == [(1, 1, '{"deep":{"m":[[]]}}'), (1, 2, None), (3, 1, '{"o":"é"}')]
        assert rows(got["u"], "k", "name") == rows(tables["u"], "k", "name")
        # an entry that a field hides, and an empty object, do not come back
        assert rows(got["a"], "id", "more") == [(1, '{"z":[1,{"q":null}]}'), (2, None), (3, None)]
        assert D.parse_documents(texts.withColumn("doc", F.lit("{bad")), root, tables).filter("id is not null").count() == 0


def test_files_of_unique_keys_follow_the_size(spark, tmp_path):
    wide = F.concat(F.sha2(F.col("id").cast("string"), 256), F.sha2((-F.col("id")).cast("string"), 256))
    lines = spark.range(0, 200_000).select((F.col("id") % 50_000).alias("o"), (F.col("id") % 7).cast("int").alias("n"), wide.alias("t"))
    small = spark.range(5).select("id")
    live = create_tables(spark, str(tmp_path / "live"), {"lines": lines, "small": small}, {"lines": ["o", "n"], "small": ["id"]}, unique=True)
    assert len(live.files["lines"]) > len(live.files["small"]) == 1
    assert live.read("lines").exceptAll(lines).isEmpty() and live.read("lines").count() == 200_000
    ends = live.read_with_file("lines").groupBy("_file").agg(F.min("o").alias("low"), F.max("o").alias("high")).orderBy("low").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(ends, ends[1:]))

"""Rows loaded into a declared table, floats that keep what they are written as, and paths of JSON values."""

import json

import pytest
from pyspark.sql import functions as F

from modelweave.model import Check, Column, Generated, Table
from modelweave.operators import aggregates as A
from modelweave.operators import evolution as E
from modelweave.operators import types as T
from modelweave.operators.load import computing_order, load_table, names_in
from tests.conftest import plan_of, rows


def reasons(df, *columns):
    return sorted(((tuple(r[c] for c in columns), tuple(r["reasons"])) for r in df.collect()), key=repr)


def test_order_of_columns_and_circles():
    table = Table("t", (Column("c", "int", generated=Generated(expression="b + a")), Column("b", "int", default="a * 2"), Column("a", "int")))
    assert [c.name for c in computing_order(table)] == ["a", "b", "c"]
    assert names_in("concat('a', `B`, 'it''s c')", ["a", "b", "c"]) == {"b"}
    ring = Table("t", (Column("a", "int", default="b"), Column("b", "int", default="a")))
    with pytest.raises(ValueError, match="a, b"):
        computing_order(ring)
    with pytest.raises(ValueError, match="need each other"):
        computing_order(Table("t", (Column("a", "int", generated=Generated(expression="a + 1")),)))


def test_defaults_generated_values_and_rejects(spark):
    table = Table(
        "t",
        (
            Column("id", "int", nullable=False),
            Column("n", "decimal(5,2)", default="0", default_on_null=True, rules={"maximum": 100}),
            Column("twice", "decimal(6,2)", generated=Generated(expression="n * 2")),
            Column("tag", "string", generated=Generated("BY DEFAULT", "concat('t', id)", on_null=True), length=4),
            Column("kept", "string", default="'x'"),
            Column("none", "string", default="''"),
            Column("blank", "string", default=" "),
        ),
        checks=(Check("small", "twice < 150"),),
    )
    df = spark.createDataFrame(
        [(1, "1.5", None, None, 9), (2, None, "own", "k", 9), (3, "1.234", None, "k", 9), (None, "80", None, "k", 9), (5, "x", None, "k", 9), (6, "101", "too long", "k", 9)],
        "id int, n string, tag string, kept string, twice int",
    )
    good, bad = load_table(df.withColumn("extra", F.lit(1)), table)
    got = [tuple(r) for r in good.orderBy("id").collect()]
    assert [(r[0], float(r[1]), float(r[2]), *r[3:]) for r in got] == [(1, 1.5, 3.0, "t1", None, "", None), (2, 0.0, 0.0, "own", "k", "", None)]
    assert bad.columns == [*df.columns, "extra", "reasons"]
    assert reasons(bad, "id", "n")[0] == ((3, "1.234"), ("n: changed by decimal(5,2)",))
    found = {r["n"]: list(r["reasons"]) for r in bad.collect()}
    assert found["80"] == ["t.id.not_null", "t.small"] and found["x"] == ["n: no decimal(5,2)"]
    assert found["101"] == ["tag: longer than 4", "t.n.maximum", "t.small"]
    assert good.count() + bad.count() == df.count()
    assert plan_of(good).count("Scan") <= 2


@pytest.mark.parametrize("kind, on_null, want", [("ALWAYS", False, [10, 15, 20]), ("BY DEFAULT", False, [7, None, None]), ("BY DEFAULT", True, [7, 10, 15])])
def test_identities(spark, kind, on_null, want):
    df = spark.createDataFrame([("a", 7), ("b", None), ("c", None)], "k string, id int")
    table = Table("t", (Column("k", "string"), Column("id", "int", generated=Generated(kind, as_identity=True, on_null=on_null, start=10, increment=5)), Column("code", "string", default="concat(k, id)")))
    good, bad = load_table(df, table, ["k"], unique=True)
    assert [r["id"] for r in good.orderBy("k").collect()] == want and bad.count() == 0
    assert [r["code"] for r in good.orderBy("k").collect()] == [f"{k}{i}" if i is not None else None for k, i in zip("abc", want)]
    # an identity of a text says nothing
    table = Table("t", (Column("k", "string", generated=Generated("ALWAYS", as_identity=True)),))
    assert rows(load_table(df, table)[0]) == [("a",), ("b",), ("c",)]


def test_floats_keep_what_they_are_written_as(spark):
    df = spark.createDataFrame([("0.1", 0.1), ("1e-3", 0.1 + 0.2), ("16777217", 16777217.0), ("3.25", 3.25), ("0.123456789", 1 / 3), ("NaN", float("nan")), ("x", None)], "t string, d double")
    good, bad = T.conform(df.select("t"), Table("t", (Column("t", "float"),)))
    assert [r[0] for r in bad.collect()] == ["16777217", "0.123456789", "x"] and good.count() == 4
    good, bad = T.conform(df.select("d"), Table("t", (Column("d", "float"),)))
    assert [r[0] for r in bad.collect()] == [0.1 + 0.2, 16777217.0, 1 / 3]
    good, _ = E.change_type(df.select("d"), "d", "float")
    assert good.count() == 4


def test_kinds_at_every_depth(spark):
    old = [{"a": {"b": {"c": {"d": 1}}}, "l": [{"b": 1}, [2]], "t": '{"x": [[[ \\" }'}, [1], "text", None]
    new = [{"a": {"b": {"c": {"d": "x"}}}, "l": [{"b": "x"}, [2]], "t": "]"}, [1], "text", None]
    frames = [spark.createDataFrame([(json.dumps(v),) for v in side] + [("{bad",), (None,)], "j string") for side in (old, new)]
    drift = {r["field"]: (r["change"], r["old_kinds"], r["new_kinds"]) for r in E.field_drift(*frames, "j").collect()}
    assert drift["a.b.c.d"] == drift["l[].b"] == ("type changed", "number", "string")
    assert {k for k, v in drift.items() if v[0] == "same"} == {"a", "a.b", "a.b.c", "l", "l[]", "l[][]", "t", "[]"}
    assert drift["l[]"] == ("same", "array,object", "array,object")
    every = rows(A.json_column_profile(frames[0], ["j"], mode="all").filter("path = ''"), "kind", "n")
    assert every == [("jsonArray", 1), ("jsonNull", 1), ("jsonObject", 1), ("jsonString", 1)]
    assert A.json_column_profile(frames[0].limit(0), ["j"], mode="all").count() == 0
    with pytest.raises(ValueError):
        A.json_column_profile(frames[0], ["j"])

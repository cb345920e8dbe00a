"""Edge cases on small frames, against values worked out by hand or by a plain loop."""

import re

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.functions import scalars as S
from modelweave.model import Column, ForeignKey, Generated, Model, Sequence, Step, Table, Key, Check
from modelweave.operators import aggregates as A
from modelweave.operators import evolution as E
from modelweave.operators import joins as J
from modelweave.operators import layout as L
from modelweave.operators import migrate as M
from modelweave.operators import projections as P
from modelweave.operators import sequences as Q
from modelweave.operators import setops as U
from modelweave.operators import types as TY
from modelweave.plans.star import STAR
from modelweave.plans.workspace import new_folder, store
from modelweave.sources import external, sinks, tables
from tests.conftest import plan_of, rows


def one(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


@pytest.fixture(scope="module")
def keys_null(spark):
    return spark.createDataFrame([(1, 1), (1, None), (None, None), (1, 1)], "a int, b int")


# keys and constraints


def test_unique_skips_null_keys_and_primary_rejects_them(keys_null):
    assert rows(A.key_violations(keys_null, ["a", "b"])) == [(1, 1, 2)]
    assert rows(A.key_violations(keys_null, ["a", "b"], primary=True)) == sorted([(1, 1, 2), (1, None, 1), (None, None, 1)], key=repr)


def test_expression_key(keys_null):
    assert rows(A.expression_key_violations(keys_null, "a + b")) == [(2, 2)]


def test_check_passes_null_and_check_option_refuses_it(keys_null):
    assert P.check_violations(keys_null, "c", "b > 1").count() == 2
    assert P.check_option_rejects(keys_null, "b = 1").count() == 2


def test_fk_ignores_null_parts_and_inactive(spark, keys_null):
    parent = spark.createDataFrame([(2, 1)], "x int, y int")
    assert J.fk_orphans(keys_null, parent, ["a", "b"], ["x", "y"]).count() == 2
    assert J.fk_orphans(keys_null, parent, ["a", "b"], ["x", "y"], active=False).count() == 0


def test_exceptions_match_the_report(spark, keys_null):
    model = Model(
        (
            Table(
                "t",
                (Column("a", "int", nullable=False), Column("b", "int", rules={"minimum": 2})),
                (Key("u", ("a", "b")), Key("later", ("a",), validate=False, rely=True, deferrable=True)),
                (Check("c", "a < 1"),),
            ),
        )
    )
    report = {r[0]: (r[1], r[2], r[3]) for r in A.constraint_report({"t": keys_null}, model).collect()}
    assert report == {
        "t.a.not_null": ("NOT NULL", "VALIDATE", 1),
        "t.b.minimum": ("DOMAIN", "VALIDATE", 2),
        "t.c": ("CHECK", "VALIDATE", 3),
        "t.u": ("UNIQUE", "VALIDATE", 2),
        "t.later": ("UNIQUE", "NOVALIDATE RELY DEFERRABLE", None),
    }
    stored = A.exceptions_table({"t": keys_null}, model, {"t": ["a", "b"]})
    counts = {r[0]: r[1] for r in stored.groupBy("constraint_name").count().collect()}
    assert counts == {k: v[2] for k, v in report.items() if v[2]}


def test_exceptions_meet_only_the_keys_that_fail(spark, read):
    keys = {t.name: list(t.keys[0].columns) for t in STAR.tables}
    stored = A.exceptions_table({name: read(name) for name in keys}, STAR, keys)
    assert stored.filter("constraint_name = 'lineitem.pk'").count() > 0
    # its references hold, so no row is carried to their values again
    assert "l_partkey" not in plan_of(stored) and "l_suppkey" not in plan_of(stored)


def test_report_enters_whole_numbers_as_they_are(spark, read):
    plan = plan_of(A.constraint_report({t.name: read(t.name) for t in STAR.tables}, STAR))
    assert "lambdafunction" not in plan and "k0#" in plan


def test_values_of_a_key_of_several_kinds(spark):
    kinds = "a int, b string, c bigint, d double"
    whole = [(1, "x", 2, 0.5), (1, "x", 2, 0.5), (1, "", 2, 0.5), (0, '","', 0, 1.5), (0, "", 0, 1.5)]
    gaps = [(None, "x", 2, 0.5), (None, "x", 2, 0.5), (0, None, 0, 1.5), (1, "x", None, 0.5), (1, "x", 2, None)]
    columns = ("a", "b", "c", "d")
    model = Model(
        (Table("p", tuple(Column(c, "string") for c in columns), (Key("pk", columns, primary=True), Key("u", ("b", "d")))), Table("q", tuple(Column(c, "string") for c in columns))),
        (ForeignKey("fk", "q", columns, "p", columns), ForeignKey("wide", "q", ("c",), "p", ("a",))),
    )
    children = [(1, "x", 2, 0.5), (1, "x", 3, 0.5), (0, '"', 0, 1.5), (0, "", 0, 1.5), (None, "z", 9, 9.0), (0, "", None, 1.5)]
    frames = {"p": spark.createDataFrame(whole + gaps, kinds), "q": spark.createDataFrame(children, kinds)}
    report = {r[0]: r[3] for r in A.constraint_report(frames, model).collect()}
    assert report == {"p.pk": 2 + len(gaps), "p.u": 5, "q.fk": 2, "q.wide": 3}
    found = A.exceptions_table(frames, model, {"p": columns, "q": columns})
    assert {r[0]: r[1] for r in found.groupBy("constraint_name").count().collect()} == report


def test_edges_meet_only_the_pairs_that_are_mutual(spark, read):
    edges = [(1, 2), (2, 1), (2, 1), (3, 3), (3, 3), (4, 5), (None, 1), (1, None), (None, None), (7, 6), (6, 7)]
    df = spark.createDataFrame([(*e, i) for i, e in enumerate(edges)], "s bigint, d int, i int")
    assert rows(J.mutual_edges(df, "s", "d"), "i") == [(0,), (1,), (10,), (2,), (9,)]
    assert rows(J.without_mutual_edges(df, "s", "d"), "i") == [(i,) for i in (3, 4, 5, 6, 7, 8)]
    # the other side holds the mutual pairs, not all edges turned round
    lines = read("lineitem").select(F.col("l_partkey").alias("s"), F.col("l_suppkey").alias("d"))
    assert "least(" in plan_of(J.mutual_edges(lines, "s", "d")) and "least(" in plan_of(J.without_mutual_edges(lines, "s", "d"))


def test_only_edges_that_may_have_a_reverse_are_paired(spark):
    # 5,000 starts of which 10 are an end: the aggregate over pairs sees the edges among these
    lines = spark.range(5_000).selectExpr("id as s", "id % 10 as d").union(spark.range(10).selectExpr("id as s", "(id + 1) % 10 as d"))
    lines = store(lines, "edges")
    assert rows(J.mutual_edges(lines, "s", "d")) == []
    back = store(lines.union(spark.createDataFrame([(0, 9), (7, 4_007)], "s bigint, d bigint")), "edges")
    found = J.mutual_edges(back, "s", "d")
    assert rows(found) == [(0, 9), (4007, 7), (7, 4007), (9, 0)]
    assert plan_of(found).count("LeftSemi") >= 3


def test_cardinality(spark):
    parent = one(spark, [1, 2, 3], "int")
    child = one(spark, [1, 1, 1, 2], "int")
    assert rows(A.cardinality_violations(parent, child, [("v", "v")], 1, 2)) == [(1, 3), (3, 0)]


def test_key_with_many_rows_for_an_object_raises(spark):
    parent = one(spark, [1, 2], "int")
    child = spark.createDataFrame([(1, "x"), (1, "y")], "k int, n string")
    with pytest.raises(PySparkException, match="more than one row"):
        J.nest_one(parent, child, [("v", "k")], ["n"], "o").collect()
    assert J.nest_one(parent, child.limit(1), [("v", "k")], ["n"], "o").filter("o is null").count() == 1


def test_view_text_keeps_other_braces(spark):
    df = one(spark, ['{"a":1}', "{}"])
    assert values(P.view_sql(spark, "SELECT v FROM ${t} WHERE v <> '{}'", t=df), "v") == ['{"a":1}']
    assert values(P.view_sql(spark, "SELECT '{x}' AS v"), "v") == ["{x}"]


def test_view_of_several_tables_needs_keys(spark):
    a, b = one(spark, [1, 2], "int"), one(spark, [2, 3], "int")
    columns = [("a", "v", ""), ("b", "v", "w")]
    assert rows(P.view_project({"a": a, "b": b}, columns, "a.v = b.v")) == [(2, 2)]
    with pytest.raises(ValueError):
        P.view_project({"a": a, "b": b}, columns)


# joins


def test_not_in_nulls(spark):
    a, b = one(spark, [1, 2, None], "int"), one(spark, [2, None], "int")
    assert rows(J.not_in(a, b, [("v", "v")])) == sorted([(1,), (None,)], key=repr)
    assert rows(J.not_in(a, b, [("v", "v")], sql_nulls=True)) == []
    assert rows(J.not_in(a, b.dropna(), [("v", "v")], sql_nulls=True)) == [(1,)]
    assert len(rows(J.not_in(a, b.limit(0), [("v", "v")], sql_nulls=True))) == 3


def test_mutual_edges(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "a"), ("a", "c"), ("d", "d"), ("e", "f")], "s string, d string")
    assert rows(J.mutual_edges(edges, "s", "d")) == [("a", "b"), ("b", "a")]
    assert rows(J.without_mutual_edges(edges, "s", "d")) == [("a", "c"), ("d", "d"), ("e", "f")]


def test_terms_as_whole_words(spark):
    corpus = one(spark, ["An ABC here", "costs A$1 now", "xabcx éabcd", "Two  words", "two words", "-- end"])
    dictionary = one(spark, ["abc", "A$1", "two words", "éabc", "bc", "abcd", "--", "two", "1 now", "zzz"])
    found = values(J.terms_used(corpus, "v", dictionary, "v"), "v")
    assert sorted(found) == ["1 now", "A$1", "abc", "abcd", "two", "two words"]


def test_terms_against_a_plain_search(spark, read):
    import re

    texts = values(read("conversations"), "text")
    words = sorted({w for t in values(read("benchmark"), "text") for w in re.findall(r"[A-Za-z0-9_]+ [A-Za-z0-9_]+", t)})
    got = set(values(J.terms_used(read("conversations"), "text", one(spark, words), "v"), "v"))
    edge = "[A-Za-z0-9_]"
    want = {w for w in words if any(re.search(f"(?<!{edge}){re.escape(w)}(?!{edge})", t, re.I) for t in texts)}
    assert got == want and want


@pytest.mark.parametrize("on", ["", "a.v >= 0", "a.v = b.v or a.v > 1", "a.v = a.v", "(a.v = b.v or true)"])
def test_view_of_a_product_is_refused(spark, on):
    frames = {"a": one(spark, [1], "int"), "b": one(spark, [1], "int")}
    with pytest.raises(ValueError):
        J.join_view(frames, on)
    with pytest.raises(ValueError):
        P.view_project(frames, [("a", "v", ""), ("b", "v", "w")], on)
    assert J.join_view(frames, "a.v = b.v and a.v >= 0").count() == 1


def test_double_lookup_keys_raise(spark):
    twice = spark.createDataFrame([(1, "x"), (1, "y")], "i int, n string")
    once = spark.createDataFrame([(1, [1, 2])], "i int, l array<int>")
    for df in (
        J.resolve_ids(once, "i", twice, "i", "n", "name"),
        J.resolve_id_array(once, ["i"], "l", twice, "i", "n"),
        TY.map_codes(once.withColumn("t", F.lit("1")), "t", twice.select(F.col("i").cast("string"), "n"), "d", "c"),
        L.partition_by_reference(once, twice.toDF("k", "p"), [("i", "k")])[0],
    ):
        with pytest.raises(PySparkException):
            df.collect()


def test_rules_of_the_round(spark):
    numbers = spark.createDataFrame([(0.3,), (0.7,), (1.1,), (0.25,)], "v double")
    assert numbers.filter(~A.domain_rule("v", "multiple_of", 0.1)).count() == 1
    days = one(spark, ["1995-02-01", "1995-02-15", "1995-01-14"]).select(F.to_date("v").alias("v"))
    assert values(L.partition_interval(days, "v", 1, "1995-01-15", "month"), "p") == [0, 1, -1]
    record = spark.createDataFrame([((1.9,),), ((2.0,),)], "s struct<x:double>")
    good, bad = E.change_field_type(record, "s.x", "int")
    assert good.count() == 1 and bad.count() == 1
    text = one(spark, ["2024-01-31 23:59:59", "2024-01-31", "123456789012345678901.5", "0012.50", "12.5"])
    day, long = (TY.conform(text, Table("t", (Column("v", kind),)))[0] for kind in ("date", "decimal(38,1)"))
    assert day.count() == 1 and long.count() == 3
    whole, _ = TY.conform(text, Table("t", (Column("v", "decimal(38,0)"), Column("absent", "interval day"))))
    assert whole.count() == 0


def test_append_refuses_null_keys(spark):
    path = new_folder(spark, "append")
    one(spark, [1], "int").write.parquet(path)
    for _ in range(2):
        after, rejects = sinks.append_only(one(spark, [None], "int"), path, ["v"])
        assert after.count() == 1 and rejects.count() == 1


def test_range_keys_hold_no_payload(spark):
    from modelweave.plans.positions import in_order

    plan = plan_of(in_order(spark.range(5).withColumn("text", F.concat(F.lit("x"), F.col("id"))), ["id"]))
    exchange = next(line for line in plan.splitlines() if "rangepartitioning" in line)
    assert "substring(text#" in exchange and "text#" not in exchange.replace("xxhash64(text#", "").replace("substring(text#", "")


def test_cascade_along_a_self_reference(spark):
    staff = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None), (6, 5)], "id int, boss int")
    badge = spark.createDataFrame([(i,) for i in (1, 3, 4, 5)], "staff int")
    fks = [
        ForeignKey("boss", "staff", ("boss",), "staff", ("id",), "CASCADE"),
        ForeignKey("badge", "badge", ("staff",), "staff", ("id",), "CASCADE"),
    ]
    after = J.cascade_delete(
        {"staff": staff, "badge": badge}, fks, "staff", staff.filter("id = 1"), ["id"], {"badge": ["staff"]}
    )
    assert rows(after["staff"], "id") == [(5,), (6,)]
    assert rows(after["badge"]) == [(5,)]


def test_cascade_sees_every_path(spark):
    a = one(spark, [1, 2], "int").toDF("a")
    b = spark.createDataFrame([(10, 1), (11, 2)], "b int, a int")
    c = spark.createDataFrame([(1, 11, 1), (2, 11, 2), (3, 10, 2)], "c int, b int, a int")
    d = spark.createDataFrame([(1,), (2,), (3,)], "c int")
    fks = [
        ForeignKey("x", "b", ("a",), "a", ("a",), "CASCADE"),
        ForeignKey("y", "c", ("a",), "a", ("a",), "CASCADE"),
        ForeignKey("z", "c", ("b",), "b", ("b",), "CASCADE"),
        ForeignKey("w", "d", ("c",), "c", ("c",), "CASCADE"),
    ]
    after = J.cascade_delete({"a": a, "b": b, "c": c, "d": d}, fks, "a", a.filter("a = 1"), ["a"])
    assert rows(after["c"], "c") == [(2,)] and rows(after["d"]) == [(2,)]


def test_resolve_id_array_keeps_order_and_unknown_ids(spark):
    lists = spark.createDataFrame([(1, [3, 1, 9, 1]), (2, []), (3, None)], "k int, ids array<int>")
    dim = spark.createDataFrame([(1, "one", None), (3, "three", "drei")], "id int, name string, fresh string")
    got = J.resolve_id_array(lists, ["k"], "ids", dim, "id", "name", "fresh")
    assert rows(got) == sorted([(1, ["drei", "one", "9", "one"]), (2, []), (3, [])], key=repr)


def test_lists_per_key_leave_out_nulls(spark):
    df = spark.createDataFrame([("a", 2), ("a", None), ("a", 1), ("b", None), (None, 5)], "k string, v int")
    want = sorted([("a", [1, 2], False, 0), ("b", [], True, 0), (None, [5], False, 0)], key=repr)
    assert rows(A.collect_by_key(df, ["k"], "v")) == want
    paged = A.collect_by_key(df, ["k"], "v", page_rows=1)
    assert rows(paged.filter("k = 'a'"), "items", "is_empty", "page") == [([1], False, 0), ([2], False, 1)]


# scalars


def test_names(spark):
    df = one(spark, ["ABC", "A1", "a b", "O'Neil", "", None])
    assert values(df, S.quote_name("v")) == ["ABC", '"A1"', '"a b"', '"O\'Neil"', "", None]
    assert values(df, S.escape_quotes("v", wrap=True))[3] == "'O''Neil'"
    assert values(df, S.qualified_name("v", F.lit("t"))) == ["ABC.t", "A1.t", "a b.t", "O'Neil.t", "t", "t"]
    assert values(one(spark, ["'a'", "a", "'"]), S.wrap_once("v")) == ["'a'", "'a'", "'"]


def test_json_kinds(spark):
    df = one(spark, ['{"a":1}', "[1]", '"s"', "1.5", "true", "null", "{bad", "", None])
    assert values(df, S.json_kind("v")) == ["object", "array", "string", "number", "boolean", "null", None, None, None]
    assert TY.json_kind_violations(df, "v", "ARRAY").count() == 7
    kind = A.json_column_profile(df.withColumn("i", F.monotonically_increasing_id()), ["v"], ["i"]).collect()
    assert kind[0].kind == "jsonObject"


def test_numbers(spark):
    df = one(spark, ["12", "1.26", "", "x", "1e3", None, "9" * 39])
    assert values(df, S.number_or_null("v")) == [12.0, 1.26, None, None, 1000.0, None, 1e39]
    assert [None if v is None else str(v) for v in values(df, TY.to_number("v", 5, 1))] == ["12.0", "1.3", None, None, "1000.0", None, None]
    assert str(values(one(spark, ["123456"]), TY.to_number("v", 5, -2))[0]) == "123500"
    with pytest.raises(ValueError):
        TY.to_number("v", 39)


def test_texts(spark):
    df = one(spark, ["one", "a\nb", "a;\n\n\n\n b /\n", "ü"])
    assert values(df, S.indent("v", "  "))[:2] == ["  one", "  a\n  b"]
    assert values(df, S.comment_out("v", F.lit(False)))[:2] == ["-- one", "/*\na\nb */\n"]
    assert values(df, S.comment_out("v", F.lit(None).cast("boolean")))[0] == "one"
    assert values(df, S.split_statements("v"))[2] == [T.Row(pos=0, statement="a"), T.Row(pos=1, statement="b")]
    assert values(df, S.headline("v", 1)) == ["o", "a", "a", "ü"]


def test_parens(spark):
    df = one(spark, ["(a)", "(a) or (b)", " ((a)) ", "a", "((a) or (b))", "(a", ")a("])
    assert values(df, S.strip_outer_parens("v")) == ["a", "(a) or (b)", "(a)", "a", "(a) or (b)", "(a", ")a("]


def test_versions_and_templates(spark):
    df = one(spark, ["19.3.0", "2", "", None, "99.1"])
    assert values(df, S.major_version("v", ["12c", "19c", "21c", "23ai"], "21c")) == ["19c", "21c", "21c", "21c", "21c"]
    assert values(df, S.render_template("<${v}|${n}|${none}>", {"v": "v", "n": F.lit(0)}))[3] == "<|0|>"


def test_bad_bytes(spark):
    df = spark.createDataFrame([(bytearray(b"a\xff"),)], "v binary")
    assert values(df, S.bytes_to_text("v")) == ["a�"]


# types and sequences


def test_conform_finds_lost_and_changed_values(spark):
    df = spark.createDataFrame([("1", 1.26, "ab"), ("x", 1.5, "ab"), ("2", 1.5, "abc"), (None, None, None)], "a string, b double, c string")
    table = Table("t", (Column("a", "int"), Column("b", "decimal(4,1)"), Column("c", "string", length=2)))
    good, bad = TY.conform(df, table)
    assert rows(good, "a") == [(None,)]
    assert sorted(r.reasons[0] for r in bad.collect()) == ["a: no int", "b: changed by decimal(4,1)", "c: longer than 2"]
    assert TY.conform(df, table, keep_lossy=True)[0].count() == 2


@pytest.mark.parametrize("spec", [(3, 1, 1, 7), (3, 2, 1, 8), (5, -3, 0, 9), (-1, -1, -5, -1)])
def test_cycles_against_a_loop(spark, spec):
    start, inc, low, high = spec
    value, want = start, []
    for _ in range(30):
        want.append(value)
        value += inc
        if not low <= value <= high:
            value = low if inc > 0 else high
    got = spark.range(30).select(Q.value_at(F.col("id"), Sequence(start, inc, low, high, True)))
    assert [r[0] for r in got.collect()] == want


def test_sequence_bounds(spark):
    assert Q.bounds(Sequence()) == (1, 1, (1 << 63) - 1)
    assert Q.bounds(Sequence(increment=-2)) == (-1, -(1 << 63), -1)
    with pytest.raises(PySparkException, match="passes its bound"):
        spark.range(5).select(Q.value_at(F.col("id"), Sequence(1, 1, 1, 4))).collect()


def test_identity_modes(spark):
    df = spark.createDataFrame([("a", 7), ("b", None)], "n string, id bigint")
    made = Generated(as_identity=True, start=5)
    assert rows(Q.assign_identity(df, "id", ["n"], made)) == [("a", 5), ("b", 6)]
    assert rows(Q.assign_identity(df, "id", ["n"], Generated("BY DEFAULT", as_identity=True))) == rows(df)
    on_null = Generated("BY DEFAULT", as_identity=True, on_null=True, start=50)
    assert rows(Q.assign_identity(df, "id", ["n"], on_null), "n", "id") == [("a", 7), ("b", 50)]


def test_continue_from_nothing_and_after_a_raised_minimum(spark):
    batch, none = one(spark, ["a", "b"]), spark.createDataFrame([], "id bigint")
    stored = one(spark, [4, 9], "bigint").toDF("id")
    spec = Sequence(start=10, increment=2, min_value=10)
    assert rows(Q.continue_sequence(batch, ["v"], none, "id", spec)) == [("a", 10), ("b", 12)]
    assert rows(Q.continue_sequence(batch, ["v"], stored, "id", Sequence(increment=2))) == [("a", 11), ("b", 13)]
    assert rows(Q.continue_sequence(batch, ["v"], stored, "id", spec, Sequence(start=1))) == [("a", 10), ("b", 12)]


def test_scaled_ids_need_room(spark):
    with pytest.raises(ValueError):
        Q.scaled_ids(one(spark, ["a"]), 6, extend=False)
    ids = values(Q.scaled_ids(spark.range(100, numPartitions=7).toDF("v"), 10, extend=False), "id")
    assert len(set(ids)) == 100 and {len(str(i)) for i in ids} == {10}


def test_vectors_and_collections(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.5, None],), ([300.0, 1.0, 2.0],), (None,)], "v array<double>")
    assert TY.vector_violations(df, "v", 2).count() == 2
    assert TY.vector_violations(df, "v", "*", "INT8").count() == 2
    assert TY.collection_violations(df, "v", 2).count() == 1
    assert TY.collection_violations(df, "v", None, not_null=True).count() == 1


def test_encryption(spark):
    df = one(spark, ["x", "x", None])
    key, wrong = F.lit(b"0123456789abcdef"), F.lit(b"fedcba9876543210")
    plain = TY.encrypt_columns(df, ["v"], key, salted=False)
    salted = TY.encrypt_columns(df, ["v"], key)
    assert plain.distinct().count() == 2 and salted.distinct().count() == 3
    assert values(TY.decrypt_columns(salted, ["v"], key), "v") == ["x", "x", None]
    assert values(TY.decrypt_columns(salted, ["v"], wrong), "v") == [None] * 3


def test_intervals(spark):
    df = one(spark, [100, -13], "bigint")
    assert values(df, TY.interval_number(TY.to_interval("v", "year"), "year")) == [100, -13]
    assert [float(v) for v in values(df, TY.interval_number(TY.to_interval("v", "day"), "day"))] == [100.0, -13.0]


# snapshots


def test_diff(spark):
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1), (5, "e", 1), (8, "h", 1), (8, "h", 2)], "id int, n string, p int")
    new = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (4, "d", 1), (5, "E", 1), (6, "c", 1), (8, "h", 1)], "id int, n string, p int")
    assert U.snapshot_diff(new, new, ["id"]).count() == 0
    got = rows(U.snapshot_diff(old, new, ["id"]), "id", "change")
    assert got == sorted([(2, "modified"), (3, "removed"), (4, "added"), (5, "modified"), (6, "added"), (8, "ambiguous")], key=repr)
    several = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b")], "id int, n string"), spark.createDataFrame([(7, "a"), (8, "b"), (9, "b")], "id int, n string")
    named = U.snapshot_diff_two_keys(*several, "id", "n").select("matched_by", "old.id", "new.id").toDF("m", "o", "n")
    assert rows(named) == sorted([("ambiguous", i, None) for i in (1, 2, 3)] + [("ambiguous", None, i) for i in (7, 8, 9)], key=repr)
    two = U.snapshot_diff_two_keys(old, new, "id", "n").select("matched_by", "old.id", "new.id").toDF("m", "o", "n")
    assert rows(two) == sorted(
        [("id", 1, 1), ("id", 2, 2), ("id", 5, 5), ("name", 3, 6), ("added", None, 4), ("ambiguous", 8, 8)], key=repr
    )


def test_subtract_treats_null_as_equal(keys_null):
    assert U.subtract_by_key(keys_null, keys_null.filter("b is null"), ["a", "b"]).count() == 2


# evolution and migration


def test_evolve_skips_and_rejects(spark):
    df = spark.createDataFrame([(1, "10"), (2, "x")], "id int, n string")
    plan = [
        Step("type", "m", "int"),
        Step("rename", "n", "m"),
        Step("drop", "id"),
        Step("add", "s", Column("s", "int", default="1"), active=False),
    ]
    out, rejects, skipped = E.evolve(df, plan)
    assert rows(out) == [(1, 10)]
    assert rows(rejects, "row") == [('{"id":2,"m":"x"}',)]
    assert [s.action for s in skipped] == ["drop", "add"]
    assert E.evolve(df, plan, allow_drops=True)[0].columns == ["m"]


def test_evolve_forth_and_back(read):
    df = read("customer")
    forth, _, _ = E.evolve(df, [Step("rename", "c_name", "x"), Step("add", "y", Column("y", "int", default="1"))])
    back, _, _ = E.evolve(forth, [Step("rename", "x", "c_name"), Step("drop", "y")], allow_drops=True)
    assert back.columns == df.columns and back.exceptAll(df).count() == 0


def test_null_structs_stay_null(spark):
    df = spark.createDataFrame([(1, (1, "a")), (2, None)], "id int, s struct<a:int,b:string>")
    assert values(E.add_field(df, "s.c", 1), "s") == [T.Row(a=1, b="a", c=1), None]
    assert values(E.rename_field(df, "s.a", "z"), "s") == [T.Row(z=1, b="a"), None]
    good, bad = E.change_field_type(df, "s.b", "int")
    assert good.count() == 1 and bad.count() == 1


def test_moves_make_parents_and_keep_older_values(spark):
    df = spark.createDataFrame([(1, (5,), None), (2, None, ((9,),)), (3, None, None)], "id int, a struct<x:int>, g struct<i:struct<x:int>>")
    moved = M.move_path(df, "a", "g.i")
    assert moved.columns == ["id", "g"]
    assert values(moved, "g.i.x") == [5, 9, None]
    assert values(moved, "g") [2] is None


def test_versions_compare_part_by_part(spark):
    df = one(spark, ["0.1.9", "0.1.23", "1.0", "1.0.0.0.0.0.1", "0.0", "x", "1..2", None])
    assert values(df, M.version_parts(F.col("v"))) == [[0, 1, 9], [0, 1, 23], [1], [1, 0, 0, 0, 0, 0, 1], [0], None, None, None]
    done, rejects = M.migrate(df, "v", "1.0.0.0.0.0.2", {"1.0.0.0.0.0.1": [], "1.0.0.0.0.0.2": []})
    assert rows(done) == [("1.0.0.0.0.0.2",)] * 5 and rejects.count() == 3


def test_migrate_leaves_newer_records(spark):
    df = spark.createDataFrame([("0.9", True, (1, 2)), ("1.0", True, (1, 2)), ("1.0.1", True, (3, 4)), ("new", True, None)], "ver string, force boolean, b struct<x:int,y:int>")
    rules = {"1.0": [M.Rule("set_where", {"match": {"force": True}, "values": {"f": "force"}}), M.Rule("remove_fields", {"path": "b", "names": ["x"]})]}
    done, rejects = M.migrate(df, "ver", "1.0", rules)
    assert rows(done, "ver", "f", "b.x", "b.y") == [("1.0", "force", None, 2), ("1.0", None, 1, 2), ("1.0.1", None, 3, 4)]
    assert rows(rejects, "ver", "reasons") == [("new", ["ver: no version"])]
    older, _ = M.migrate(df, "ver", "0.9.9", rules)
    assert rows(older, "ver", "b.x") == [("0.9", 1), ("1.0", 1), ("1.0.1", 3)]


def test_condition_trees(spark):
    df = spark.createDataFrame([(1, None), (None, (1,))], "a int, s struct<x:int>")
    tree = {"type": "or", "values": [{"key": "s", "valueType": "object"}, {"key": "gone", "exist": True}]}
    assert values(df, M.condition(df, tree)) == [False, True]


# sources, sinks, layouts


def test_reject_limit(spark, read):
    path = new_folder(spark, "csv")
    good = read("nation").select(F.concat_ws(",", "n_nationkey", "n_name"))
    good.unionByName(spark.createDataFrame([("x,bad",), ("y,bad",)], good.schema)).write.text(path)
    schema = T.StructType().add("n_nationkey", "integer").add("n_name", "string")
    fetched, rejects = external.read_external(spark, [path], "csv", schema, 2)
    assert fetched.count() == 25 and sorted(values(rejects, "line")) == ["x,bad", "y,bad"]
    # a line is bad whatever columns are read of it, and good rows come from the files themselves
    assert fetched.select("n_name").filter("n_name = 'bad'").count() == 0 and fetched.select("n_name").distinct().count() == 25
    assert "FileScan csv" in plan_of(fetched) or "Scan csv" in plan_of(fetched)
    lines = new_folder(spark, "json")
    spark.createDataFrame([('{"a":1,"b":2}',), ('{"a":1,"b":"x"}',), ("{",)], "v string").write.text(lines)
    fetched, bad = external.read_external(spark, [lines], "json", T.StructType().add("a", "integer").add("b", "integer"))
    assert fetched.count() == fetched.select("a").count() == 1 and bad.count() == 2
    with pytest.raises(ValueError, match="2 rejected lines"):
        external.read_external(spark, [path], "csv", schema, 1)


def test_append_refuses_known_and_double_keys(spark):
    path = new_folder(spark, "append")
    one(spark, [1, 2], "int").write.parquet(path)
    after, rejects = sinks.append_only(one(spark, [2, 3, 4, 4], "int"), path, ["v"])
    assert rows(after) == [(1,), (2,), (3,)] and rows(rejects) == [(2,), (4,), (4,)]


def test_duplicate_checks_the_size(spark):
    big = spark.range(11)
    assert "broadcast" not in str(sinks.duplicate(big, 50)._jdf.queryExecution().logical()).lower()
    assert "broadcast" in str(sinks.duplicate(big, 1000)._jdf.queryExecution().logical()).lower()


def test_sample_size(spark):
    df = spark.range(1000)
    assert values(tables.sample_size(df, "relative", 3.3), "sample_size") == [33]
    assert values(tables.sample_size(df, "relative", 50, 7), "sample_size") == [7]
    assert values(tables.sample_size(df, "absolute", 5), "sample_size") == [5]


def test_partitions_prune(spark, read):
    df = L.partition_composite(read("orders"), L.list_name("o_orderstatus", {"done": ["F"]}, True), F.year("o_orderdate"))
    stored = L.write_partitioned(df, ["p", "sp"], new_folder(spark, "layout"))
    plan = plan_of(stored.filter("p = 'done' AND sp = 1997").select("o_orderkey"))
    assert "PartitionFilters: [isnotnull(p" in plan and "struct<o_orderkey:bigint>" in plan
    assert stored.count() == read("orders").count()


def test_range_rejects_and_lists(spark):
    df = one(spark, [1, 5, 10, None], "int")
    kept, rejects = L.partition_range(df, "v", [("a", 5), ("b", 10)])
    assert rows(kept) == [(1, "a"), (5, "b")] and rejects.count() == 2
    assert rows(L.partition_interval(df.dropna(), "v", 4, 2), "p") == [(-1,), (0,), (2,)]


def test_posting_blocks(spark, tmp_path):
    df = spark.range(-30, 1000).select(F.col("id").alias("k"), F.array(F.lit("all"), (F.col("id") % 97).cast("string"), F.lit("all")).alias("m")).unionByName(
        spark.sql("select cast(null as bigint) k, array('all') m union all select 5000, null")
    )
    blocks = A.posting_blocks(df, "k", F.col("m"), span=64)
    plan = plan_of(blocks)
    assert plan[: plan.index("(1)")].count("Exchange") == 1
    hot = rows(blocks.filter("value = 'all'"), "first", "last", "n")
    assert len(hot) == 17 and sum(r[2] for r in hot) == 1030 and max(r[2] for r in hot) == 64 and hot.count((-30, -1, 30)) == 1
    stored = sinks.write_clustered(blocks, [("value", "asc"), ("first", "asc")], str(tmp_path / "blocks"))
    found = A.lookup_postings(stored, ["all", "3"], 100, 202)
    assert rows(found) == sorted([("all", i) for i in range(100, 203)] + [("3", 100), ("3", 197)], key=repr)
    pushed = re.search(r"PushedFilters: .*", plan_of(found))[0]
    assert "LessThanOrEqual(first,202)" in pushed and "GreaterThanOrEqual(last,100)" in pushed and "In(value" in pushed
    assert A.lookup_postings(stored, []).count() == 0

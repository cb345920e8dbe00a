"""Checks of schema evolution (E) and record migration (M)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import Registry, dec
from modelweave.model import Column, ForeignKey, Generated, Step
from modelweave.operators import evolution as E
from modelweave.operators import migrate as M
from modelweave.operators.joins import nest_many

R = Registry()


@R.add(
    "e01_add_column",
    """SELECT c_custkey, 'new' AS state, CAST(upper(c_mktsegment) || '!' AS VARCHAR) AS loud, CAST(row_number() OVER (ORDER BY c_custkey) AS BIGINT) AS id,
    CAST(NULL AS INTEGER) AS empty FROM customer""",
)
def _(t):
    df = t("customer").select("c_custkey", "c_mktsegment")
    df = E.add_column(df, Column("state", "string", default="'new'"))
    df = E.add_column(df, Column("loud", "string", generated=Generated(expression=" upper(c_mktsegment) || '!' ")))
    df = E.add_column(df, Column("empty", "int"))
    df = E.add_column(df, Column("id", "bigint", generated=Generated(as_identity=True)), ["c_custkey"])
    return df.drop("c_mktsegment")


@R.add("e02_drop_column", "SELECT * EXCLUDE (p_retailprice) FROM part")
def _(t):
    return E.drop_column(t("part"), "p_retailprice")


@R.add("e03_rename_column", "SELECT * RENAME (s_acctbal AS balance) FROM supplier")
def _(t):
    return E.rename_column(t("supplier"), "s_acctbal", "balance")


@R.add(
    "e04_change_type",
    """SELECT 'kept' AS side, o_orderkey, CAST(o_totalprice AS INTEGER) AS price FROM orders WHERE o_totalprice = trunc(o_totalprice)
    UNION ALL SELECT 'reject', o_orderkey, NULL FROM orders WHERE o_totalprice <> trunc(o_totalprice)""",
)
def _(t):
    rows, rejects = E.change_type(t("orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "int")
    return rows.select(F.lit("kept").alias("side"), "o_orderkey", F.col("o_totalprice").alias("price")).unionByName(
        rejects.select(F.lit("reject").alias("side"), "o_orderkey", F.lit(None).cast("int").alias("price"))
    )


def _lists(t) -> DataFrame:
    """Orders with a struct and a list of structs."""
    orders = t("orders").select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("info"))
    lines = t("lineitem")
    fields = ["l_linenumber", "l_partkey", "l_returnflag"]
    return nest_many(orders, lines, [("o_orderkey", "l_orderkey")], fields, "lines")


def _flat(df: DataFrame) -> DataFrame:
    return df.select("o_orderkey", "info.*", F.explode("lines").alias("l")).select(
        "o_orderkey", *[c for c in df.select("info.*").columns], "l.*"
    )


_NESTED = "FROM orders JOIN lineitem ON l_orderkey = o_orderkey"


@R.add(
    "e05_add_field",
    f"SELECT o_orderkey, o_orderstatus, o_orderpriority, 1 AS version, l_linenumber, l_partkey, l_returnflag, 'kg' AS unit {_NESTED}",
)
def _(t):
    return _flat(E.add_field(E.add_field(_lists(t), "info.version", 1), "lines.unit", "kg"))


@R.add("e06_drop_field", f"SELECT o_orderkey, o_orderpriority, l_linenumber, l_partkey {_NESTED}")
def _(t):
    return _flat(E.drop_field(E.drop_field(_lists(t), "info.o_orderstatus"), "lines.l_returnflag"))


@R.add("e07_rename_field", f"SELECT o_orderkey, o_orderstatus AS status, o_orderpriority, l_linenumber, l_partkey AS part, l_returnflag {_NESTED}")
def _(t):
    return _flat(E.rename_field(E.rename_field(_lists(t), "info.o_orderstatus", "status"), "lines.l_partkey", "part"))


@R.add(
    "e08_change_field_type",
    f"""SELECT o_orderkey, o_orderstatus, o_orderpriority, l_linenumber, CAST(l_partkey AS VARCHAR) AS l_partkey, l_returnflag {_NESTED}
    WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
)
def _(t):
    # a returned line is refused: its mark is no date
    mark = F.when(F.col("l_returnflag") == "R", "R").otherwise("2020-01-01")
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag", mark.alias("mark"))
    orders = t("orders").select("o_orderkey", F.struct("o_orderstatus", "o_orderpriority").alias("info"))
    fields = ["l_linenumber", "l_partkey", "l_returnflag", "mark"]
    nested = nest_many(orders, lines, [("o_orderkey", "l_orderkey")], fields, "lines")
    kept, _ = E.change_field_type(nested, "lines.mark", "date")
    kept, _ = E.change_field_type(kept, "lines.l_partkey", "string")
    return _flat(E.drop_field(kept, "lines.mark"))


@R.add(
    "e09_revalidate_fk",
    """SELECT 'fk_order' AS constraint_name, 'modify' AS action, count(*) FILTER (WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')) AS orphans FROM lineitem
    UNION ALL SELECT 'fk_customer', 'add', count(*) FILTER (WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)) FROM orders""",
)
def _(t):
    frames = {"lineitem": t("lineitem"), "orders": t("orders"), "customer": t("customer"), "kept": t("orders").filter("o_orderstatus <> 'P'")}
    changes = [
        ("modify", ForeignKey("fk_order", "lineitem", ("l_orderkey",), "kept", ("o_orderkey",))),
        ("add", ForeignKey("fk_customer", "orders", ("o_custkey",), "customer", ("c_custkey",))),
        ("add", ForeignKey("", "orders", ("o_custkey",), "customer", ("c_custkey",))),
        ("drop", ForeignKey("fk_old", "orders", ("o_orderkey",), "lineitem", ("l_orderkey",))),
    ]
    return E.revalidate_fk(frames, changes)


_PLAN = [
    Step("type", "c_acctbal", "decimal(18,2)"),
    Step("rename", "c_name", "name"),
    Step("drop", "c_mktsegment"),
    Step("add", "state", Column("state", "string", default="'v2'")),
    Step("add", "info.rank", 1),
    Step("drop", "c_nationkey", active=False),
]


def _customer_v1(t) -> DataFrame:
    return t("customer").withColumn("info", F.struct("c_nationkey"))


@R.add(
    "e10_evolve",
    "SELECT c_custkey, c_name AS name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, c_mktsegment, 'v2' AS state, 1 AS rank FROM customer",
)
def _(t):
    df, _, _ = E.evolve(_customer_v1(t), _PLAN)
    return df.withColumn("rank", F.col("info.rank")).drop("info")


@R.add(
    "e10_evolve_drops",
    "SELECT c_custkey, c_name AS name, c_nationkey, CAST(c_acctbal AS DECIMAL(18,2)) AS c_acctbal, 'v2' AS state, 1 AS rank FROM customer",
)
def _(t):
    df, _, _ = E.evolve(_customer_v1(t), _PLAN, allow_drops=True)
    return df.withColumn("rank", F.col("info.rank")).drop("info")


@R.add(
    "e11_field_drift",
    """WITH o AS (SELECT count(*) AS n FROM events), c AS (SELECT count(*) FILTER (WHERE event_type = 'click') AS c,
      count(*) FILTER (WHERE event_type <> 'click') AS r FROM events)
    SELECT 'k' AS field, 'type changed' AS change, 'number' AS old_kinds, 'number,string' AS new_kinds, n AS old_rows, n AS new_rows FROM o
    UNION ALL SELECT 'm', 'added', NULL, 'boolean', NULL, c FROM c
    UNION ALL SELECT 'gone', 'dropped', 'array', NULL, n, NULL FROM o""",
)
def _(t):
    value = F.get_json_object("props", "$.k")
    old = t("events").select(F.concat(F.lit('{"k":'), value, F.lit(',"gone":[1]}')).alias("props"))
    new = t("events").select(
        F.when(F.col("event_type") == "click", F.concat(F.lit('{"k":"'), value, F.lit('","m":true}')))
        .otherwise(F.concat(F.lit('{"k":'), value, F.lit("}")))
        .alias("props")
    )
    return E.field_drift(old, new, "props", depth=1)


@R.add(
    "m01_set_where",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'force' WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN 'no force' ELSE o_orderstatus END AS o_orderstatus,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '1-URGENT' THEN '' ELSE o_orderpriority END AS o_orderpriority FROM orders""",
)
def _(t):
    df = t("orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    df = M.set_where(df, {"o_orderstatus": "F"}, {"o_orderstatus": "force"})
    return M.set_where(
        df, {"o_orderstatus": "O", "o_orderpriority": "1-URGENT"}, {"o_orderstatus": "no force", "o_orderpriority": ""}
    )


def _record(t) -> DataFrame:
    """Customers as records: a block that only customers in credit have."""
    block = F.struct(F.col("c_custkey").alias("start"), F.col("c_nationkey").alias("step"), F.col("c_mktsegment").alias("generated"))
    return t("customer").select("c_custkey", F.when(F.col("c_acctbal") >= 0, block).alias("identity"))


@R.add(
    "m02_move_path",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS type, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS step,
    c_acctbal < 0 AS empty FROM customer""",
)
def _(t):
    df = M.move_path(_record(t), "identity", "generated_value.identity")
    df = M.move_path(df, "generated_value.identity.generated", "generated_value.type")
    return df.select(
        "c_custkey",
        F.col("generated_value.type").alias("type"),
        F.col("generated_value.identity.step").alias("step"),
        F.col("generated_value").isNull().alias("empty"),
    )


@R.add(
    "m03_rename_block",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS start_num, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS step_num FROM customer""",
)
def _(t):
    df = M.rename_block(_record(t), "identity", "autoincrement", {"start": "start_num", "step": "step_num"})
    return df.select("c_custkey", "autoincrement.start_num", "autoincrement.step_num")


@R.add(
    "m04_add_missing_id",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN sha256(to_json({'block': 'identity', 'c_custkey': c_custkey})) END AS id FROM customer""",
)
def _(t):
    df = M.add_missing_id(_record(t), "identity", "identity.id", ["c_custkey"])
    again = M.add_missing_id(df, "identity", "identity.id", ["c_custkey"])
    return again.select("c_custkey", "identity.id")


@R.add(
    "m05_add_fields",
    """SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN 'ALWAYS' END AS type, CASE WHEN c_acctbal >= 0 THEN 1 END AS cache FROM customer""",
)
def _(t):
    df = M.add_fields(_record(t), "identity", {"type": "ALWAYS", "cache": 1})
    return df.select("c_custkey", "identity.type", "identity.cache")


@R.add("m06_remove_fields", "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS start FROM customer")
def _(t):
    df = M.remove_fields(_record(t), "identity", ["generated", "step", "unknown"])
    return df.select("c_custkey", "identity.*")


@R.add(
    "m07_assign_if",
    """SELECT d.doc_id, coalesce(quality, -1) AS quality, CASE WHEN quality IS NULL THEN 'open' WHEN quality = 1 AND toxic = 0 THEN 'good' END AS state
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(t):
    df = t("documents").select("doc_id").join(t("labels"), "doc_id", "left")
    good = {"type": "and", "values": [{"key": "quality", "value": 1}, {"type": "not", "values": [{"key": "toxic", "value": 1}]}]}
    df = M.assign_if(df, good, {"state": "good"})
    missing = {"type": "not", "values": [{"key": "quality", "exist": True}]}
    df = M.assign_if(df, missing, {"quality": -1, "state": "open"})
    return df.select("doc_id", "quality", "state")


@R.add(
    "m08_flags_to_lists",
    """SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'quality,toxic' WHEN quality = 1 THEN 'quality' ELSE 'toxic' END AS flags
    FROM labels WHERE quality = 1 OR toxic = 1""",
)
def _(t):
    lists = M.flags_to_lists(t("labels"), ["doc_id"], ["quality", "toxic"])
    return lists.select("doc_id", F.array_join("flags", ",").alias("flags"))


@R.add(
    "m08_flags_to_key_lists",
    """WITH f AS (SELECT l_orderkey, 'large' AS flag, l_linenumber AS item FROM lineitem WHERE l_quantity > 25
    UNION ALL SELECT l_orderkey, 'returned', l_linenumber FROM lineitem WHERE l_returnflag = 'R')
    SELECT l_orderkey, flag, string_agg(CAST(item AS VARCHAR), ',' ORDER BY item) AS items FROM f GROUP BY l_orderkey, flag""",
)
def _(t):
    lines = t("lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_quantity") > 25).alias("large"), (F.col("l_returnflag") == "R").alias("returned")
    )
    lists = M.flags_to_lists(lines, ["l_orderkey"], ["large", "returned"], "items", "l_linenumber")
    return lists.select("l_orderkey", "flag", F.array_join("items", ",").alias("items"))


# Rules of this test only: a customer record goes from version 1.0 to 2.0.
_RULES = {
    "1.2": [M.Rule("add_fields", {"path": "identity", "values": {"unit": "row"}})],
    "1.10": [M.Rule("assign_if", {"tree": {"key": "identity.step", "exist": True}, "values": {"active": True}})],
    "2.0": [
        M.Rule("move_path", {"source": "identity.step", "target": "stride"}),
        M.Rule("remove_fields", {"path": "identity", "names": ["generated"]}),
    ],
}
_VERSIONS = "CASE WHEN c_custkey % 5 = 0 THEN '1.0' WHEN c_custkey % 5 = 1 THEN '1.2.0' WHEN c_custkey % 5 = 2 THEN '1.10' WHEN c_custkey % 5 = 3 THEN '3.0' ELSE 'draft' END"


def _migrated(t, target: str):
    """Records of versions below, at and above the rules, and some without a version."""
    return M.migrate(_record(t).withColumn("version", F.expr(_VERSIONS)), "version", target, _RULES)


@R.add(
    "m09_migrate",
    f"""WITH v AS (SELECT c_custkey, c_acctbal >= 0 AS there, c_nationkey, {_VERSIONS} AS old FROM customer)
    SELECT c_custkey, CASE WHEN old = '3.0' THEN '3.0' ELSE '2.0' END AS version, CASE WHEN there THEN c_custkey END AS start,
    CASE WHEN old = '1.0' AND there THEN 'row' END AS unit, CASE WHEN old IN ('1.0', '1.2.0') AND there THEN TRUE END AS active,
    CASE WHEN old <> '3.0' AND there THEN c_nationkey END AS stride
    FROM v WHERE old <> 'draft'""",
)
def _(t):
    done, _ = _migrated(t, "2.5")
    return done.select("c_custkey", "version", "identity.start", "identity.unit", "active", "stride")


@R.add(
    "m09_newer_records",
    f"""SELECT c_custkey, '3.0' AS version, CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS generated, CASE WHEN c_acctbal >= 0 THEN c_nationkey END AS step
    FROM customer WHERE {_VERSIONS} = '3.0'""",
)
def _(t):
    done, _ = _migrated(t, "2.0")
    return done.filter("version = '3.0'").select("c_custkey", "version", "identity.generated", "identity.step")


@R.add(
    "e08_rejects",
    "SELECT p_partkey, 'info.price: no int' AS reason FROM part WHERE CAST(p_retailprice AS DECIMAL(18,2)) <> floor(CAST(p_retailprice AS DECIMAL(18,2)))",
)
def _(t):
    info = F.struct(F.col("p_retailprice").cast("decimal(18,2)").alias("price"), F.col("p_size").alias("size"))
    _, rejects = E.change_field_type(t("part").select("p_partkey", info.alias("info")), "info.price", "int")
    return rejects.select("p_partkey", F.col("reasons")[0].alias("reason"))


@R.add(
    "e11_nested_drift",
    """WITH o AS (SELECT count(*) AS n FROM events)
    SELECT 'o' AS field, 'same' AS change, 'object' AS old_kinds, 'object' AS new_kinds, n AS old_rows, n AS new_rows FROM o
    UNION ALL SELECT 'o.a', 'type changed', 'number', 'string', n, n FROM o""",
)
def _(t):
    value = F.get_json_object("props", "$.k")
    old = t("events").select(F.concat(F.lit('{"o":{"a":'), value, F.lit("}}")).alias("props"))
    new = t("events").select(F.concat(F.lit('{"o":{"a":"'), value, F.lit('"}}')).alias("props"))
    return E.field_drift(old, new, "props")


_MADE = "WITH o AS (SELECT count(*) AS n FROM events)"


@R.add(
    "e11_lists",
    f"""{_MADE} SELECT '[]' AS field, 'same' AS change, 'object' AS old_kinds, 'object' AS new_kinds, n + n AS old_rows, n + n AS new_rows FROM o
    UNION ALL SELECT '[].b', 'type changed', 'number', 'number,string', n + n, n + n FROM o""",
)
def _(t):
    k = F.get_json_object("props", "$.k")
    text = F.when(F.col("event_type") == "click", F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k)
    old = t("events").select(F.concat(F.lit('[{"b":'), k, F.lit('},{"b":1}]')).alias("props"))
    new = t("events").select(F.concat(F.lit('[{"b":'), text, F.lit('},{"b":1}]')).alias("props"))
    return E.field_drift(old, new, "props")


@R.add(
    "e11_deep",
    f"""{_MADE} SELECT unnest(['a', 'a.b', 'a.b.c', 'a.b.c.d']) AS field, 'same' AS change, 'object' AS old_kinds, 'object' AS new_kinds, n AS old_rows, n AS new_rows FROM o
    UNION ALL SELECT 'a.b.c.d.e', 'type changed', 'number', 'array', n, n FROM o
    UNION ALL SELECT 'a.b.c.d.e[]', 'added', NULL, 'number', NULL, n FROM o""",
)
def _(t):
    k = F.get_json_object("props", "$.k")
    deep = lambda v: F.concat(F.lit('{"a":{"b":{"c":{"d":{"e":'), v, F.lit("}}}}}")).alias("props")
    return E.field_drift(t("events").select(deep(k)), t("events").select(deep(F.concat(F.lit("["), k, F.lit("]")))), "props")


@R.add("m09_rejects", f"SELECT c_custkey, 'version: no version' AS reason FROM customer WHERE {_VERSIONS} = 'draft'")
def _(t):
    _, rejects = _migrated(t, "2.0")
    return rejects.select("c_custkey", F.col("reasons")[0].alias("reason"))

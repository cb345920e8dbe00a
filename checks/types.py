"""Checks of declared types (T) and sequences (Q)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Registry, dec
from modelweave.model import Check, Column, Generated, Sequence, Table
from modelweave.operators import sequences as Q
from modelweave.operators import types as T
from modelweave.operators.joins import nest_many
from modelweave.operators.load import load_table

R = Registry()

_ORDERS = Table(
    "orders",
    (
        Column("o_orderkey", "bigint", nullable=False),
        Column("o_custkey", "int"),
        Column("o_totalprice", "decimal(12,1)", comment="one digit"),
        Column("o_orderpriority", "string", length=8, length_semantics="BYTE"),
    ),
)
_LOSSY = "CAST(CAST(o_totalprice AS DECIMAL(12,1)) AS DOUBLE) <> o_totalprice"
_LONG = "octet_length(encode(o_orderpriority)) > 8"


@R.add(
    "t01_conform",
    f"""SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, CAST(o_totalprice AS DECIMAL(12,1)) AS o_totalprice, o_orderpriority
    FROM orders WHERE NOT ({_LOSSY}) AND NOT ({_LONG})""",
)
def _(t):
    return T.conform(t("orders"), _ORDERS)[0]


@R.add(
    "t01_conform_rejects",
    f"""SELECT o_orderkey, concat_ws('; ', CASE WHEN {_LOSSY} THEN 'o_totalprice: changed by decimal(12,1)' END,
    CASE WHEN {_LONG} THEN 'o_orderpriority: longer than 8' END) AS reasons FROM orders WHERE {_LOSSY} OR {_LONG}""",
)
def _(t):
    rejects = T.conform(t("orders"), _ORDERS)[1]
    return rejects.select("o_orderkey", F.array_join("reasons", "; ").alias("reasons"))


@R.add(
    "t01_conform_text",
    """SELECT l_orderkey, l_linenumber, l_part FROM (SELECT l_orderkey, l_linenumber,
    CASE WHEN l_returnflag = 'R' THEN 'part ' || l_partkey ELSE CAST(l_partkey AS VARCHAR) END AS l_part FROM lineitem) WHERE l_part LIKE 'part%'""",
)
def _(t):
    text = F.when(F.col("l_returnflag") == "R", F.concat(F.lit("part "), "l_partkey")).otherwise(F.col("l_partkey").cast("string"))
    lines = t("lineitem").select("l_orderkey", "l_linenumber", text.alias("l_part"))
    table = Table("lineitem", (Column("l_orderkey", "bigint"), Column("l_linenumber", "int"), Column("l_part", "int")))
    return T.conform(lines, table)[1].drop("reasons")


_LOADED = Table(
    "orders",
    (
        Column("level", "string", generated=Generated(expression="CASE WHEN net > 200000 THEN 'high' ELSE lower(o_orderpriority) END")),
        Column("id", "bigint", generated=Generated(as_identity=True, start=100, increment=10)),
        Column("net", "decimal(14,2)", nullable=False, generated=Generated(expression="gross * 0.9")),
        Column("gross", "decimal(12,2)", rules={"minimum": 2000}),
        Column("o_orderkey", "bigint", nullable=False),
        Column("o_orderpriority", "string", default="'NONE'", default_on_null=True, length=8),
        Column("origin", "string", default="'import'"),
        Column("code", "string", generated=Generated(expression="concat('N', id)")),
    ),
    checks=(Check("net_high", "net < 400000"),),
)
_LOAD_SQL = """WITH s AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderpriority END AS prio, CAST(o_totalprice AS DECIMAL(12,2)) AS gross,
      CAST(90 + 10 * row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id FROM orders),
    l AS (SELECT *, CAST(gross * 0.9 AS DECIMAL(14,2)) AS net, coalesce(prio, 'NONE') AS p FROM s),
    j AS (SELECT *, concat_ws('; ', CASE WHEN length(p) > 8 THEN 'o_orderpriority: longer than 8' END, CASE WHEN gross < 2000 THEN 'orders.gross.minimum' END,
      CASE WHEN NOT net < 400000 THEN 'orders.net_high' END) AS why FROM l)"""


def _to_load(t):
    """Orders without their identity; NULL priorities where the order is in process."""
    prio = F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("o_orderpriority")
    return t("orders").select("o_orderkey", prio, F.col("o_totalprice").alias("gross"), "o_custkey")


@R.add(
    "t01_load_table",
    f"""{_LOAD_SQL} SELECT CASE WHEN net > 200000 THEN 'high' ELSE lower(p) END AS level, id, net, gross, o_orderkey, p AS o_orderpriority, 'import' AS origin,
    'N' || id AS code FROM j WHERE why = ''""",
)
def _(t):
    return load_table(_to_load(t), _LOADED, ["o_orderkey"], unique=True)[0]


@R.add("t01_load_table_rejects", f"{_LOAD_SQL} SELECT o_orderkey, why AS reasons FROM j WHERE why <> ''")
def _(t):
    rejects = load_table(_to_load(t), _LOADED, ["o_orderkey"], unique=True)[1]
    return rejects.select("o_orderkey", F.array_join("reasons", "; ").alias("reasons"))


@R.add(
    "t02_length_violations",
    """SELECT doc_id, 'BYTE' AS semantics FROM documents WHERE octet_length(encode(text)) > 4000
    UNION ALL SELECT doc_id, 'CHAR' FROM documents WHERE length(text) > 4000""",
)
def _(t):
    docs = t("documents").select("doc_id", "text")
    parts = [T.length_violations(docs, "text", 4000, s).select("doc_id", F.lit(s).alias("semantics")) for s in ("BYTE", "CHAR")]
    return parts[0].unionByName(parts[1])


@R.add(
    "t03_to_number",
    """SELECT o_orderkey, TRY_CAST(o_totalprice AS DECIMAL(12,2)) AS a,
    CASE WHEN o_totalprice >= 99999.5 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(5,0)) END AS b,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(38,1)) AS c,
    CAST(round(CAST(o_totalprice AS DECIMAL(12,2)) / 100) * 100 AS DECIMAL(8,0)) AS d, CAST(o_custkey AS DOUBLE) AS e FROM orders""",
)
def _(t):
    price = dec("o_totalprice", 12, 2)
    return t("orders").select(
        "o_orderkey",
        T.to_number("o_totalprice", 12, 2).alias("a"),
        T.to_number(price, 5, 0).alias("b"),
        T.to_number(price, "*", 1).alias("c"),
        T.to_number(price, 6, -2).alias("d"),
        T.to_float("o_custkey", 53).alias("e"),
    )


@R.add(
    "t04_to_timestamp_precision",
    """SELECT event_id, date_trunc('millisecond', ts) AS milli, date_trunc('second', ts) AS sec, ts AS micro, date_trunc('millisecond', ts) AS zoned FROM events""",
)
def _(t):
    return t("events").select(
        "event_id",
        T.to_timestamp_precision("ts", 3).alias("milli"),
        T.to_timestamp_precision("ts", 0).alias("sec"),
        T.to_timestamp_precision("ts", 9).alias("micro"),
        T.to_timestamp_precision("ts", 3, "local").cast("timestamp_ntz").alias("zoned"),
    )


@R.add(
    "t05_to_interval",
    """SELECT l_orderkey, l_linenumber, CAST(epoch(l_shipdate) - epoch(o_orderdate) AS DECIMAL(24,6)) AS delay, CAST(l_partkey AS INTEGER) AS months
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey""",
)
def _(t):
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    seconds = T.interval_number(F.col("l_shipdate") - F.col("o_orderdate"), "day")
    return joined.select(
        "l_orderkey",
        "l_linenumber",
        T.interval_number(T.to_interval(seconds, "day"), "day").alias("delay"),
        T.interval_number(T.to_interval("l_partkey", "year"), "year").alias("months"),
    )


@R.add(
    "t06_vector_violations",
    """SELECT 'dim 64' AS rule, count(*) FILTER (WHERE len(embedding) <> 64) AS n FROM embeddings
    UNION ALL SELECT 'dim 32', count(*) FILTER (WHERE len(embedding) <> 32) FROM embeddings
    UNION ALL SELECT 'int8', count(*) FILTER (WHERE len(list_filter(embedding, lambda x: x <> trunc(x))) > 0) FROM embeddings""",
)
def _(t):
    vectors = t("embeddings")
    rules = {"dim 64": (64, "FLOAT32"), "dim 32": (32, "*"), "int8": ("*", "INT8")}
    parts = [
        T.vector_violations(vectors, "embedding", dim, fmt).agg(F.count("*").alias("n")).select(F.lit(r).alias("rule"), "n")
        for r, (dim, fmt) in rules.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@R.add(
    "t07_json_kind_violations",
    "SELECT event_id, 'ARRAY' AS kind FROM events UNION ALL SELECT event_id, 'OBJECT' FROM events WHERE event_type = 'error'",
)
def _(t):
    broken = F.when(F.col("event_type") == "error", F.substring("props", F.lit(2), F.length("props"))).otherwise(F.col("props"))
    made = t("events").select("event_id", broken.alias("props"))
    parts = [T.json_kind_violations(made, "props", k).select("event_id", F.lit(k).alias("kind")) for k in ("ARRAY", "OBJECT")]
    return parts[0].unionByName(parts[1])


@R.add("t08_json_storage", "SELECT event_id, replace(props, ': ', ':') AS props FROM events")
def _(t):
    native = T.json_storage(t("events").select("event_id", "props"), "props", native=True)
    return T.json_storage(native, "props", native=False)


@R.add(
    "t09_encrypt_columns",
    "SELECT c_custkey, c_name, c_mktsegment, CAST((SELECT count(DISTINCT c_mktsegment) FROM customer) AS BIGINT) AS segments FROM customer",
)
def _(t):
    key = F.lit(bytes(range(16)))
    rows = t("customer").select("c_custkey", "c_name", "c_mktsegment")
    hidden = T.encrypt_columns(T.encrypt_columns(rows, ["c_name"], key, salted=True), ["c_mktsegment"], key, salted=False)
    distinct = hidden.select("c_mktsegment").distinct().agg(F.count("*")).scalar()
    shown = T.decrypt_columns(T.decrypt_columns(hidden, ["c_name"], key, salted=True), ["c_mktsegment"], key, salted=False)
    return shown.select("c_custkey", "c_name", "c_mktsegment", distinct.alias("segments"))


@R.add(
    "t10_to_udt",
    """SELECT l_orderkey AS o_orderkey, count(*) AS n, CAST(sum(l_partkey) AS BIGINT) AS parts FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders) GROUP BY l_orderkey HAVING count(*) > 4""",
)
def _(t):
    line = T.to_udt({"line": ("l_linenumber", "int"), "part": ("l_partkey", "bigint")})
    lines = t("lineitem").select("l_orderkey", line.alias("line"))
    lists = nest_many(t("orders").select("o_orderkey"), lines, [("o_orderkey", "l_orderkey")], ["line"], "lines", ["line"])
    bad = T.collection_violations(lists, "lines", 4, not_null=True)
    parts = F.aggregate("lines", F.lit(0).cast("bigint"), lambda a, x: a + x["line"]["part"])
    return bad.select("o_orderkey", F.size("lines").cast("bigint").alias("n"), parts.alias("parts"))


@R.add(
    "t11_map_codes",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'number' WHEN '2-HIGH' THEN 'nvarchar2' WHEN '3-MEDIUM' THEN 'char' ELSE 'nvarchar2' END AS type,
    CASE o_orderstatus WHEN 'F' THEN 'done' WHEN 'O' THEN 'open' ELSE o_orderstatus END AS status FROM orders""",
)
def _(t):
    foreign = (
        F.when(F.col("o_orderpriority") == "1-URGENT", " BigInt ")
        .when(F.col("o_orderpriority") == "2-HIGH", "NChar Varying")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "uuid")
        .otherwise("geometry")
    )
    orders = t("orders").withColumn("foreign_type", foreign)
    names = {name: canonical[0] for name, canonical in T.CANONICAL_TYPES.items()}
    typed = T.map_codes(orders, "foreign_type", names, T.DEFAULT_TYPES["default"], "type")
    codes = typed.sparkSession.sql("SELECT * FROM VALUES ('f', 'done'), ('O ', 'open') AS codes(code, value)")
    return T.map_codes(typed, "o_orderstatus", codes, F.col("o_orderstatus"), "status").select("o_orderkey", "type", "status")


@R.add(
    "q01_assign_identity",
    "SELECT c_custkey, CAST(100 + 10 * (row_number() OVER (ORDER BY c_mktsegment, c_name) - 1) AS BIGINT) AS id FROM customer",
)
def _(t):
    rows = t("customer").select("c_custkey", "c_mktsegment", "c_name")
    made = Q.assign_identity(rows, "id", ["c_mktsegment", "c_name"], Generated(as_identity=True, start=100, increment=10))
    return made.select("c_custkey", "id")


@R.add(
    "q01_assign_identity_on_null",
    """SELECT doc_id, CAST(quality AS BIGINT) AS quality FROM labels
    UNION ALL SELECT doc_id, 1000 + row_number() OVER (ORDER BY doc_id) - 1 FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""",
)
def _(t):
    rows = t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return Q.assign_identity(rows, "quality", ["doc_id"], Generated("BY DEFAULT", as_identity=True, on_null=True, start=1000))


@R.add(
    "q02_sequence_values",
    "SELECT o_orderkey, CAST(-1 - 5 * (row_number() OVER (ORDER BY o_orderpriority, o_orderkey) - 1) AS BIGINT) AS id FROM orders",
)
def _(t):
    rows = t("orders").select("o_orderkey", "o_orderpriority")
    return Q.sequence_values(rows, ["o_orderpriority", "o_orderkey"], Sequence(increment=-5), unique=True).select("o_orderkey", "id")


@R.add(
    "q02_sequence_values_ties",
    """SELECT id, l_returnflag FROM (SELECT CAST(row_number() OVER (ORDER BY l_returnflag) AS BIGINT) AS id, l_returnflag FROM lineitem)""",
)
def _(t):
    # one of three flags orders all lines: ties spread over the partitions
    return Q.sequence_values(t("lineitem").select("l_returnflag"), ["l_returnflag"], Sequence())


@R.add(
    "q03_sequence_cycle",
    """SELECT event_id, CAST(CASE WHEN i < 5 THEN 3 + i ELSE 1 + (i - 5) % 7 END AS BIGINT) AS id
    FROM (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS i FROM events)""",
)
def _(t):
    spec = Sequence(start=3, increment=1, min_value=1, max_value=7, cycle=True)
    return Q.sequence_values(t("events").select("event_id"), ["event_id"], spec, unique=True)


@R.add(
    "q04_continue_sequence",
    """WITH a AS (SELECT o_orderkey, 10 + 2 * (row_number() OVER (ORDER BY o_orderkey) - 1) AS id FROM orders WHERE o_orderstatus <> 'P')
    SELECT o_orderkey, CAST((SELECT max(id) FROM a) + 2 * row_number() OVER (ORDER BY o_orderkey) AS BIGINT) AS id FROM orders WHERE o_orderstatus = 'P'""",
)
def _(t):
    spec = Sequence(start=10, increment=2)
    orders = t("orders").select("o_orderkey", "o_orderstatus")
    stored = Q.sequence_values(orders.filter("o_orderstatus <> 'P'"), ["o_orderkey"], spec, unique=True)
    batch = orders.filter("o_orderstatus = 'P'")
    return Q.continue_sequence(batch, ["o_orderkey"], stored, "id", spec, unique=True).select("o_orderkey", "id")


@R.add(
    "q05_scaled_ids",
    "SELECT count(*) AS n, count(*) AS ids, 16 AS shortest, 16 AS longest FROM lineitem",
)
def _(t):
    ids = Q.scaled_ids(t("lineitem").select("l_orderkey", "l_linenumber"), 10, extend=True)
    return ids.agg(
        F.count("*").alias("n"),
        F.count_distinct("id").alias("ids"),
        F.min(F.length(F.col("id").cast("string"))).alias("shortest"),
        F.max(F.length(F.col("id").cast("string"))).alias("longest"),
    )

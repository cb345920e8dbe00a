"""Checks of the documents (D) and of nesting to any depth."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.common import Registry, dec
from modelweave.model import DocField, DocNode, Tags
from modelweave.operators import documents as D
from modelweave.operators.writeback import write_documents
from modelweave.plans.workspace import new_folder, store
from modelweave.sources.live import LiveTables, create_tables
from modelweave.sources.tables import read_table

R = Registry()

_ALL = Tags(insert=True, update=True, delete=True, check="CHECK", etag=True)


def _fields(text: str) -> tuple[DocField, ...]:
    """``column`` or ``column:key``, separated by blanks."""
    pairs = [part.partition(":") for part in text.split()]
    return tuple(DocField(column, key=key) for column, _, key in pairs)


def order_node(where: str = "", tags: Tags = _ALL, line_tags: Tags = _ALL) -> DocNode:
    """An order with its customer as an object and its lines as a list."""
    return DocNode(
        table="orders",
        where=where,
        key=("o_orderkey",),
        fields=_fields("o_orderkey:_id o_orderstatus:status o_custkey"),
        tags=tags,
        children=(
            DocNode(
                "customer",
                _fields("c_custkey:id c_name:name c_mktsegment:segment"),
                "customer",
                "object",
                (("o_custkey", "c_custkey"),),
                key=("c_custkey",),
                tags=_ALL,
            ),
            DocNode(
                "lineitem",
                _fields("l_linenumber:line l_partkey:part l_suppkey:supplier l_quantity:quantity l_price:price"),
                "lines",
                "array",
                (("o_orderkey", "l_orderkey"),),
                order=("l_linenumber",),
                key=("l_orderkey", "l_linenumber"),
                tags=line_tags,
            ),
        ),
    )


def _lines(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        dec("l_quantity").alias("l_quantity"),
        dec("l_extendedprice").alias("l_price"),
    )


def _order_tables(t) -> dict[str, DataFrame]:
    return {"orders": t("orders"), "customer": t("customer"), "lineitem": _lines(t("lineitem"))}


def order_documents(spark: SparkSession, folder: str, as_json: bool = False) -> DataFrame:
    tables = _order_tables(lambda name: read_table(spark, folder, name))
    return D.build_documents(order_node("o_totalprice >= 100000"), tables, as_json)


@R.add(
    "d01_build_documents",
    """SELECT o_orderkey AS id, o_orderstatus AS status, c_name AS customer, count(l_orderkey) AS n,
    CAST(coalesce(sum(CAST(l_extendedprice AS DECIMAL(18,2))), 0) AS DECIMAL(28,2)) AS price,
    coalesce(string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey), '') AS lines
    FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey
    WHERE o_totalprice >= 100000 GROUP BY o_orderkey, o_orderstatus, c_name""",
)
def _(t):
    docs = D.build_documents(order_node("o_totalprice >= 100000"), _order_tables(t))
    price = F.aggregate("lines", F.lit(0).cast("decimal(28,2)"), lambda a, x: (a + x["price"]).cast("decimal(28,2)"))
    texts = F.transform("lines", lambda x: F.concat_ws(":", x["line"], x["part"]))
    return docs.select(
        F.col("_id").alias("id"),
        "status",
        F.col("customer.name").alias("customer"),
        F.size("lines").cast("bigint").alias("n"),
        price.alias("price"),
        F.array_join(texts, ",").alias("lines"),
    )


@R.add(
    "d01_build_documents_json",
    """SELECT c_custkey AS id, to_json({'id': c_custkey, 'name': c_name, 'nation': {'n_name': n_name, 'n_regionkey': n_regionkey},
      'orders': coalesce(orders, [])}) AS doc, CAST(0 AS BIGINT) AS _page
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT o_custkey, list({'key': o_orderkey, 'status': o_orderstatus} ORDER BY o_orderkey) AS orders
      FROM orders GROUP BY o_custkey) o ON o_custkey = c_custkey""",
)
def _(t):
    root = DocNode(
        "customer",
        _fields("c_custkey:id c_name:name"),
        key=("c_custkey",),
        children=(
            DocNode("nation", _fields("n_name n_regionkey"), "nation", "object", (("c_nationkey", "n_nationkey"),)),
            DocNode(
                "orders", _fields("o_orderkey:key o_orderstatus:status"), "orders", "array", (("c_custkey", "o_custkey"),), order=("o_orderkey",)
            ),
        ),
    )
    return D.build_documents(root, {n: t(n) for n in ("customer", "nation", "orders")}, as_json=True)


@R.add(
    "j08_nest",
    """SELECT r_name, count(DISTINCT n_nationkey) AS nations, count(DISTINCT c_custkey) AS customers, count(o_orderkey) AS orders,
    CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM region LEFT JOIN nation ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey
    LEFT JOIN orders ON o_custkey = c_custkey GROUP BY r_name""",
)
def _(t):
    root = DocNode(
        "region",
        _fields("r_regionkey r_name"),
        key=("r_regionkey",),
        children=(
            DocNode(
                "nation",
                _fields("n_nationkey n_name"),
                "nations",
                "array",
                (("r_regionkey", "n_regionkey"),),
                order=("n_nationkey",),
                children=(
                    DocNode(
                        "customer",
                        _fields("c_custkey c_name"),
                        "customers",
                        "array",
                        (("n_nationkey", "c_nationkey"),),
                        order=("c_custkey",),
                        children=(
                            DocNode(
                                "orders", _fields("o_orderkey price"), "orders", "array", (("c_custkey", "o_custkey"),), order=("o_orderkey",)
                            ),
                        ),
                    ),
                ),
            ),
        ),
    )
    tables = {n: t(n) for n in ("region", "nation", "customer")}
    tables["orders"] = t("orders").withColumn("price", dec("o_totalprice"))
    docs = D.nest(root, tables)
    # entries that go on from an earlier page carry a page above 0 and are not counted again
    nations = docs.select("r_name", F.explode("nations").alias("n"))
    customers = nations.select("r_name", F.explode("n.customers").alias("c"))
    orders = customers.select("r_name", F.explode("c.orders").alias("o"))
    a = nations.filter("n._page = 0").groupBy("r_name").agg(F.count("*").alias("nations"))
    b = customers.filter("c._page = 0").groupBy("r_name").agg(F.count("*").alias("customers"))
    c = orders.groupBy("r_name").agg(F.count("*").alias("orders"), F.sum("o.price").cast("decimal(28,2)").alias("total"))
    return a.join(b, "r_name").join(c, "r_name")


@R.add(
    "d02_flex_merge",
    """SELECT event_id, string_agg(k || '=' || v, ',' ORDER BY k) AS doc FROM (
      SELECT event_id, 'event_type' AS k, event_type AS v FROM events
      UNION ALL SELECT event_id, 'user_id', CAST(user_id AS VARCHAR) FROM events
      UNION ALL SELECT event_id, k, json_extract_string(props, '$.' || k) FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)
        WHERE k NOT IN ('event_type', 'user_id')) GROUP BY event_id""",
)
def _(t):
    merged = D.flex_merge(t("events"), ["event_type", "user_id"], "props")
    pairs = F.transform(F.array_sort(F.map_keys("doc")), lambda k: F.concat(k, F.lit("="), F.try_element_at("doc", k)))
    return merged.select("event_id", F.array_join(pairs, ",").alias("doc"))


@R.add(
    "d02_flex_documents",
    """SELECT event_id AS id, '{"id":' || event_id || ',"event_type":"' || event_type || '",' || replace(substring(props, 2), ': ', ':') AS doc FROM events""",
)
def _(t):
    fields = (DocField("event_id", key="id"), DocField("event_type"), DocField("props", flex=True))
    return D.build_documents(DocNode("events", fields, key=("event_id",)), {"events": t("events")}, as_json=True)


def _events_node() -> DocNode:
    """A customer with the events of that user; what an event holds beside its columns stands in it."""
    events = (DocField("event_id", key="id"), DocField("event_type", key="type"), DocField("props", flex=True))
    below = DocNode("events", events, "events", "array", (("c_custkey", "user_id"),), order=("event_id",), key=("event_id",))
    return DocNode("customer", _fields("c_custkey:id c_name:name"), key=("c_custkey",), children=(below,))


@R.add(
    "d02_flex_nested",
    """SELECT c_custkey AS id, '{"id":' || c_custkey || ',"name":"' || c_name || '","events":[' || coalesce(string_agg('{"id":' || event_id || ',"type":"' || event_type || '",'
      || replace(substring(props, 2), ': ', ':'), ',' ORDER BY event_id), '') || ']}' AS doc, CAST(0 AS BIGINT) AS _page
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY c_custkey, c_name""",
)
def _(t):
    return D.build_documents(_events_node(), {"customer": t("customer"), "events": t("events")}, as_json=True)


@R.add(
    "d02_flex_back",
    """SELECT event_id, event_type, replace(props, ': ', ':') AS props, user_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
)
def _(t):
    tables = {"customer": t("customer"), "events": t("events")}
    docs = D.build_documents(_events_node(), tables, as_json=True)
    return D.shred(D.parse_documents(docs, _events_node(), tables), _events_node())[0]["events"]


@R.add(
    "d03_etag",
    """SELECT c_custkey AS id, sha256(to_json({'id': CAST(c_custkey AS VARCHAR), 'c_name': c_name, 'nation': {'n_name': n_name}})) AS _etag
    FROM customer JOIN nation ON n_nationkey = c_nationkey""",
)
def _(t):
    root = _tagged_customer()
    return D.etag(D.build_documents(root, {n: t(n) for n in ("customer", "nation")}), root).select("id", "_etag")


def _tagged_customer() -> DocNode:
    return DocNode(
        "customer",
        (DocField("c_custkey", key="id"), DocField("c_name"), DocField("c_mktsegment", key="segment", tags=Tags(check="NOCHECK", etag=True))),
        key=("c_custkey",),
        tags=Tags(check="CHECK", etag=True),
        children=(
            DocNode(
                "nation",
                (DocField("n_name"), DocField("n_regionkey", tags=Tags(check="NOCHECK"))),
                "nation",
                "object",
                (("c_nationkey", "n_nationkey"),),
            ),
        ),
    )


def _one_line_per_key(t) -> DataFrame:
    """Lines with the key made unique: the smallest of the lines that share one."""
    lines = _lines(t("lineitem"))
    rest = [c for c in lines.columns if c not in ("l_orderkey", "l_linenumber")]
    small = lines.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct(*rest)).alias("m"))
    return store(small.select("l_orderkey", "l_linenumber", "m.*"), "lines")


_ONE_LINE = """lines AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_price FROM (
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
      CAST(l_extendedprice AS DECIMAL(18,2)) AS l_price,
      row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)), CAST(l_extendedprice AS DECIMAL(18,2))) AS rn
    FROM lineitem) WHERE rn = 1)"""


def _sums(tables: dict[str, DataFrame]) -> DataFrame:
    exprs = {
        "orders": [F.sum("o_orderkey"), F.sum(F.length("o_orderstatus"))],
        "customer": [F.sum("c_custkey"), F.sum(F.length("c_name"))],
        "lineitem": [F.sum("l_orderkey"), F.sum(F.col("l_quantity").cast("bigint") + F.col("l_partkey"))],
    }
    lines = [
        tables[n].agg(F.count("*").alias("n"), a.cast("bigint").alias("keys"), b.cast("bigint").alias("amount")).select(
            F.lit(n).alias("table_name"), "n", "keys", "amount"
        )
        for n, (a, b) in exprs.items()
    ]
    return reduce(DataFrame.unionByName, lines)


@R.add(
    "d04_shred",
    """SELECT 'orders' AS table_name, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys, CAST(sum(length(o_orderstatus)) AS BIGINT) AS amount FROM orders
    UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT), CAST(sum(length(c_name)) AS BIGINT)
      FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)
    UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT), CAST(sum(CAST(l_quantity AS BIGINT) + l_partkey) AS BIGINT)
      FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders)""",
)
def _(t):
    docs = D.build_documents(order_node(), _order_tables(t))
    rows, _ = D.shred(docs, order_node())
    return _sums(rows)


@R.add(
    "d04_shred_lines",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DECIMAL(18,2)) AS l_quantity,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS l_price FROM lineitem""",
)
def _(t):
    docs = D.build_documents(order_node(), _order_tables(t))
    return D.shred(docs, order_node())[0]["lineitem"]


def _edited(docs: DataFrame) -> DataFrame:
    """Orders in process are edited: other status, line 1 dropped, the rest doubled, a line 99 added."""
    chosen = docs.filter("status = 'P'")
    kept = F.filter("lines", lambda x: x["line"] > 1)
    doubled = F.transform(kept, lambda x: x.withField("quantity", (x["quantity"] * 2).cast("decimal(18,2)")))
    fresh = F.struct(
        F.lit(99).alias("line"),
        F.lit(1).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("supplier"),
        F.lit(1).cast("decimal(18,2)").alias("quantity"),
        F.lit(1).cast("decimal(18,2)").alias("price"),
    )
    return chosen.withColumn("status", F.lit("F")).withColumn("lines", F.concat(doubled, F.array(fresh)))


def _applied(t, line_tags: Tags, tags: Tags = _ALL) -> tuple[dict[str, DataFrame], DataFrame]:
    tables = {"orders": t("orders"), "customer": t("customer"), "lineitem": _one_line_per_key(t)}
    root = order_node(tags=tags, line_tags=line_tags)
    docs = _edited(D.build_documents(root, tables))
    return D.apply_documents(tables, docs, root)


@R.add(
    "d05_apply_documents",
    f"""WITH {_ONE_LINE}, p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey IN (FROM p) THEN CAST(l_quantity * 2 AS DECIMAL(18,2)) ELSE l_quantity END AS l_quantity
      FROM lines WHERE NOT (l_orderkey IN (FROM p) AND l_linenumber = 1)
    UNION ALL SELECT o_orderkey, 99, 1, CAST(1 AS DECIMAL(18,2)) FROM p""",
)
def _(t):
    after, _ = _applied(t, _ALL)
    return after["lineitem"].select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@R.add(
    "d05_apply_documents_rights",
    f"""WITH {_ONE_LINE}, p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'), hit AS (SELECT * FROM lines WHERE l_orderkey IN (FROM p))
    SELECT 'lineitem' AS table_name, 'removed' AS action, count(*) AS n FROM hit WHERE l_linenumber = 1
    UNION ALL SELECT 'lineitem', 'modified', count(*) FROM hit WHERE l_linenumber > 1
    UNION ALL SELECT 'orders', 'modified', count(*) FROM p
    UNION ALL SELECT 'after', 'lines', (SELECT count(*) FROM lines) + (SELECT count(*) FROM p)""",
)
def _(t):
    after, rejects = _applied(t, Tags(insert=True), Tags(insert=True, delete=True))
    lines = after["lineitem"].agg(F.count("*").alias("n")).select(F.lit("after").alias("table_name"), F.lit("lines").alias("action"), "n")
    return rejects.groupBy("table_name", "action").agg(F.count("*").alias("n")).unionByName(lines)


def _written(t) -> tuple[LiveTables, DataFrame]:
    """Orders in process are read with their tags; somebody else closes every tenth of them; then the edits come back."""
    tables = {"orders": t("orders"), "customer": t("customer"), "lineitem": _one_line_per_key(t)}
    keys = {"orders": ["o_orderkey"], "customer": ["c_custkey"], "lineitem": ["l_orderkey", "l_linenumber"]}
    spark = tables["orders"].sparkSession
    live = create_tables(spark, new_folder(spark, "live"), tables, keys, unique=True)
    root = order_node()
    docs = D.build_documents(root, {n: live.read(n) for n in tables}).filter("status = 'P'")
    read = store(D.etag(docs, root), "read")
    other = read.filter("_id % 10 = 0").withColumn("status", F.lit("O"))
    live, _ = write_documents(live, other, root, tag="_etag")
    return write_documents(live, _edited(read), root, tag="_etag")


@R.add(
    "d05_write_documents",
    f"""WITH {_ONE_LINE}, p AS (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 10 <> 0)
    SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey IN (FROM p) THEN CAST(l_quantity * 2 AS DECIMAL(18,2)) ELSE l_quantity END AS l_quantity
      FROM lines WHERE NOT (l_orderkey IN (FROM p) AND l_linenumber = 1)
    UNION ALL SELECT o_orderkey, 99, 1, CAST(1 AS DECIMAL(18,2)) FROM p
    UNION ALL SELECT o_orderkey, -1, length(CASE WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 10 = 0 THEN 'OO' ELSE 'FFF' END ELSE 'x' END), CAST(0 AS DECIMAL(18,2)) FROM orders""",
)
def _(t):
    live, _ = _written(t)
    lines = live.read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    before = t("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("was"))
    orders = live.read("orders").join(before, F.col("o_orderkey") == F.col("k"))
    mark = F.when(F.col("was") != "P", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3).cast("bigint")
    return lines.unionByName(orders.select(F.col("o_orderkey").alias("l_orderkey"), F.lit(-1).alias("l_linenumber"), mark.alias("l_partkey"), F.lit(0).cast("decimal(18,2)").alias("l_quantity")))


@R.add(
    "d05_stale_rejected",
    """SELECT 'orders' AS table_name, to_json({'o_orderkey': CAST(o_orderkey AS VARCHAR)}) AS row_key, 'stale' AS action
    FROM orders WHERE o_orderstatus = 'P' AND o_orderkey % 10 = 0""",
)
def _(t):
    return _written(t)[1]


@R.add(
    "d06_etag_conflicts",
    """SELECT c_custkey AS id, sha256(to_json({'id': CAST(c_custkey AS VARCHAR), 'c_name': c_name || '!', 'nation': {'n_name': n_name}})) AS stored_etag
    FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE c_acctbal < 0""",
)
def _(t):
    root = _tagged_customer()
    read = D.etag(D.build_documents(root, {n: t(n) for n in ("customer", "nation")}), root)
    # somebody else renames the customers in debt before the documents come back
    changed = t("customer").withColumn(
        "c_name", F.when(F.col("c_acctbal") < 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    )
    changed = changed.withColumn("c_mktsegment", F.lower("c_mktsegment"))
    stored = D.build_documents(root, {"customer": changed, "nation": t("nation")})
    return D.etag_conflicts(stored, read, root, ["id"]).select("id", "stored_etag")


@R.add(
    "d06_deleted",
    """SELECT c_custkey AS id, CAST(NULL AS VARCHAR) AS stored_etag FROM customer WHERE c_acctbal < 0""",
)
def _(t):
    # customers in debt are deleted before the documents come back
    root = _tagged_customer()
    read = D.etag(D.build_documents(root, {n: t(n) for n in ("customer", "nation")}), root)
    stored = D.build_documents(root, {"customer": t("customer").filter("c_acctbal >= 0"), "nation": t("nation")})
    return D.etag_conflicts(stored, read, root, ["id"]).select("id", "stored_etag")


@R.add("d07_rename_fields", "SELECT p_partkey, p_name AS label, p_retailprice AS price FROM part")
def _(t):
    named = t("part").select("p_partkey", D.rename_fields({"p_name": "label", "p_retailprice": "price"}).alias("doc"))
    return named.select("p_partkey", "doc.*")

"""Checks of aggregates and constraint checks (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Registry
from modelweave.operators import aggregates as A
from modelweave.plans.star import STAR

R = Registry()


@R.add(
    "a01_count_by",
    "SELECT o_orderkey, (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS n FROM orders",
)
def _(t):
    return A.count_by(t("orders").select("o_orderkey"), t("lineitem"), [("o_orderkey", "l_orderkey")])


@R.add(
    "a02_to_json_array",
    """SELECT c_nationkey, to_json(list({'c_custkey': c_custkey, 'c_mktsegment': c_mktsegment} ORDER BY c_custkey)) AS customers, CAST(0 AS BIGINT) AS page
    FROM customer GROUP BY c_nationkey""",
)
def _(t):
    return A.to_json_array(t("customer"), ["c_nationkey"], ["c_custkey", "c_mktsegment"], "customers")


@R.add(
    "a03_to_json_object",
    """SELECT d.doc_id, to_json({'id': d.doc_id, 'lang': lang, 'quality': quality}) AS json
    FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
)
def _(t):
    joined = t("documents").join(t("labels"), "doc_id", "left")
    return A.to_json_object(joined, {"id": "doc_id", "lang": "lang", "quality": "quality"}).select("doc_id", "json")


@R.add(
    "a04_collect_by_key",
    """SELECT o_orderkey, coalesce(string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber), '') AS lines,
    count(l_linenumber) = 0 AS is_empty FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def _(t):
    pairs = t("orders").join(t("lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
    lists = A.collect_by_key(pairs.select("o_orderkey", "l_linenumber"), ["o_orderkey"], "l_linenumber", "lines")
    return lists.select("o_orderkey", F.array_join("lines", ",").alias("lines"), "is_empty")


@R.add(
    "a05_first_non_empty",
    "SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE trim(text) <> '' GROUP BY conv_id",
)
def _(t):
    return A.first_non_empty(t("conversations"), ["conv_id"], "text", ["turn"])


@R.add(
    "a06_json_column_profile",
    """WITH v AS (SELECT event_id, 'props' AS column_name, props AS v FROM events UNION ALL SELECT event_id, 'event_type', event_type FROM events)
    SELECT column_name, 'json' || arg_min(CASE json_type(v) WHEN 'OBJECT' THEN 'Object' WHEN 'ARRAY' THEN 'Array' ELSE 'Other' END, event_id) AS kind
    FROM v WHERE json_valid(v) GROUP BY column_name""",
)
def _(t):
    return A.json_column_profile(t("events"), ["event_type", "props", "value"], ["event_id"])


@R.add(
    "a06_all",
    """WITH d AS (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type AS e FROM events)
    SELECT 'doc' AS column_name, p AS path, 'json' || kind AS kind, count(*) AS n FROM (
      SELECT unnest(['', 'a', 'a.b', 'a.b.c', 'list']) AS p, unnest(['Object', 'Object', 'Object', CASE WHEN e = 'click' THEN 'String' ELSE 'Number' END, 'Array']) AS kind FROM d
      UNION ALL SELECT 'list[]', CASE WHEN e = 'view' THEN 'Null' ELSE 'Number' END FROM d
      UNION ALL SELECT 'list[]', 'Object' FROM d UNION ALL SELECT 'list[].k', 'Boolean' FROM d) GROUP BY p, kind""",
)
def _(t):
    k = F.get_json_object("props", "$.k")
    deep = F.when(F.col("event_type") == "click", F.concat(F.lit('"'), k, F.lit('"'))).otherwise(k)
    first = F.when(F.col("event_type") == "view", F.lit("null")).otherwise(k)
    doc = F.concat(F.lit('{"a":{"b":{"c":'), deep, F.lit('}},"list":['), first, F.lit(',{"k":true}]}'))
    made = t("events").select(doc.alias("doc"), F.lit("{bad").alias("bad"), "value")
    return A.json_column_profile(made, ["doc", "bad", "value"], mode="all")


@R.add(
    "a07_json_schema",
    """WITH k AS (SELECT DISTINCT unnest(json_keys(props)) AS k, props FROM events),
    f AS (SELECT DISTINCT k, CASE json_type(props, '$.' || k) WHEN 'UBIGINT' THEN 'BIGINT' WHEN 'BIGINT' THEN 'BIGINT' ELSE 'STRING' END AS ty FROM k)
    SELECT (SELECT 'OBJECT<' || string_agg(k || ': ' || ty, ', ' ORDER BY k) || '>' FROM f) AS json_schema,
    count(*) FILTER (WHERE json_valid(v)) AS documents, count(*) FILTER (WHERE NOT json_valid(v)) AS bad_documents
    FROM (SELECT CASE WHEN event_type = 'error' THEN '{bad' ELSE props END AS v FROM events)""",
)
def _(t):
    made = t("events").select(F.when(F.col("event_type") == "error", "{bad").otherwise(F.col("props")).alias("props"))
    return A.json_schema(made, "props")


@R.add(
    "a08_key_violations",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1",
)
def _(t):
    return A.key_violations(t("lineitem"), ["l_orderkey", "l_linenumber"])


@R.add(
    "a08_key_violations_primary",
    """SELECT l.doc_id AS label_id, toxic, count(*) AS n FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id
    GROUP BY l.doc_id, toxic HAVING count(*) > 1 OR l.doc_id IS NULL""",
)
def _(t):
    labels = t("labels").select(F.col("doc_id").alias("label_id"), "toxic")
    joined = t("documents").join(labels, F.col("doc_id") == F.col("label_id"), "left")
    return A.key_violations(joined.select("label_id", "toxic"), ["label_id", "toxic"], primary=True)


@R.add(
    "a09_null_violations",
    """WITH j AS (SELECT lang, quality, toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)
    SELECT 'lang' AS column_name, count(*) FILTER (WHERE lang IS NULL) AS n FROM j
    UNION ALL SELECT 'quality', count(*) FILTER (WHERE quality IS NULL) FROM j
    UNION ALL SELECT 'toxic', count(*) FILTER (WHERE toxic IS NULL) FROM j""",
)
def _(t):
    joined = t("documents").select("doc_id", "lang").join(t("labels"), "doc_id", "left")
    return A.null_violations(joined, ["lang", "quality", "toxic"])


def _key_sql(table: str, columns: tuple[str, ...]) -> str:
    cols = ", ".join(columns)
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    return (
        f"SELECT '{table}.pk', 'PRIMARY KEY', 'VALIDATE', CAST(coalesce(sum(n), 0) AS BIGINT) FROM "
        f"(SELECT {cols}, count(*) AS n FROM {table} GROUP BY {cols} HAVING count(*) > 1 OR {nulls})"
    )


def _row_rules() -> list[tuple[str, str, str, str]]:
    """(table, constraint, kind, failing condition in SQL) of the model's row rules."""
    rules = []
    for table in STAR.tables:
        for c in table.columns:
            if not c.nullable:
                rules.append((table.name, f"{table.name}.{c.name}.not_null", "NOT NULL", f"{c.name} IS NULL"))
        for c in table.columns:
            for rule, value in c.rules.items():
                test = {
                    "minimum": f"{c.name} < {value}",
                    "maximum": f"{c.name} > {value}",
                    "enum": f"{c.name} NOT IN ({', '.join(repr(v) for v in value)})" if rule == "enum" else "",
                }[rule]
                rules.append((table.name, f"{table.name}.{c.name}.{rule}", "DOMAIN", test))
        for check in table.checks:
            if check.validate:
                rules.append((table.name, f"{table.name}.{check.name}", "CHECK", f"NOT ({check.expression})"))
    return rules


def _report_sql() -> str:
    parts = [
        f"SELECT '{name}' AS constraint_name, '{kind}' AS kind, 'VALIDATE' AS state, count(*) AS violations FROM {table} WHERE {test}"
        for table, name, kind, test in _row_rules()
    ]
    parts += [_key_sql(t.name, k.columns) for t in STAR.tables for k in t.keys]
    parts += [
        f"SELECT '{fk.child}.{fk.name}', 'FOREIGN KEY', 'VALIDATE', count(*) FROM {fk.child} WHERE NOT EXISTS "
        f"(SELECT 1 FROM {fk.parent} WHERE {fk.parent_columns[0]} = {fk.columns[0]})"
        for fk in STAR.foreign_keys
    ]
    parts.append("SELECT 'orders.later', 'CHECK', 'NOVALIDATE', NULL")
    return " UNION ALL ".join(parts)


def _frames(t):
    return {table.name: t(table.name) for table in STAR.tables}


@R.add("a10_constraint_report", _report_sql())
def _(t):
    return A.constraint_report(_frames(t), STAR)


_KEYS = {table.name: list(table.keys[0].columns) for table in STAR.tables}


def _exceptions_sql() -> str:
    def row(table: str) -> str:
        return "to_json({" + ", ".join(f"'{c}': {c}" for c in _KEYS[table]) + "}) AS \"row\""

    parts = [
        f"SELECT '{table}' AS table_name, '{name}' AS constraint_name, {row(table)} FROM {table} WHERE {test}"
        for table, name, _, test in _row_rules()
    ]
    for table, keys in _KEYS.items():
        cols = ", ".join(keys)
        parts.append(
            f"SELECT '{table}', '{table}.pk', {row(table)} FROM {table} WHERE ({cols}) IN "
            f"(SELECT ({cols}) FROM {table} GROUP BY {cols} HAVING count(*) > 1)"
        )
    return " UNION ALL ".join(parts)


@R.add("a11_exceptions_table", _exceptions_sql())
def _(t):
    return A.exceptions_table(_frames(t), STAR, _KEYS)


@R.add(
    "a12_expression_key_violations",
    "SELECT md5(text) AS key_value, count(*) AS n FROM documents GROUP BY md5(text) HAVING count(*) > 1",
)
def _(t):
    return A.expression_key_violations(t("documents"), "md5(text)")


@R.add(
    "a13_inverted_index",
    """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS value FROM documents)
    SELECT value, string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids, CAST(0 AS BIGINT) AS page FROM w GROUP BY value""",
)
def _(t):
    words = F.regexp_extract_all("text", F.lit("[A-Za-z0-9_]+"), F.lit(0))
    index = A.inverted_index(t("documents"), "doc_id", words, unique=True)
    return index.select("value", F.array_join("ids", ",").alias("ids"), "page")


def _word_list(column: str):
    return F.regexp_extract_all(column, F.lit("[A-Za-z0-9_]+"), F.lit(0))


@R.add(
    "a13_posting_blocks",
    """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS value FROM documents)
    SELECT value, CAST(doc_id // 100 AS BIGINT) AS block, min(doc_id) AS first, max(doc_id) AS last, CAST(count(*) AS INTEGER) AS n,
    string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY doc_id) AS ids FROM w GROUP BY value, doc_id // 100""",
)
def _(t):
    blocks = A.posting_blocks(t("documents"), "doc_id", _word_list("text"), span=100)
    ids = F.transform("offsets", lambda o: F.col("first") + o)
    return blocks.select("value", "block", "first", "last", "n", F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@R.add(
    "a13_lookup",
    """WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS value FROM documents),
    b AS (SELECT DISTINCT unnest(regexp_extract_all(text, '[A-Za-z0-9_]+')) AS value FROM benchmark)
    SELECT value, doc_id AS id FROM w WHERE value IN (SELECT value FROM b) AND doc_id BETWEEN 50 AND 449""",
)
def _(t):
    blocks = A.posting_blocks(t("documents"), "doc_id", _word_list("text"), span=100)
    asked = t("benchmark").select(F.explode(_word_list("text")).alias("v"))
    return A.lookup_postings(blocks, asked, 50, 449)


_RULES = {
    "l_discount": {"maximum": 0.05, "minimum": 0, "multiple_of": 0.02},
    "l_quantity": {"exclusive_maximum": 50, "exclusive_minimum": 1, "multiple_of": 2},
    "l_returnflag": {"enum": ["A", "N"], "min_length": 1, "max_length": 1, "pattern": "^[AR]$"},
}
_RULE_SQL = {
    ("l_discount", "maximum"): "l_discount > 0.05",
    ("l_discount", "minimum"): "l_discount < 0",
    ("l_quantity", "exclusive_maximum"): "l_quantity >= 50",
    ("l_quantity", "exclusive_minimum"): "l_quantity <= 1",
    ("l_quantity", "multiple_of"): "l_quantity % 2 <> 0",
    ("l_discount", "multiple_of"): "CAST(round(l_discount * 100) AS INTEGER) % 2 <> 0",
    ("l_returnflag", "enum"): "l_returnflag NOT IN ('A', 'N')",
    ("l_returnflag", "min_length"): "length(l_returnflag) < 1",
    ("l_returnflag", "max_length"): "length(l_returnflag) > 1",
    ("l_returnflag", "pattern"): "l_returnflag NOT IN ('A', 'R')",
}


@R.add(
    "a14_domain_violations",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{r}' AS rule, count(*) AS n FROM lineitem WHERE {test}" for (c, r), test in _RULE_SQL.items()
    ),
)
def _(t):
    return A.domain_violations(t("lineitem"), _RULES)


@R.add("a14_domain_failures", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')")
def _(t):
    return A.domain_failures(t("orders"), {"o_orderstatus": {"enum": ["F", "O"]}}).select("o_orderkey", "o_orderstatus")


@R.add(
    "a14_domain_json",
    """SELECT 'props' AS column_name, 'min_properties' AS rule, count(*) FILTER (WHERE event_type = 'error') AS n FROM events
    UNION ALL SELECT 'props', 'max_properties', count(*) FILTER (WHERE event_type = 'click') FROM events
    UNION ALL SELECT 'props', 'properties', count(*) FILTER (WHERE event_type = 'click') FROM events""",
)
def _(t):
    props = F.when(F.col("event_type") == "error", "{}").when(F.col("event_type") == "click", '{"k":1,"m":2}').otherwise(F.col("props"))
    made = t("events").select(props.alias("props"))
    return A.domain_violations(made, {"props": {"min_properties": 1, "max_properties": 1, "properties": ["k"]}})


@R.add(
    "a15_any_flag",
    """SELECT 'error' AS kind, count(*) FILTER (WHERE event_type = 'error' AND value > 0) > 0 AS flag FROM events
    UNION ALL SELECT 'refund', count(*) FILTER (WHERE event_type = 'refund') > 0 FROM events""",
)
def _(t):
    one = A.any_flag(t("events"), "event_type = 'error'", "value > 0").select(F.lit("error").alias("kind"), "flag")
    return one.unionByName(A.any_flag(t("events"), "event_type = 'refund'").select(F.lit("refund").alias("kind"), "flag"))


@R.add(
    "a16_table_stats",
    "SELECT count(*) AS documents, CAST(round(avg(octet_length(encode(text))), 4) AS DECIMAL(18,4)) AS avg_bytes FROM documents",
)
def _(t):
    stats = A.table_stats(t("documents"), F.col("text"))
    return stats.select("documents", F.round("avg_bytes", 4).cast("decimal(18,4)").alias("avg_bytes"))


@R.add(
    "a17_cardinality_violations",
    """SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey
    GROUP BY o_orderkey HAVING count(l_orderkey) < 1 OR count(l_orderkey) > 5""",
)
def _(t):
    return A.cardinality_violations(t("orders").select("o_orderkey"), t("lineitem"), [("o_orderkey", "l_orderkey")], 1, 5)

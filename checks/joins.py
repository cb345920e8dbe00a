"""Checks of the joins (J)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import Registry, dec
from modelweave.operators import joins as J
from modelweave.operators.deletes import delete_rows
from modelweave.plans.star import STAR

R = Registry()


@R.add(
    "j01_join_inner",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'",
)
def _(t):
    joined = J.join_inner(t("orders"), t("customer"), [("o_custkey", "c_custkey")], "c_mktsegment = 'BUILDING'")
    return joined.select("o_orderkey", "c_name")


@R.add(
    "j02_join_left_flag",
    """SELECT d.doc_id, CASE WHEN flag IS NULL OR flag = 'N' THEN 'unmarked' ELSE 'marked' END AS mark
    FROM documents d LEFT JOIN (SELECT doc_id, quality, CASE WHEN toxic = 1 THEN 'Y' ELSE 'N' END AS flag FROM labels) l
    ON d.doc_id = l.doc_id AND CAST(d.n_chars > 0 AS INTEGER) = l.quality""",
)
def _(t):
    docs = t("documents").select("doc_id", (F.col("n_chars") > 0).cast("int").alias("has_text"))
    labels = t("labels").select("doc_id", "quality", F.when(F.col("toxic") == 1, "Y").otherwise("N").alias("flag"))
    pairs = [("doc_id", "doc_id"), ("has_text", "quality")]
    return J.join_left_flag(docs, labels, pairs, "flag", "mark", "unmarked", "marked").select("doc_id", "mark")


@R.add(
    "j03_anti_by_null",
    "SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(t):
    return J.anti_by_null(t("orders"), t("lineitem"), [("o_orderkey", "l_orderkey")]).select("o_orderkey", "o_custkey")


@R.add(
    "j04_not_in",
    """WITH marks AS (SELECT l.doc_id AS k FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
    SELECT 'anti' AS form, count(*) AS n FROM documents WHERE NOT EXISTS (SELECT 1 FROM marks WHERE k = doc_id)
    UNION ALL SELECT 'sql_with_null', count(*) FROM documents WHERE doc_id NOT IN (SELECT k FROM marks)
    UNION ALL SELECT 'sql_without_null', count(*) FROM documents WHERE doc_id NOT IN (SELECT k FROM marks WHERE k IS NOT NULL)""",
)
def _(t):
    docs = t("documents").select("doc_id")
    marks = docs.join(t("labels").select(F.col("doc_id").alias("k")), F.col("doc_id") == F.col("k"), "left").select("k")
    pairs = [("doc_id", "k")]
    forms = {
        "anti": J.not_in(docs, marks, pairs),
        "sql_with_null": J.not_in(docs, marks, pairs, sql_nulls=True),
        "sql_without_null": J.not_in(docs, marks.filter("k IS NOT NULL"), pairs, sql_nulls=True),
    }
    lines = [df.agg(F.count("*").alias("n")).select(F.lit(f).alias("form"), "n") for f, df in forms.items()]
    return reduce(DataFrame.unionByName, lines)


@R.add(
    "j05_join_view",
    """SELECT c_custkey, n_name, r_name FROM region, nation, customer
    WHERE r_regionkey = n_regionkey AND n_nationkey = c_nationkey""",
)
def _(t):
    frames = {n: t(n) for n in ("region", "nation", "customer")}
    on = "region.r_regionkey = nation.n_regionkey AND nation.n_nationkey = customer.c_nationkey"
    return J.join_view(frames, on).select("c_custkey", "n_name", "r_name")


@R.add(
    "j06_nest_one",
    "SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(t):
    nested = J.nest_one(t("orders"), t("customer"), [("o_custkey", "c_custkey")], ["c_name", "c_mktsegment"], "customer")
    return nested.select("o_orderkey", "customer.c_name", "customer.c_mktsegment")



@R.add(
    "j07_nest_many",
    """SELECT o_orderkey, count(l_orderkey) AS n,
    coalesce(string_agg(l_linenumber || ':' || l_partkey || ':' || l_suppkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey), '') AS lines
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def _(t):
    fields = ["l_linenumber", "l_partkey", "l_suppkey"]
    nested = J.nest_many(
        t("orders").select("o_orderkey"), t("lineitem"), [("o_orderkey", "l_orderkey")], fields, "lines"
    )
    texts = F.transform("lines", lambda x: F.concat_ws(":", *[x[f] for f in fields]))
    return nested.groupBy("o_orderkey").agg(
        F.sum(F.size("lines").cast("bigint")).alias("n"), F.max(F.array_join(texts, ",")).alias("lines")
    )


@R.add(
    "j09_unnest_one",
    "SELECT o_orderkey, o_orderstatus, c_name, c_nationkey FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def _(t):
    orders = t("orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    flat = J.unnest_one(orders, t("customer"), [("o_custkey", "c_custkey")], ["c_name", "c_nationkey"])
    return flat.drop("o_custkey")


@R.add(
    "j10_nest_where",
    """SELECT o_orderkey, count(l_orderkey) AS n, CAST(coalesce(sum(l_partkey), 0) AS BIGINT) AS parts FROM orders
    LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_quantity > 25 AND l_extendedprice * 5 > o_totalprice GROUP BY o_orderkey""",
)
def _(t):
    nested = J.nest_where(
        t("orders").select("o_orderkey", "o_totalprice"),
        t("lineitem"),
        [("o_orderkey", "l_orderkey")],
        "l_quantity > 25 AND l_extendedprice * 5 > o_totalprice",
        ["o_orderkey"],
        ["l_linenumber", "l_partkey"],
        "lines",
    )
    total = F.aggregate("lines", F.lit(0).cast("bigint"), lambda acc, x: acc + x["l_partkey"])
    return nested.groupBy("o_orderkey").agg(
        F.sum(F.size("lines").cast("bigint")).alias("n"), F.sum(total).alias("parts")
    )


@R.add(
    "j10_interval",
    """WITH p AS (SELECT event_id, value, ts - INTERVAL 90 MINUTE AS since,
        CASE WHEN event_id % 50 = 0 THEN ts + INTERVAL 5 DAY ELSE ts + INTERVAL 20 MINUTE END AS until FROM events WHERE event_type = 'purchase')
    SELECT p.event_id, count(c.event_id) AS n, coalesce(string_agg(CAST(c.event_id AS VARCHAR), ',' ORDER BY c.ts, c.event_id), '') AS clicks
    FROM p LEFT JOIN events c ON c.event_type <> 'purchase' AND c.ts BETWEEN since AND until AND c.value < p.value GROUP BY p.event_id""",
)
def _(t):
    hour = lambda m: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(m))
    late = F.when(F.col("event_id") % 50 == 0, F.make_dt_interval(F.lit(5))).otherwise(hour(20))
    bought = t("events").filter("event_type = 'purchase'")
    bought = bought.select("event_id", F.col("value").alias("limit"), (F.col("ts") - hour(90)).alias("since"), (F.col("ts") + late).alias("until"))
    others = t("events").filter("event_type <> 'purchase'").select(F.col("event_id").alias("other"), "ts", "value")
    nested = J.nest_where(bought, others, [], "value < limit", ["event_id"], ["other"], "clicks", ["ts"], between=("ts", "since", "until"))
    return nested.select("event_id", F.size("clicks").cast("bigint").alias("n"), F.array_join("clicks.other", ",").alias("clicks"))


@R.add(
    "j11_nest_self",
    """SELECT a.conv_id, a.turn, a.role, coalesce(b.role, '') AS answered_by, count(b.role) AS n FROM conversations a
    LEFT JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn + 1 GROUP BY a.conv_id, a.turn, a.role, b.role""",
)
def _(t):
    turns = t("conversations").select("conv_id", "turn", "role", (F.col("turn") + 1).alias("next_turn"))
    nested = J.nest_self(turns, [("conv_id", "conv_id"), ("next_turn", "turn")], ["turn", "role"], "answers", ["turn"])
    first = F.coalesce(F.try_element_at("answers", F.lit(1))["role"], F.lit(""))
    return nested.select("conv_id", "turn", "role", first.alias("answered_by"), F.size("answers").cast("bigint").alias("n"))


@R.add(
    "j12_fk_orphans",
    " UNION ALL ".join(
        f"SELECT '{fk.child}.{fk.name}' AS constraint_name, count(*) AS orphans FROM {fk.child} "
        f"WHERE {fk.columns[0]} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {fk.parent} WHERE {fk.parent_columns[0]} = {fk.columns[0]})"
        for fk in STAR.foreign_keys
    )
    + " UNION ALL SELECT 'orders.reversed', count(*) FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)",
)
def _(t):
    parts = [
        (f"{fk.child}.{fk.name}", J.fk_orphans(t(fk.child), t(fk.parent), fk.columns, fk.parent_columns))
        for fk in STAR.foreign_keys
    ]
    parts.append(("orders.reversed", J.fk_orphans(t("orders"), t("lineitem"), ["o_orderkey"], ["l_orderkey"])))
    lines = [df.agg(F.count("*").alias("orphans")).select(F.lit(n).alias("constraint_name"), "orphans") for n, df in parts]
    return reduce(DataFrame.unionByName, lines)


@R.add(
    "j13_cascade_delete",
    """WITH n AS (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'),
    c AS (SELECT * FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM n)),
    s AS (SELECT * FROM supplier WHERE s_nationkey NOT IN (SELECT n_nationkey FROM n)),
    o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
    l AS (SELECT * FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s))
    SELECT 'region' AS table_name, count(*) AS n, CAST(sum(r_regionkey) AS BIGINT) AS keys FROM region WHERE r_name <> 'ASIA'
    UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM c
    UNION ALL SELECT 'supplier', count(*), CAST(sum(s_suppkey) AS BIGINT) FROM s
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o
    UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM l""",
)
def _(t):
    names = ["region", "nation", "customer", "supplier", "orders", "lineitem"]
    frames = {n: t(n) for n in names}
    after = J.cascade_delete(frames, STAR.foreign_keys, "region", frames["region"].filter("r_name = 'ASIA'"), ["r_regionkey"])
    keys = {"region": "r_regionkey", "customer": "c_custkey", "supplier": "s_suppkey", "orders": "o_orderkey", "lineitem": "l_orderkey"}
    lines = [
        after[n].agg(F.count("*").alias("n"), F.sum(k).cast("bigint").alias("keys")).select(F.lit(n).alias("table_name"), "n", "keys")
        for n, k in keys.items()
    ]
    return reduce(DataFrame.unionByName, lines)


# nations keep their suppliers, and nobody may take away a part that a line still needs
_ACTIONS = {("supplier", "fk_nation"): "SET NULL", ("lineitem", "fk_part"): "", ("lineitem", "fk_supplier"): ""}


@R.add(
    "j13_delete_actions",
    """WITH n AS (SELECT n_nationkey FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name = 'ASIA'),
    c AS (SELECT * FROM customer WHERE c_nationkey NOT IN (FROM n)),
    s AS (SELECT s_suppkey, CASE WHEN s_nationkey NOT IN (FROM n) THEN s_nationkey END AS s_nationkey FROM supplier),
    o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c) AND o_orderkey % 100 <> 3),
    l AS (SELECT * FROM lineitem WHERE l_partkey % 4 <> 0 AND l_orderkey IN (SELECT o_orderkey FROM o)),
    p AS (SELECT * FROM part WHERE p_partkey % 8 > 1 OR p_partkey IN (SELECT l_partkey FROM l))
    SELECT 'region' AS table_name, count(*) AS n, CAST(sum(r_regionkey) AS BIGINT) AS keys FROM region WHERE r_name <> 'ASIA'
    UNION ALL SELECT 'nation', count(*), CAST(sum(n_nationkey) AS BIGINT) FROM nation WHERE n_nationkey NOT IN (FROM n)
    UNION ALL SELECT 'customer', count(*), CAST(sum(c_custkey) AS BIGINT) FROM c
    UNION ALL SELECT 'supplier', count(s_nationkey), CAST(sum(s_suppkey) AS BIGINT) FROM s
    UNION ALL SELECT 'orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM o
    UNION ALL SELECT 'lineitem', count(*), CAST(sum(l_orderkey) AS BIGINT) FROM l
    UNION ALL SELECT 'part', count(*), CAST(sum(p_partkey) AS BIGINT) FROM p
    UNION ALL SELECT 'refused', count(*), 0 FROM part WHERE p_partkey % 8 <= 1 AND p_partkey IN (SELECT l_partkey FROM l)""",
)
def _(t):
    keys = {table.name: list(table.keys[0].columns) for table in STAR.tables}
    edges = [replace(fk, on_delete=_ACTIONS.get((fk.child, fk.name), fk.on_delete)) for fk in STAR.foreign_keys]
    frames = {name: t(name) for name in keys}
    frames["lineitem"] = frames["lineitem"].filter("l_partkey % 4 <> 0")
    deletes = {
        "region": frames["region"].filter("r_name = 'ASIA'"),
        "orders": frames["orders"].filter("o_orderkey % 100 = 3"),
        "part": frames["part"].filter("p_partkey % 8 <= 1"),
    }
    done = delete_rows(frames, edges, deletes, keys)
    lines = []
    for name, key in keys.items():
        counted = F.count("s_nationkey" if name == "supplier" else "*")
        sums = done.after[name].agg(counted.alias("n"), F.sum(key[0]).cast("bigint").alias("keys"))
        lines.append(sums.select(F.lit(name).alias("table_name"), "n", "keys"))
    refused = done.refused.agg(F.count("*").alias("n")).select(F.lit("refused").alias("table_name"), "n", F.lit(0).cast("bigint").alias("keys"))
    return reduce(DataFrame.unionByName, [*lines, refused])


@R.add(
    "j14_set_null_on_delete",
    """SELECT c_custkey, CASE WHEN n_regionkey = 1 THEN NULL ELSE c_nationkey END AS c_nationkey
    FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey""",
)
def _(t):
    deletes = t("nation").filter("n_regionkey = 1")
    return J.set_null_on_delete(t("customer").select("c_custkey", "c_nationkey"), deletes, ["c_nationkey"], ["n_nationkey"])


_EDGES = "WITH e AS (SELECT l_partkey AS src, l_suppkey AS dst FROM lineitem)"
_BACK = "EXISTS (SELECT 1 FROM e b WHERE b.src = a.dst AND b.dst = a.src AND a.src <> a.dst)"


@R.add("j15_mutual_edges", f"{_EDGES} SELECT src, dst FROM e a WHERE {_BACK}")
def _(t):
    edges = t("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return J.mutual_edges(edges, "src", "dst")


@R.add("j15_without_mutual_edges", f"{_EDGES} SELECT src, dst FROM e a WHERE NOT {_BACK}")
def _(t):
    edges = t("lineitem").select(F.col("l_partkey").alias("src"), F.col("l_suppkey").alias("dst"))
    return J.without_mutual_edges(edges, "src", "dst")


# Terms: every word of the benchmark texts, and every two words next to each other with what stands between them.
_CUT = "regexp_extract_all(lower({0}), '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')"


@R.add(
    "j16_terms_used",
    f"""WITH b AS (SELECT {_CUT.format('text')} AS p FROM benchmark),
    bp AS (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM b),
    words AS (SELECT DISTINCT p[i] AS term FROM bp WHERE regexp_matches(p[i], '^[a-z0-9_]')
      UNION SELECT DISTINCT p[i] || p[i+1] || p[i+2] FROM bp WHERE i + 2 <= len(p) AND regexp_matches(p[i], '^[a-z0-9_]')),
    d AS (SELECT {_CUT.format('text')} AS p FROM documents),
    dp AS (SELECT p, unnest(range(1, len(p) + 1)) AS i FROM d),
    seen AS (SELECT DISTINCT p[i] AS term FROM dp UNION SELECT DISTINCT p[i] || p[i+1] || p[i+2] FROM dp WHERE i + 2 <= len(p))
    SELECT term FROM words WHERE term IN (SELECT term FROM seen)""",
)
def _(t):
    pieces = t("benchmark").select(
        F.regexp_extract_all(F.lower("text"), F.lit(J.TERM_PIECES), F.lit(0)).alias("p")
    )
    at = pieces.select("p", F.explode(F.sequence(F.lit(1), F.size("p"))).alias("i")).filter("p[i - 1] rlike '^[a-z0-9_]'")
    one = at.select(F.expr("p[i - 1]").alias("term"))
    two = at.filter("i + 2 <= size(p)").select(F.expr("concat(p[i - 1], p[i], p[i + 1])").alias("term"))
    return J.terms_used(t("documents"), "text", one.unionByName(two).distinct(), "term")


@R.add(
    "j17_resolve_ids",
    """SELECT c_custkey, coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS nation, coalesce(open, TRUE) AS open
    FROM customer LEFT JOIN (SELECT n_nationkey, n_name, n_regionkey = 2 AS open FROM nation WHERE n_regionkey > 0) n
    ON n_nationkey = c_nationkey""",
)
def _(t):
    dim = t("nation").filter("n_regionkey > 0").withColumn("open", F.col("n_regionkey") == 2)
    named = J.resolve_ids(t("customer"), "c_nationkey", dim, "n_nationkey", "n_name", "nation", "open")
    return named.select("c_custkey", "nation", "open")


@R.add(
    "j18_resolve_id_array",
    """SELECT l_orderkey, string_agg(coalesce(CASE WHEN s_nationkey < 5 THEN upper(s_name) ELSE s_name END, CAST(l_suppkey AS VARCHAR)), ','
      ORDER BY l_linenumber, l_suppkey) AS suppliers
    FROM lineitem LEFT JOIN (SELECT * FROM supplier WHERE s_acctbal >= 0) s ON s_suppkey = l_suppkey GROUP BY l_orderkey""",
)
def _(t):
    lists = J.nest_many(
        t("lineitem").select("l_orderkey").distinct(),
        t("lineitem").select(F.col("l_orderkey").alias("k"), "l_linenumber", "l_suppkey"),
        [("l_orderkey", "k")],
        ["l_suppkey"],
        "lines",
        ["l_linenumber", "l_suppkey"],
    )
    ids = lists.select("l_orderkey", "_page", F.transform("lines", lambda x: x["l_suppkey"]).alias("suppliers"))
    dim = t("supplier").filter("s_acctbal >= 0")
    dim = dim.withColumn("new_name", F.when(F.col("s_nationkey") < 5, F.upper("s_name")))
    named = J.resolve_id_array(ids, ["l_orderkey", "_page"], "suppliers", dim, "s_suppkey", "s_name", "new_name")
    return named.groupBy("l_orderkey").agg(F.max(F.array_join("suppliers", ",")).alias("suppliers"))

"""Checks of sources (S) and projections (P)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.common import Registry, dec
from modelweave.operators import projections as P
from modelweave.plans.workspace import new_folder
from modelweave.operators.appends import append_rows
from modelweave.sources import external, sinks, tables
from modelweave.sources.live import create_tables

R = Registry()

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


@R.add(
    "s01_read_table",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in _TABLES),
)
def _(t):
    counts = [t(n).agg(F.count("*").alias("n")).select(F.lit(n).alias("table_name"), "n") for n in _TABLES]
    return reduce(DataFrame.unionByName, counts)


for _name in ("lineitem", "events", "documents", "orders"):

    @R.add(f"s01_read_table_{_name}", f"SELECT * FROM {_name}")
    def _(t, name=_name):
        return t(name)


@R.add("s02_sample_rows", "SELECT event_id, event_type, props FROM events ORDER BY event_id LIMIT 100")
def _(t):
    return tables.sample_rows(t("events"), ["event_id", "event_type", "props"], 100, ["event_id"])


@R.add(
    "s03_sample_size",
    """SELECT least(CAST(ceil(count(*) * CAST('3.3' AS DECIMAL(12,6)) / 100) AS BIGINT), CAST(25 AS BIGINT)) AS sample_size
    FROM documents""",
)
def _(t):
    return tables.sample_size(t("documents"), "relative", 3.3, 25)


@R.add("s04_read_external")
def _(t):
    lines = t("orders").select(
        F.concat_ws(",", "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.col("o_orderpriority")).otherwise(F.col("o_custkey").cast("string")))
    )
    path = new_folder(t("orders").sparkSession, "external_csv")
    lines.write.text(path)
    schema = T.StructType().add("o_orderkey", T.LongType()).add("o_custkey", T.LongType())
    rows, rejects = external.read_external(lines.sparkSession, [path], "csv", schema)
    return rows.agg(F.count("*").alias("n")).select(F.lit("rows").alias("part"), "n").unionByName(
        rejects.agg(F.count("*").alias("n")).select(F.lit("rejects").alias("part"), "n")
    )


R.sql["s04_read_external"] = """SELECT 'rows' AS part, count(*) AS n FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'rejects', count(*) FROM orders WHERE o_orderstatus = 'P'"""


@R.add(
    "s05_create_table_as",
    """SELECT o_orderstatus, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS total
    FROM orders GROUP BY o_orderstatus""",
)
def _(t):
    grouped = t("orders").groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.sum(dec("o_totalprice")).cast("decimal(28,2)").alias("total")
    )
    return sinks.create_table_as(grouped, new_folder(grouped.sparkSession, "ctas"))


@R.add(
    "s06_refresh_materialized_view",
    """SELECT r_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey
    JOIN region ON r_regionkey = n_regionkey GROUP BY r_name""",
)
def _(t):
    spark = t("orders").sparkSession
    for name in ("orders", "customer", "nation", "region"):
        t(name).createOrReplaceTempView(f"mv_{name}")
    return sinks.refresh_materialized_view(
        spark,
        "mv_region_revenue",
        """SELECT r_name, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS revenue
        FROM mv_orders JOIN mv_customer ON c_custkey = o_custkey JOIN mv_nation ON n_nationkey = c_nationkey
        JOIN mv_region ON r_regionkey = n_regionkey GROUP BY r_name""",
        new_folder(spark, "views"),
    )


@R.add(
    "s07_append_only",
    """SELECT 'table' AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders
    UNION ALL SELECT 'rejects', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'""",
)
def _(t):
    orders = t("orders")
    path = new_folder(orders.sparkSession, "append_only")
    orders.filter("o_orderstatus IN ('F', 'O')").write.parquet(path)
    after, rejects = sinks.append_only(orders.filter("o_orderstatus IN ('O', 'P')"), path, ["o_orderkey"])

    def line(df, part):
        return df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(part).alias("part"), "n", "keys")

    return line(after, "table").unionByName(line(rejects, "rejects"))


@R.add(
    "s07_append_rows",
    """SELECT 'table' AS part, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM orders WHERE o_orderkey % 4 < 3
    UNION ALL SELECT 'rejects', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders WHERE o_orderkey % 4 = 1 AND o_totalprice > 400000""",
)
def _(t):
    orders = t("orders")
    spark = orders.sparkSession
    live = create_tables(spark, new_folder(spark, "live"), {"orders": orders.filter("o_orderkey % 4 < 2")}, {"orders": ["o_orderkey"]}, 16)
    batch = orders.filter("o_orderkey % 4 = 2 or (o_orderkey % 4 = 1 and o_totalprice > 400000)")
    live, rejects = append_rows(live, "orders", batch, ["o_orderkey"])
    sums = [F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")]
    parts = [df.agg(*sums).select(F.lit(part).alias("part"), "n", "keys") for part, df in (("table", live.read("orders")), ("rejects", rejects))]
    return parts[0].unionByName(parts[1])


@R.add(
    "s08_retention_check",
    """SELECT event_id, ts FROM events WHERE event_type = 'error' AND ts + INTERVAL 16 DAY > TIMESTAMP '2024-01-31 00:00:00'""",
)
def _(t):
    deletes = t("events").filter("event_type = 'error'")
    now = F.lit("2024-01-31 00:00:00").cast("timestamp_ntz")
    return sinks.retention_check(deletes, "ts", 16, now).select("event_id", "ts")


@R.add(
    "s09_distribute",
    """SELECT n_name, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines FROM lineitem
    JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey GROUP BY n_name""",
)
def _(t):
    lines = sinks.distribute(t("lineitem").select("l_suppkey", "l_linenumber"), ["l_suppkey"], 16)
    nation = sinks.duplicate(t("nation").select("n_nationkey", "n_name"))
    supplier = t("supplier").select("s_suppkey", "s_nationkey")
    joined = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return joined.groupBy("n_name").agg(F.count("*").alias("n"), F.sum("l_linenumber").alias("lines"))


@R.add(
    "s10_write_clustered",
    """SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS overlapping_files FROM lineitem""",
)
def _(t):
    lines = t("lineitem").select("l_shipdate", "l_orderkey")
    path = new_folder(lines.sparkSession, "clustered")
    stored = sinks.write_clustered(lines, [("l_shipdate", "asc"), ("l_orderkey", "desc")], path, 16)
    files = stored.groupBy(F.input_file_name().alias("f")).agg(
        F.count("*").alias("rows"),
        F.sum("l_orderkey").alias("keys"),
        F.min("l_shipdate").alias("low"),
        F.max("l_shipdate").alias("high"),
    )
    # one line per file: a file may share its first value with the one before, not go below it
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))
    return files.withColumn("over", F.col("low") < before).agg(
        F.sum("rows").alias("n"), F.sum("keys").alias("keys"), F.count(F.when(F.col("over"), 1)).alias("overlapping_files")
    )


@R.add("p01_project", "SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS c_unknown FROM customer")
def _(t):
    return P.project(t("customer"), ["c_custkey", "c_name", "c_unknown"])


@R.add("p02_view_project", "SELECT o_orderkey AS id, o_orderstatus AS status, o_orderdate FROM orders")
def _(t):
    return P.view_project(
        {"orders": t("orders")},
        [("orders", "o_orderkey", "id"), ("orders", "o_orderstatus", "status"), ("orders", "o_orderdate", "o_orderdate")],
    )


_Q1 = """SELECT l_returnflag, l_linestatus, count(*) AS n, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(28,2)) AS sum_qty,
    CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))) AS DECIMAL(28,4)) AS sum_disc_price
    FROM {lineitem} WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus"""


@R.add("p03_view_sql", _Q1.replace("{lineitem}", "lineitem"))
def _(t):
    df = t("lineitem")
    text = _Q1.replace("{lineitem}", "${lineitem}").replace("TIMESTAMP '", "TIMESTAMP_NTZ '")
    return P.view_sql(df.sparkSession, text, lineitem=df)


@R.add("p04_select_by_type", "SELECT event_type, props FROM events")
def _(t):
    return P.select_by_type(t("events"), ["string"])


@R.add(
    "p05_filter_optional",
    """SELECT 0 AS conditions, c_custkey FROM customer
    UNION ALL SELECT 1, c_custkey FROM customer WHERE c_acctbal > 0
    UNION ALL SELECT 2, c_custkey FROM customer WHERE c_acctbal > 0 AND c_mktsegment = 'BUILDING'""",
)
def _(t):
    customer = t("customer")
    sets = [[None, ""], ["c_acctbal > 0", None], ["c_acctbal > 0", F.col("c_mktsegment") == "BUILDING"]]
    frames = [P.filter_optional(customer, s).select(F.lit(i).alias("conditions"), "c_custkey") for i, s in enumerate(sets)]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@R.add(
    "p06_filter_not_null",
    "SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NOT NULL",
)
def _(t):
    joined = t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return P.filter_not_null(joined, "quality")


@R.add(
    "p07_check_violations",
    """SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate, 'shipped_after_order' AS constraint_name
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_shipdate < o_orderdate""",
)
def _(t):
    joined = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    joined = joined.select("l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate")
    return P.check_violations(joined, "shipped_after_order", "l_shipdate >= o_orderdate")


@R.add("p08_filtered_view", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 100000")
def _(t):
    return P.filtered_view(t("orders"), "o_totalprice >= 100000").select("o_orderkey", "o_totalprice")


@R.add(
    "p08_check_option",
    """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE quality IS NULL OR quality <> 1""",
)
def _(t):
    rows = t("documents").select("doc_id").join(t("labels").select("doc_id", "quality"), "doc_id", "left")
    return P.check_option_rejects(rows, "quality = 1")


@R.add(
    "p09_generated_column",
    """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS net
    FROM lineitem""",
)
def _(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    text = " CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) "
    return P.generated_column(lines, "net", text).select("l_orderkey", "l_linenumber", "net")


@R.add(
    "p10_fill_default",
    """SELECT d.doc_id, coalesce(toxic, 0) AS toxic, quality, 'none' AS reviewer
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def _(t):
    joined = t("documents").select("doc_id").join(t("labels"), "doc_id", "left").select("doc_id", "toxic", "quality")
    joined = P.fill_default(joined, "toxic", 0, on_null=True)
    joined = P.fill_default(joined, "quality", 0)
    return P.fill_default(P.fill_default(joined, "nothing", " "), "reviewer", "'none'")


@R.add(
    "p11_split_by",
    """SELECT 'finished' AS side, o_orderkey FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'open', o_orderkey FROM orders WHERE o_orderstatus <> 'F'""",
)
def _(t):
    yes, no = P.split_by(t("orders").select("o_orderkey", "o_orderstatus"), "o_orderstatus = 'F'")
    return yes.select(F.lit("finished").alias("side"), "o_orderkey").unionByName(no.select(F.lit("open").alias("side"), "o_orderkey"))


@R.add(
    "p12_drop_blank",
    """WITH lines AS (SELECT doc_id, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(10) || chr(13)) AS line FROM documents)
    SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars FROM lines WHERE line <> '' GROUP BY doc_id""",
)
def _(t):
    lines = t("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    kept = P.drop_blank(lines, "line")
    return kept.groupBy("doc_id").agg(F.count("*").alias("lines"), F.sum(F.length("line")).alias("chars"))

"""Checks of partition layouts (R)."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import Registry
from modelweave.operators import layout as L
from modelweave.plans.workspace import new_folder

R = Registry()



def _years() -> list:
    """One partition per year, bounds without a time zone."""
    return [(f"y{y}", F.lit(f"{y + 1}-01-01 00:00:00").cast("timestamp_ntz")) for y in range(1995, 2001)]


_YEAR_SQL = "CASE " + " ".join(f"WHEN o_orderdate < TIMESTAMP '{y + 1}-01-01 00:00:00' THEN 'y{y}'" for y in range(1995, 2001)) + " END"


@R.add("r01_partition_range", f"SELECT o_orderkey, coalesce({_YEAR_SQL}, 'reject') AS p FROM orders")
def _(t):
    rows, rejects = L.partition_range(t("orders").select("o_orderkey", "o_orderdate"), "o_orderdate", _years())
    return rows.select("o_orderkey", "p").unionByName(rejects.select("o_orderkey", F.lit("reject").alias("p")))


@R.add(
    "r02_partition_interval",
    """SELECT event_id, CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) // 7 AS BIGINT) AS week, CAST(floor(value / 50) AS BIGINT) AS step FROM events""",
)
def _(t):
    weekly = L.partition_interval(t("events"), "ts", 7, "2024-01-01", "day", "week")
    return L.partition_interval(weekly, "value", 50, 0, name="step").select("event_id", "week", "step")


@R.add(
    "r02_partition_interval_month",
    "SELECT o_orderkey, CAST(((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1) // 3 AS BIGINT) AS p FROM orders",
)
def _(t):
    return L.partition_interval(t("orders"), "o_orderdate", 3, "1995-01-01", "month").select("o_orderkey", "p")


@R.add(
    "r03_partition_list",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'closed' ELSE o_orderstatus END AS p, o_orderstatus <> 'F' AS refused FROM orders""",
)
def _(t):
    rows, _ = L.partition_list(t("orders"), "o_orderstatus", {"closed": ["F"]}, automatic=True)
    _, refused = L.partition_list(t("orders"), "o_orderstatus", {"closed": ["F"]})
    marks = refused.select("o_orderkey", F.lit(True).alias("refused"))
    return rows.select("o_orderkey", "p").join(marks, "o_orderkey", "left").select(
        "o_orderkey", "p", F.coalesce("refused", F.lit(False)).alias("refused")
    )


@R.add("r04_partition_hash", "SELECT count(*) AS n, CAST(0 AS BIGINT) AS split_keys, CAST(16 AS BIGINT) AS parts FROM lineitem")
def _(t):
    placed = L.partition_hash(t("lineitem"), ["l_orderkey"], 16).groupBy("l_orderkey", "p").agg(F.count("*").alias("rows"))
    keys = placed.groupBy("l_orderkey").agg(F.count("*").alias("parts"), F.sum("rows").alias("rows"))
    totals = keys.agg(F.sum("rows").alias("n"), F.count(F.when(F.col("parts") > 1, 1)).alias("split_keys"))
    return totals.withColumn("parts", placed.agg(F.count_distinct("p")).scalar())


@R.add(
    "r05_partition_by_reference",
    f"SELECT l_orderkey, l_linenumber, l_partkey, {_YEAR_SQL} AS p FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE {_YEAR_SQL} IS NOT NULL",
)
def _(t):
    parent, _ = L.partition_range(t("orders"), "o_orderdate", _years())
    placed, _ = L.partition_by_reference(t("lineitem"), parent, [("l_orderkey", "o_orderkey")])
    return placed.select("l_orderkey", "l_linenumber", "l_partkey", "p")


@R.add(
    "r05_rejects",
    f"SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus <> 'F' WHERE o_orderkey IS NULL OR {_YEAR_SQL} IS NULL",
)
def _(t):
    # lines of orders that are missing, and of orders above the last bound
    parent, _ = L.partition_range(t("orders").filter("o_orderstatus <> 'F'"), "o_orderdate", _years())
    _, rejects = L.partition_by_reference(t("lineitem"), parent, [("l_orderkey", "o_orderkey")])
    return rejects.select("l_orderkey", "l_linenumber", "l_partkey")


@R.add(
    "r02_partition_interval_mid_month",
    """SELECT o_orderkey, CAST(floor(((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1 - CASE WHEN day(o_orderdate) < 15 THEN 1 ELSE 0 END) / 1.0) AS BIGINT) AS p FROM orders""",
)
def _(t):
    return L.partition_interval(t("orders"), "o_orderdate", 1, "1995-01-15", "month").select("o_orderkey", "p")


@R.add("r06_partition_system", "SELECT count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS keys, CAST(8 AS BIGINT) AS parts FROM lineitem")
def _(t):
    placed = L.partition_system(t("lineitem").select("l_orderkey"), 8).withColumn("part", F.spark_partition_id())
    return placed.agg(F.count("*").alias("n"), F.sum("l_orderkey").alias("keys"), F.count_distinct("part").alias("parts"))


@R.add(
    "r07_partition_composite",
    f"""SELECT o_orderkey, p, o_orderstatus AS sp FROM (SELECT o_orderkey, o_orderstatus, {_YEAR_SQL} AS p FROM orders)
    WHERE p IN ('y1996', 'y1997') AND o_orderstatus = 'F'""",
)
def _(t):
    orders = t("orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    tagged = L.partition_composite(
        orders, L.range_name("o_orderdate", _years(), "later"), L.list_name("o_orderstatus", {}, automatic=True)
    )
    stored = L.write_partitioned(tagged, ["p", "sp"], new_folder(orders.sparkSession, "composite"))
    return stored.filter("p IN ('y1996', 'y1997') AND sp = 'F'").select("o_orderkey", "p", "sp")

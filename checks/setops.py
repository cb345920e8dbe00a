"""Checks of set operations and snapshot difference (U)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.common import Registry
from modelweave.operators import setops as U

R = Registry()


@R.add(
    "u01_combine",
    """SELECT c_name AS name, 'customer' AS origin, c_mktsegment AS segment FROM customer
    UNION ALL SELECT s_name, 'supplier', NULL FROM supplier""",
)
def _(t):
    customer = t("customer").select(F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    return U.combine({"customer": customer, "supplier": t("supplier").select(F.col("s_name").alias("name"))})


@R.add(
    "u02_subtract_by_key",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE (l_orderkey, l_linenumber) NOT IN
    (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_quantity > 40)""",
)
def _(t):
    lines = t("lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return U.subtract_by_key(
        lines, lines.filter("l_quantity > 40").select("l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"]
    ).drop("l_quantity")


def _old(t) -> DataFrame:
    return t("customer").select("c_custkey", "c_name", "c_mktsegment", F.col("c_acctbal").cast("decimal(18,2)").alias("c_acctbal"))


def _new(t) -> DataFrame:
    """Debts are paid off, machinery customers leave, suppliers join."""
    debt = F.when(F.col("c_acctbal") < 0, F.lit(0)).otherwise(F.col("c_acctbal")).cast("decimal(18,2)")
    kept = _old(t).filter("c_mktsegment <> 'MACHINERY'").withColumn("c_acctbal", debt)
    fresh = t("supplier").select(
        (F.col("s_suppkey") + 100000000).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.lit("BUILDING").alias("c_mktsegment"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("c_acctbal"),
    )
    return kept.unionByName(fresh)


@R.add(
    "u03_snapshot_diff",
    """SELECT c_custkey, 'removed' AS change, CAST(c_acctbal AS DECIMAL(18,2)) AS before, CAST(NULL AS DECIMAL(18,2)) AS after
      FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT c_custkey, 'modified', CAST(c_acctbal AS DECIMAL(18,2)), 0 FROM customer WHERE c_mktsegment <> 'MACHINERY' AND c_acctbal < 0
    UNION ALL SELECT s_suppkey + 100000000, 'added', NULL, CAST(s_acctbal AS DECIMAL(18,2)) FROM supplier""",
)
def _(t):
    diff = U.snapshot_diff(_old(t), _new(t), ["c_custkey"])
    return diff.select("c_custkey", "change", F.col("old.c_acctbal").alias("before"), F.col("new.c_acctbal").alias("after"))


@R.add(
    "u03_snapshot_diff_large",
    """SELECT o_orderkey, 'removed' AS change, o_orderstatus AS before, CAST(NULL AS VARCHAR) AS after FROM orders WHERE o_orderkey % 5000 = 17
    UNION ALL SELECT o_orderkey, 'modified', o_orderstatus, 'X' FROM orders WHERE o_orderkey % 3000 = 5 AND o_orderkey % 5000 <> 17
    UNION ALL SELECT o_orderkey + 1000000000, 'added', NULL, 'N' FROM orders WHERE o_orderkey % 7000 = 9""",
)
def _(t):
    old = t("orders")
    status = F.when(F.col("o_orderkey") % 3000 == 5, "X").otherwise(F.col("o_orderstatus"))
    fresh = old.filter("o_orderkey % 7000 = 9").withColumn("o_orderkey", F.col("o_orderkey") + 1000000000).withColumn("o_orderstatus", F.lit("N"))
    new = old.filter("o_orderkey % 5000 <> 17").withColumn("o_orderstatus", status).unionByName(fresh)
    diff = U.snapshot_diff_large(old, new, ["o_orderkey"])
    return diff.select("o_orderkey", "change", F.col("old.o_orderstatus").alias("before"), F.col("new.o_orderstatus").alias("after"))


@R.add(
    "u04_snapshot_diff_two_keys",
    """SELECT CASE WHEN c_acctbal < 0 THEN 'name' ELSE 'id' END AS matched_by, c_custkey AS old_id,
      CASE WHEN c_acctbal < 0 THEN c_custkey + 200000000 ELSE c_custkey END AS new_id FROM customer WHERE c_mktsegment <> 'MACHINERY'
    UNION ALL SELECT 'removed', c_custkey, NULL FROM customer WHERE c_mktsegment = 'MACHINERY'
    UNION ALL SELECT 'added', NULL, s_suppkey + 100000000 FROM supplier""",
)
def _(t):
    # customers in debt keep their name under a new id; builders keep their id under a new name
    rekeyed = _old(t).filter("c_mktsegment <> 'MACHINERY'").withColumns(
        {
            "c_custkey": F.when(F.col("c_acctbal") < 0, F.col("c_custkey") + 200000000).otherwise(F.col("c_custkey")),
            "c_name": F.when((F.col("c_mktsegment") == "BUILDING") & (F.col("c_acctbal") >= 0), F.upper("c_name")).otherwise(F.col("c_name")),
        }
    )
    fresh = _new(t).filter("c_custkey >= 100000000")
    diff = U.snapshot_diff_two_keys(_old(t), rekeyed.unionByName(fresh), "c_custkey", "c_name")
    return diff.select("matched_by", F.col("old.c_custkey").alias("old_id"), F.col("new.c_custkey").alias("new_id"))


@R.add(
    "u04_same_names",
    """WITH o AS (SELECT p_partkey AS id, p_brand || p_size AS n FROM part), w AS (SELECT id + 1000000 AS id, n FROM o WHERE id % 3 = 0),
    c AS (SELECT n, count(*) AS k FROM o GROUP BY n), d AS (SELECT n, count(*) AS k FROM w GROUP BY n)
    SELECT CASE WHEN d.n IS NULL THEN 'removed' ELSE 'ambiguous' END AS matched_by, o.id AS old_id, CAST(NULL AS BIGINT) AS new_id FROM o JOIN c USING (n) LEFT JOIN d USING (n) WHERE d.n IS NULL OR c.k > 1 OR d.k > 1
    UNION ALL SELECT 'ambiguous', NULL, w.id FROM w JOIN c USING (n) JOIN d USING (n) WHERE c.k > 1 OR d.k > 1
    UNION ALL SELECT 'name', o.id, w.id FROM o JOIN w USING (n) JOIN c USING (n) JOIN d USING (n) WHERE c.k = 1 AND d.k = 1""",
)
def _(t):
    # every third part comes back under a new id; many parts share a brand and size
    old = t("part").select(F.col("p_partkey").alias("id"), F.concat("p_brand", F.col("p_size").cast("string")).alias("n"))
    new = old.filter("id % 3 = 0").withColumn("id", F.col("id") + 1000000)
    diff = U.snapshot_diff_two_keys(old, new, "id", "n")
    return diff.select("matched_by", F.col("old.id").alias("old_id"), F.col("new.id").alias("new_id"))


def _part(t) -> DataFrame:
    return t("part").select("p_partkey", "p_name", "p_type", F.col("p_retailprice").cast("decimal(18,2)").alias("price"))


def _part_edits(t) -> DataFrame:
    """Economy parts get a type, small ones a name and a price, medium ones a price, large ones a name."""
    kind = F.col("p_type")
    return _part(t).withColumns(
        {
            "p_name": F.when(kind.isin("SMALL", "LARGE"), F.upper("p_name")).otherwise(F.col("p_name")),
            "price": F.when(kind.isin("SMALL", "MEDIUM"), F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)"),
            "p_type": F.when(kind == "ECONOMY", "BUDGET").otherwise(kind),
        }
    )


@R.add(
    "u05_classify_change",
    """SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'recreate' WHEN 'SMALL' THEN 'rename+rebuild' WHEN 'MEDIUM' THEN 'rebuild' ELSE 'rename' END AS action
    FROM part WHERE p_type IN ('ECONOMY', 'SMALL', 'MEDIUM', 'LARGE')""",
)
def _(t):
    diff = U.snapshot_diff(_part(t), _part_edits(t), ["p_partkey"])
    return U.classify_change(diff, ["p_type"], ["p_name"], ["price"]).select("p_partkey", "action")


@R.add(
    "u06_changed_columns",
    """WITH p AS (SELECT p_partkey, p_name, p_type, CAST(p_retailprice AS DECIMAL(18,2)) AS price FROM part)
    SELECT p_partkey, 'p_name' AS name, p_name AS old_value, upper(p_name) AS new_value FROM p WHERE p_type IN ('SMALL', 'LARGE')
    UNION ALL SELECT p_partkey, 'price', CAST(price AS VARCHAR), CAST(CAST(price + 1 AS DECIMAL(18,2)) AS VARCHAR) FROM p WHERE p_type IN ('SMALL', 'MEDIUM')
    UNION ALL SELECT p_partkey, 'p_type', 'ECONOMY', 'BUDGET' FROM p WHERE p_type = 'ECONOMY'""",
)
def _(t):
    diff = U.snapshot_diff(_part(t), _part_edits(t), ["p_partkey"])
    changes = U.changed_columns(diff, ["p_name", "p_type", "price"])
    return changes.select("p_partkey", F.explode("changes").alias("c")).select("p_partkey", "c.*")

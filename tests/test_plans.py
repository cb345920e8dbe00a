"""Hot groups, dense positions, and what reaches the scan."""

import collections

from pyspark.sql import functions as F

from modelweave.operators.documents import nest, shred
from modelweave.operators.joins import nest_many
from modelweave.operators.projections import filtered_view
from modelweave.model import DocField, DocNode
from modelweave.plans.pages import collect_groups
from modelweave.plans.positions import dense_index, in_order, running_total
from tests.conftest import plan_of, rows


def fields(text):
    return tuple(DocField(c) for c in text.split())


def skewed(spark, n=3000):
    """(k, v): key 0 holds a third of the rows, a third of those are copies of one row."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"),
        F.when(F.col("id") % 9 == 0, 7).otherwise(F.col("id")).alias("v"),
    )


def test_dense_index_is_dense_and_ordered_with_copies(spark):
    df = skewed(spark)
    got = dense_index(df, ["k"], "i").orderBy("i").collect()
    assert [r.i for r in got] == list(range(3000))
    assert [(r.k, r.v) for r in got] == sorted((r.k, r.v) for r in df.collect())


def test_dense_index_spreads_one_order_value(spark):
    df = spark.range(4000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = in_order(df, ["k"]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(r["count"] for r in parts) == 4000
    assert max(r["count"] for r in parts) < 2000
    assert dense_index(df, ["k"], "i").select("i").distinct().count() == 4000


def test_dense_index_descending_and_nulls(spark):
    df = spark.createDataFrame([(1,), (None,), (3,), (2,)], "a int")
    assert rows(dense_index(df, [F.col("a").desc()], "i", unique=True)) == sorted([(3, 0), (2, 1), (1, 2), (None, 3)], key=repr)


def test_running_total(spark):
    df = skewed(spark, 500).withColumn("w", F.col("v") % 5)
    total = 0
    for r in running_total(df, ["k", "v"], "w", "before").orderBy("k", "v", "before").collect():
        assert r.before == total
        total += r.w


def test_long_lists_go_on_in_pages_and_stay_whole(spark):
    df = skewed(spark)
    grouped, paged = collect_groups(df, ["k"], F.col("v"), ["v"], "items", page_rows=100)
    assert paged
    lists = collections.defaultdict(list)
    for r in grouped.orderBy("k", "_page").collect():
        assert len(r["items"]) <= 100
        lists[r.k] += r["items"]
    want = collections.defaultdict(list)
    for r in df.collect():
        want[r.k].append(r.v)
    assert dict(lists) == {k: sorted(v) for k, v in want.items()}
    pages = {r.k: r._pages for r in grouped.collect()}
    assert pages == {k: -(-len(v) // 100) for k, v in want.items()}


def test_null_keys_are_a_group(spark):
    df = spark.range(300).select(F.when(F.col("id") % 2 == 0, F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    for size in (10, 1000):
        grouped, _ = collect_groups(df, ["k"], F.col("v"), ["v"], "items", page_rows=size)
        got = grouped.groupBy("k").agg(F.sum(F.size("items")).alias("n"))
        assert rows(got) == rows(df.groupBy("k").agg(F.count("*").alias("n")))


def test_parent_with_two_paged_lists(spark):
    parent = spark.createDataFrame([(0,), (1,), (99,)], "p long")
    df = skewed(spark)
    both = nest_many(parent, df, [("p", "k")], ["v"], "a", ["v"], page_rows=100)
    once = nest_many(parent, df, [("p", "k")], ["v"], "a", ["v"])
    whole = {r.p: [x.v for x in r.a] for r in once.collect()}
    paged = collections.defaultdict(list)
    for r in both.orderBy("p", "_page").collect():
        paged[r.p] += [x.v for x in r.a]
    assert dict(paged) == whole
    assert whole[99] == []


def tree():
    return DocNode(
        "top",
        fields("r name"),
        key=("r",),
        children=(
            DocNode("other", fields("o"), "others", "array", (("r", "r"),), order=("o",), key=("r", "o")),
            DocNode(
                "mid",
                fields("m"),
                "mids",
                "array",
                (("r", "r"),),
                order=("m",),
                key=("m",),
                children=(DocNode("leaf", fields("l"), "leaves", "array", (("m", "m"),), order=("l",), key=("l",)),),
            ),
        ),
    )


def test_deep_documents_on_pages_shred_to_the_same_rows(spark):
    frames = {
        "top": spark.range(4).select(F.col("id").alias("r"), F.concat(F.lit("n"), "id").alias("name")),
        "other": spark.range(900).select((F.col("id") % 3).alias("r"), F.col("id").alias("o")),
        "mid": spark.range(60).select(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 3).cast("long").alias("r"), F.col("id").alias("m")),
        "leaf": spark.range(2000).select(
            F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).cast("long").alias("m"), F.col("id").alias("l")
        ),
    }
    for size in (50, 100_000):
        docs = nest(tree(), frames, page_rows=size)
        got, conflicts = shred(docs, tree())
        assert conflicts == {}
        for name, columns in {"top": "r name", "other": "r o", "mid": "r m", "leaf": "m l"}.items():
            assert rows(got[name], *columns.split()) == rows(frames[name], *columns.split()), (name, size)
        weight = docs.select(
            (F.size("others") + F.aggregate("mids", F.lit(0), lambda a, x: a + 1 + F.size(x["leaves"]))).alias("w"), "_page"
        )
        if size == 50:
            assert weight.agg(F.max("w")).first()[0] <= 200
            assert docs.filter("_page > 0").count() > 0
        else:
            assert docs.count() == 4


def test_filter_and_columns_reach_the_scan(read):
    plan = plan_of(filtered_view(read("orders"), "o_totalprice >= 100000").select("o_orderkey"))
    assert "GreaterThanOrEqual(o_totalprice,100000.0)" in plan
    assert "struct<o_orderkey:bigint,o_totalprice:double>" in plan

"""Range joins against all pairs."""

import random
import re

import pytest
from pyspark.sql import functions as F

from modelweave.operators import joins as J
from modelweave.operators.intervals import interval_join
from tests.conftest import plan_of, rows


@pytest.mark.parametrize("scale", [1.0, 1e-3, 1e6])
def test_all_pairs_once(spark, scale):
    r = random.Random(7)
    ranges = []
    for i in range(150):
        low = r.uniform(-50, 50)
        ranges.append((i, low * scale, (low + r.choice([0, 0.01, 1, 1, 30, 4000])) * scale))
    ranges += [(200, None, 1.0), (201, 1.0, None), (202, 5.0, -5.0), (203, 0.0, 0.0), (204, -1e9, 1e9)]
    points = [(i, r.choice([r.uniform(-60, 60), float(r.randrange(-5, 5))]) * scale) for i in range(200)] + [(300, None), (301, 0.0), (302, 0.0)]
    a = spark.createDataFrame(ranges, "r int, low double, high double")
    b = spark.createDataFrame(points, "p int, x double")
    want = sorted(((i, p) for i, lo, hi in ranges for p, x in points if None not in (lo, hi, x) and lo <= x <= hi), key=repr)
    joined = interval_join(a, b, "low", "high", "x")
    assert rows(joined, "r", "p") == want
    assert joined.columns == ["r", "low", "high", "p", "x"]


def test_plan_has_no_nested_loop(spark, read):
    events = read("events")
    a = events.select("event_id", F.col("ts").alias("since"), (F.col("ts") + F.expr("interval 1 hour")).alias("until"), "user_id")
    b = events.select(F.col("event_id").alias("other"), "ts", F.col("user_id").alias("who"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(interval_join(a, b, "since", "until", "ts"))
        assert "SortMergeJoin" in plan and not re.search("NestedLoop|Cartesian", plan)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    same = rows(interval_join(a, b, "since", "until", "ts", [("user_id", "who")]), "event_id", "other")
    every = a.join(b, F.expr("ts between since and until and user_id = who"))
    assert same == rows(every, "event_id", "other")


def test_days_empty_sides_and_refusals(spark):
    a = spark.sql("select 1 as k, date'2024-01-01' as low, date'2024-01-03' as high")
    b = spark.sql("select explode(sequence(date'2023-12-30', date'2024-01-09')) as day")
    nested = J.nest_where(a, b, [], "", ["k"], ["day"], "days", between=("day", "low", "high"))
    assert [x["day"].day for x in nested.first()["days"]] == [1, 2, 3]
    assert interval_join(a.limit(0), b, "low", "high", "day").count() == 0
    assert interval_join(a, b.limit(0), "low", "high", "day").count() == 0
    with pytest.raises(ValueError, match="range"):
        J.nest_where(a, b, [], "day > low", ["k"], ["day"], "days")
    with pytest.raises(ValueError, match="both"):
        interval_join(a, a, "low", "high", "low")


def test_pairs_of_one_file_are_met_in_many_tasks(spark):
    a = spark.range(200).coalesce(1).select(F.col("id").alias("k"), F.lit(0).alias("low"), F.lit(50).alias("high"))
    b = spark.range(100).coalesce(1).select(F.col("id").alias("x"))
    met = interval_join(a, b, "low", "high", "x")
    tasks = met.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert sum(t["n"] for t in tasks) == 200 * 51
    assert len(tasks) > 4 and max(t["n"] for t in tasks) < 200 * 51 / 2


def _nested(df, name="items"):
    """Lists by parent, with all pages in order."""
    out = {}
    for r in sorted(df.collect(), key=lambda r: (str(r["k"]), r["_page"])):
        out.setdefault((r["k"], r["low"], r["high"], r["cap"]), []).append((r["_page"], [tuple(x) for x in r[name]]))
    return out


@pytest.mark.parametrize("page_rows", [1, 3, 64, 100_000])
def test_lists_of_ranges_are_pages_of_all_points(spark, page_rows):
    r = random.Random(page_rows)
    parents = []
    for i in range(60):
        low = r.randrange(-50, 50)
        parents.append((i, low, low + r.choice([0, 1, 3, 20, 200]), r.choice([None, 0, 3, 9])))
    parents += [(100, None, 3, 9), (101, 3, None, 9), (102, 4, 2, 9), (None, -5, 5, 9), (103, -500, 500, 9), (104, 900, 950, 9)]
    points = [(i, r.randrange(-60, 60), r.choice([None, *range(9)]), r.randrange(3)) for i in range(300)] + [(301, None, 1, 1), (7, 5, 1, 1), (7, 5, 1, 1)]
    a = spark.createDataFrame(parents, "k int, low int, high int, cap int")
    b = spark.createDataFrame(points, "p int, x int, v int, w int")
    nested = J.nest_where(a, b, [], "v < cap and (w = 1 or v + w > 2)", ["k"], ["p"], "items", ["x", "w"], page_rows, ("x", "low", "high"))
    assert nested.columns == ["k", "low", "high", "cap", "items", "_page"]
    got = _nested(nested)
    assert len(got) == len(parents)
    for k, low, high, cap in parents:
        met = sorted((x, w, p) for p, x, v, w in points if None not in (k, low, high, cap, x, v) and low <= x <= high and v < cap and (w == 1 or v + w > 2))
        pages = got[k, low, high, cap]
        assert [x for _, items in pages for x in items] == [(p,) for _, _, p in met]
        assert [n for n, _ in pages] == list(range(max(1, -(-len(met) // page_rows))))
        assert all(len(items) == page_rows for _, items in pages[:-1])


def test_repeated_keys_and_no_condition(spark):
    a = spark.createDataFrame([(1, 0, 4, 0), (1, 3, 6, 0), (2, 1, 2, 0)], "k int, low int, high int, cap int")
    b = spark.createDataFrame([(i, i) for i in range(9)], "p int, x int")
    got = _nested(J.nest_where(a, b, [], "", ["k"], ["p"], "items", ["x"], between=("x", "low", "high")))
    both = [(i,) for i in (0, 1, 2, 3, 3, 4, 4, 5, 6)]
    assert got == {(1, 0, 4, 0): [(0, both)], (1, 3, 6, 0): [(0, both)], (2, 1, 2, 0): [(0, [(1,), (2,)])]}
    only = J.nest_where(a.filter("k = 2"), b, [], "cap = 1", ["k"], ["p"], "items", ["x"], between=("x", "low", "high"))
    assert _nested(only) == {(2, 1, 2, 0): [(0, [])]}


def test_lists_of_ranges_are_made_without_rows_of_pairs(spark):
    a = spark.range(400).select(F.col("id").alias("k"), F.lit(0).alias("low"), F.lit(999).alias("high"), F.lit(1).alias("cap"))
    b = spark.range(1000).select(F.col("id").cast("int").alias("x"))
    nested = J.nest_where(a, b, [], "x >= cap", ["k"], ["x"], "items", ["x"], between=("x", "low", "high"))
    assert nested.agg(F.sum(F.size("items"))).first()[0] == 400 * 999
    nested.write.format("noop").mode("overwrite").save()
    plan = plan_of(nested)
    # points are collected once for a block, not once for each range
    keys = re.findall(r"Keys \[\d+\]: \[([^\n]*)\]\s*\nFunctions \[\d+\]: \[[^\n]*collect_list", plan)
    assert keys and all(k.startswith("_b#") for k in keys)

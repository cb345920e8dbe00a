"""Appends to live tables: the rejects of a plain append, and how few files are opened for them."""

import datetime

from pyspark.sql import functions as F

from modelweave.operators.appends import append_rows, files_with_keys
from modelweave.sources import sinks
from modelweave.sources.live import create_tables, open_tables
from tests.conftest import rows


def table(spark, tmp_path, df, keys, partitions=100):
    return create_tables(spark, str(tmp_path / "live"), {"t": df}, {"t": keys}, partitions)


def test_files_without_a_batch_key_are_skipped(spark, tmp_path):
    df = spark.range(5000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("v"))
    live = table(spark, tmp_path, df, ["k"])
    assert len(live.files["t"]) == 100
    batch = spark.createDataFrame([(7500, "known"), (7501, "new"), (7501, "twice"), (7502, "new"), (20000, "new"), (None, "null")], "k long, v string")
    assert len(files_with_keys(live, "t", batch, "k")) == 1
    after, rejects = append_rows(live, "t", batch, ["k"])
    df.write.parquet(str(tmp_path / "plain"))
    _, want = sinks.append_only(batch, str(tmp_path / "plain"), ["k"])
    assert rows(rejects) == rows(want) and rejects.count() == 4
    assert rows(after.read("t").filter("v = 'new'"), "k") == [(20000,), (7502,)]
    assert after.read("t").count() == 5002
    # the ranges are kept with the table
    again = open_tables(spark, live.folder)
    assert again.ranges == after.ranges and len(files_with_keys(again, "t", batch.filter("k = 20000"), "k")) == 1
    assert set(live.files["t"]) < set(again.files["t"])


def test_keys_of_other_types_and_no_rows(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([(f"k{i}", day + datetime.timedelta(days=i)) for i in range(20)], "k string, at timestamp_ntz")
    live = table(spark, tmp_path / "a", df, ["k"], 4)
    assert len(files_with_keys(live, "t", df.limit(1), "k")) == 4
    after, rejects = append_rows(live, "t", df.limit(0), ["k"])
    assert rejects.count() == 0 and after.files == live.files
    live = table(spark, tmp_path / "b", df, ["at", "k"], 4)
    late = df.filter("at >= timestamp_ntz'2024-01-19'")
    assert len(files_with_keys(live, "t", late, "at")) == 1
    _, rejects = append_rows(live, "t", late, ["at", "k"])
    assert rejects.count() == 2
    empty = table(spark, tmp_path / "c", df.limit(0), ["k"])
    after, rejects = append_rows(empty, "t", df, ["k"])
    assert after.read("t").count() == 20 and rejects.count() == 0


def test_ranges_that_say_nothing(spark, tmp_path):
    df = spark.range(1000).select(F.xxhash64("id").alias("k"))
    live = create_tables(spark, str(tmp_path / "live"), {"t": df.limit(0)}, {"t": ["k"]})
    for part in range(20):
        live, _ = append_rows(live, "t", df.filter(F.pmod("k", F.lit(20)) == part).coalesce(1), ["k"])
    assert sorted(files_with_keys(live, "t", df, "k")) == sorted(f.rpartition("/")[2] for f in live.files["t"])
    _, rejects = append_rows(live, "t", df.limit(10), ["k"])
    assert rejects.count() == 10

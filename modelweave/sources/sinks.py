"""S05..S10: stored results, append-only tables, retention, distribution, clustering."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.plans.positions import in_order
from modelweave.plans.workspace import new_folder

DUPLICATE_MAX_BYTES = 64 << 20


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Store a select as a new table; an existing one is an error."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def refresh_materialized_view(spark: SparkSession, name: str, select_sql: str, base: str) -> DataFrame:
    """Write a full new snapshot below ``base``, then point the view name at it.

    Readers of the old snapshot are not disturbed: it stays where it is.
    """
    result = create_table_as(spark.sql(select_sql), f"{base}/{name}-{uuid4().hex}")
    result.createOrReplaceTempView(name)
    return result


def append_only(df_new: DataFrame, path: str, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Append rows with a new key; returns (table after, rejected rows).

    A key that is stored, comes twice in the batch, or has a NULL part is
    refused: stored rows never change. Of the stored keys only those of the
    batch are looked at further.
    """
    spark = df_new.sparkSession
    stored = spark.read.schema(df_new.schema).parquet(path)
    counts = df_new.groupBy(*key).agg(F.count("*").alias("_n"))
    known = stored.select(*key).join(counts.select(*key), list(key), "left_semi")
    refused = known.unionByName(counts.filter("_n > 1").select(*key)).distinct()
    missing = reduce(or_, [F.col(f"`{k}`").isNull() for k in key])
    rejects = df_new.join(refused, list(key), "left_semi").select(*df_new.columns).unionByName(df_new.filter(missing))
    accepted = df_new.filter(~missing).join(refused, list(key), "left_anti").select(*df_new.columns)
    # both results are fixed before the table they are compared with grows
    batch = new_folder(spark, "append_rejects")
    rejects.write.parquet(batch)
    accepted.write.mode("append").parquet(path)
    rejects = spark.read.schema(df_new.schema).parquet(batch)
    return spark.read.schema(df_new.schema).parquet(path), rejects


def retention_check(deletes: DataFrame, ts_col: str, days: int, now: Column) -> DataFrame:
    """Deletes of rows that are still inside their retention time."""
    return deletes.filter(F.col(ts_col) + F.make_dt_interval(F.lit(days)) > now)


def distribute(df: DataFrame, key: Sequence[str], n: int) -> DataFrame:
    """Rows spread over ``n`` shards by key; at run time a shard that holds too much is split."""
    return df.hint("rebalance", n, *[F.col(k) for k in key])


def duplicate(df: DataFrame, max_bytes: int = DUPLICATE_MAX_BYTES) -> DataFrame:
    """A full copy on every executor, when the table is small enough.

    The size is the sum of the rows' texts, counted over the whole table; a
    larger table is returned as it is and joins by shuffle.
    """
    size = df.agg(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0))).first()[0]
    return F.broadcast(df) if size <= max_bytes else df


def write_clustered(
    df: DataFrame, keys: Sequence[tuple[str, str]], path: str, partitions: int | None = None
) -> DataFrame:
    """Files sorted and range-split by the index keys, so that min/max statistics skip files.

    Rows that share a key value may fill several files.
    """
    by = [F.col(c).desc() if direction == "desc" else F.col(c).asc() for c, direction in keys]
    in_order(df, by, partitions=partitions).write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

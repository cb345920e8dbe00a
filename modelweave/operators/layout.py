"""R01..R07: partition layouts as derived columns, and their write."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.plans.keys import single


def range_name(column: str, bounds: Sequence[tuple[str, Any]], maximum: str | None = None) -> Column:
    """Name of the first partition whose upper bound is above the value; NULL above the last one."""
    name = F.lit(None).cast("string") if maximum is None else F.lit(maximum)
    for part, upper in reversed(list(bounds)):
        name = F.when(F.col(column) < F.lit(upper), F.lit(part)).otherwise(name)
    return name


def partition_range(
    df: DataFrame, column: str, bounds: Sequence[tuple[str, Any]], maximum: str | None = None, name: str = "p"
) -> tuple[DataFrame, DataFrame]:
    """(rows with their partition, rejects above the last bound); bounds ascend, upper ends excluded."""
    tagged = df.withColumn(name, range_name(column, bounds, maximum))
    return tagged.filter(F.col(name).isNotNull()), tagged.filter(F.col(name).isNull()).drop(name)


def interval_number(column: str, step: float, base: Any, unit: str = "number") -> Column:
    """Number of the partition of a fixed step from ``base``; unit number, day or month."""
    c = F.col(column)
    if unit == "month":
        start = F.to_date(F.lit(base))
        months = (F.year(c) - F.year(start)) * 12 + F.month(c) - F.month(start)
        # a month is over when its day of the base comes
        months = months - F.when(F.add_months(start, months) > F.to_date(c), 1).otherwise(0)
        return F.floor(months / F.lit(step)).cast("bigint")
    distance = F.datediff(c, F.to_date(F.lit(base))) if unit == "day" else c - F.lit(base)
    return F.floor(distance / F.lit(step)).cast("bigint")


def partition_interval(df: DataFrame, column: str, step: float, base: Any, unit: str = "number", name: str = "p") -> DataFrame:
    """A new partition per step, without a list of bounds."""
    return df.withColumn(name, interval_number(column, step, base, unit))


def list_name(column: str, lists: dict[str, Sequence[Any]], automatic: bool = False, default: str | None = None) -> Column:
    """Name of the partition whose list holds the value; automatic: the value itself."""
    other = F.col(column).cast("string") if automatic else F.lit(default).cast("string")
    for part, values in reversed(list(lists.items())):
        other = F.when(F.col(column).isin(*values), F.lit(part)).otherwise(other)
    return other


def partition_list(
    df: DataFrame,
    column: str,
    lists: dict[str, Sequence[Any]],
    automatic: bool = False,
    default: str | None = None,
    name: str = "p",
) -> tuple[DataFrame, DataFrame]:
    """(rows with their partition, rejects in no list)."""
    tagged = df.withColumn(name, list_name(column, lists, automatic, default))
    return tagged.filter(F.col(name).isNotNull()), tagged.filter(F.col(name).isNull()).drop(name)


def partition_hash(df: DataFrame, columns: Sequence[str], n: int, name: str = "p") -> DataFrame:
    """One of ``n`` partitions by the hash of the columns; equal keys meet."""
    return df.withColumn(name, F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int"))


def partition_by_reference(
    child: DataFrame, parent: DataFrame, fk: Sequence[tuple[str, str]], name: str = "p"
) -> tuple[DataFrame, DataFrame]:
    """(child rows in the partition of their parent row, rejects without one); ``fk`` pairs child and parent columns.

    A parent key that comes twice raises when it is read.
    """
    where = parent.groupBy(*[F.col(p).alias(f"_k{i}") for i, (_, p) in enumerate(fk)]).agg(F.count("*").alias("_n"), F.any_value(name).alias("_v"))
    where = where.select(*[f"_k{i}" for i in range(len(fk))], single("_n", "_v", name))
    hit = [child[c] == where[f"_k{i}"] for i, (c, _) in enumerate(fk)]
    tagged = child.join(where, hit, "left").select(*[child[c] for c in child.columns], name)
    return tagged.filter(F.col(name).isNotNull()), tagged.filter(F.col(name).isNull()).drop(name)


def partition_system(df: DataFrame, n: int) -> DataFrame:
    """``n`` partitions without a rule."""
    return df.repartition(n)


def partition_composite(df: DataFrame, outer: Column, inner: Column, names: tuple[str, str] = ("p", "sp")) -> DataFrame:
    """Partition and subpartition, from any two of the rules above."""
    return df.withColumns({names[0]: outer, names[1]: inner})


def write_partitioned(df: DataFrame, columns: Sequence[str], path: str) -> DataFrame:
    """Write one folder per partition value.

    The rebalance hint gathers a value in few files and splits a value that
    holds much of the table over several tasks.
    """
    placed = df.hint("rebalance", *[F.col(c) for c in columns])
    placed.write.mode("errorifexists").partitionBy(*columns).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

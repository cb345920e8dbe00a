"""Dense positions and running totals over a whole table, without a global window.

A range shuffle puts the rows in order over many partitions, the result is
stored once (a range shuffle samples, so a second run might cut elsewhere), and
each partition then only needs the total of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.plans.workspace import store

# monotonically_increasing_id() keeps the partition number above bit 33 and the
# row number inside the partition below it.
_ROW_BITS = 33
_ROW_MASK = (1 << _ROW_BITS) - 1


def sortable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return False
    if isinstance(dtype, T.ArrayType):
        return sortable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(sortable(f.dataType) for f in dtype.fields)
    return True


def _bounded(c: Column, dtype: T.DataType) -> list[Column]:
    """Order of a column in a few bytes: Spark samples the keys of a range shuffle to the driver."""
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return [F.substring(c, 1, 32), F.xxhash64(c)]
    return [F.xxhash64(c)] if isinstance(dtype, (T.ArrayType, T.StructType)) else [c]


def in_order(df: DataFrame, order: Sequence[str | Column], unique: bool = False, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted.

    Unless ``order`` is declared unique, ties are ordered by the remaining
    columns, texts by their first 32 characters and then a hash, and exact
    copies by a number, so that a third of all rows with one
    order value, or of copies of one row, still spreads over many partitions.
    The sort before the number makes it the same when a lost task runs again.
    """
    by = [F.col(c) if isinstance(c, str) else c for c in order]
    columns = df.columns
    if not unique:
        named = {c for c in order if isinstance(c, str)}
        rest = [f for f in df.schema.fields if f.name not in named and sortable(f.dataType)]
        by += [key for f in rest for key in _bounded(F.col(f"`{f.name}`"), f.dataType)]
        df = df.sortWithinPartitions(*by, *[F.col(f"`{f.name}`") for f in rest]).withColumn("_tie", F.monotonically_increasing_id())
        by.append(F.col("_tie"))
    placed = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    return placed.sortWithinPartitions(*by).select(*[F.col(f"`{c}`") for c in columns])


def _numbered(df: DataFrame, order: Sequence[str | Column], unique: bool) -> DataFrame:
    """``in_order``, stored, with ``_at`` = partition and row number."""
    return store(in_order(df, order, unique).withColumn("_at", F.monotonically_increasing_id()), "ordered")


def _offsets(placed: DataFrame, amount: Column) -> DataFrame:
    """Total of all partitions before each partition: one row per range partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = placed.groupBy("_part").agg(F.sum(amount).alias("_sum"))
    return sums.select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))


def dense_index(df: DataFrame, order: Sequence[str | Column], name: str = "idx", unique: bool = False) -> DataFrame:
    """0-based position of each row in ``order``; runs one range shuffle and one write."""
    placed = _numbered(df, order, unique).withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    # broadcast is bounded: one row per shuffle partition
    offsets = F.broadcast(_offsets(placed, F.lit(1)))
    position = F.col("_before") + F.col("_at").bitwiseAND(F.lit(_ROW_MASK))
    return placed.join(offsets, "_part").select(*df.columns, position.alias(name))


def running_total(df: DataFrame, order: Sequence[str | Column], amount: str, name: str) -> DataFrame:
    """Sum of ``amount`` over all rows before this one in ``order``."""
    placed = _numbered(df, order, unique=False).withColumn("_part", F.shiftrightunsigned("_at", _ROW_BITS))
    offsets = F.broadcast(_offsets(placed, F.col(amount)))
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return (
        placed.withColumn("_local", local)
        .join(offsets, "_part")
        .select(*df.columns, (F.col("_before") + F.col("_local")).alias(name))
    )

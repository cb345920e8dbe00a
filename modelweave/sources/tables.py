"""S01..S03: table scans and samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Scan of one table; filters and column choice of the caller reach the files."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sample_rows(df: DataFrame, columns: Sequence[str], n: int, order_by: Sequence[str]) -> DataFrame:
    """The first ``n`` rows by ``order_by`` (a top-k, not a full sort)."""
    return df.orderBy(*order_by).limit(n).select(*columns)


def sample_size(df: DataFrame, mode: str, value: float, max_value: int | None = None) -> DataFrame:
    """One row ``sample_size``: the given number, or a capped share of the row count."""
    if mode == "absolute":
        return df.sparkSession.range(1).select(F.lit(int(value)).cast("long").alias("sample_size"))
    # decimal share, so that 3.3 % of 1000 is 33 and not 33.000000000000004
    share = F.ceil(F.count("*") * F.lit(str(value)).cast("decimal(12,6)") / F.lit(100)).cast("long")
    if max_value is not None:
        share = F.least(share, F.lit(max_value).cast("long"))
    return df.agg(share.alias("sample_size"))

"""Values on a line: numbers, days and times as doubles, in their own order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def on_a_line(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))


def as_number(c: Column, dtype: T.DataType) -> Column:
    """Microseconds of times, days of dates, numbers as they are."""
    if isinstance(dtype, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c).cast("double")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, T.DateType):
        return F.unix_date(c).cast("double")
    return c.cast("double")

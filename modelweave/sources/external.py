"""External tables over a list of files, with a reject limit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.plans.workspace import store

_BAD = "_corrupt_record"


def read_external(
    spark: SparkSession,
    paths: Sequence[str],
    fmt: str,
    schema: T.StructType,
    reject_limit: int | None = None,
    **options: str,
) -> tuple[DataFrame, DataFrame]:
    """Rows and rejected lines; fails when more lines are rejected than ``reject_limit`` (None: no limit).

    One pass finds the rejected lines and stores them. Rows are read from the
    files themselves; whatever columns of them are used, a line is parsed whole,
    so that a fault in another column rejects it all the same.
    """
    parsed = (
        spark.read.format(fmt)
        .schema(T.StructType([*schema.fields, T.StructField(_BAD, T.StringType())]))
        .options(mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, **options)
        .load(list(paths))
    )
    # always true, but only known from all columns
    fields = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, T.MapType) else F.col(f"`{f.name}`") for f in schema.fields]
    parsed = parsed.filter(F.xxhash64(*fields) >= -(1 << 63))
    found = parsed.filter(F.col(_BAD).isNotNull()).select(F.col(_BAD).alias("line"))
    rejects = store(found, "rejects")
    if reject_limit is not None and (count := rejects.count()) > reject_limit:
        raise ValueError(f"{count} rejected lines, limit is {reject_limit}")
    return parsed.filter(F.col(_BAD).isNull()).drop(_BAD), rejects

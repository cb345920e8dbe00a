"""Append-only tables of live files, where a batch opens only the files that may hold its keys."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.operators.intervals import interval_join
from modelweave.plans.lines import as_number, on_a_line
from modelweave.plans.workspace import store
from modelweave.sources.live import LiveTables

OVERLAP = 16  # files that hold one point of the key's line, on average, for their ranges to say something


def files_with_keys(live: LiveTables, table: str, batch: DataFrame, key: str) -> list[str]:
    """Names of the live files whose key range holds a key of the batch; files without a range count as well."""
    names = [f.rpartition("/")[2] for f in live.files[table]]
    dtype = batch.schema[key].dataType
    known = [(n, *live.ranges[n]) for n in names if n in live.ranges]
    if not known or not on_a_line(dtype):
        return names
    span = max(h for _, _, h in known) - min(low for _, low, _ in known)
    if sum(h - low for _, low, h in known) > OVERLAP * span:
        return names
    ranges = live.spark.createDataFrame(known, "_name string, _low double, _high double")
    keys = batch.select(as_number(F.col(f"`{key}`"), dtype).alias("_x")).distinct()
    met = interval_join(ranges, keys, "_low", "_high", "_x").select("_name").distinct()
    return [r[0] for r in met.collect()] + [n for n in names if n not in live.ranges]


def append_rows(live: LiveTables, table: str, batch: DataFrame, key: Sequence[str]) -> tuple[LiveTables, DataFrame]:
    """(the next version, rejected rows): rows with a new key are appended, stored rows never change.

    A key that is stored, comes twice in the batch, or has a NULL part is
    refused. The key ranges of the files are joined with the keys of the batch
    first; of a table that grows along its key only the last files are read.
    """
    batch = store(batch.select(*live.schemas[table].names), "batch")
    missing = reduce(or_, [F.col(f"`{k}`").isNull() for k in key])
    whole = batch.filter(~missing)
    counts = whole.groupBy(*key).agg(F.count("*").alias("_n"))
    near = live.read(table, files_with_keys(live, table, whole, key[0]))
    known = near.select(*key).join(counts.select(*key), list(key), "left_semi")
    refused = store(known.unionByName(counts.filter("_n > 1").select(*key)).distinct(), "refused")
    rejects = whole.join(refused, list(key), "left_semi").select(*batch.columns).unionByName(batch.filter(missing))
    fresh = whole.join(refused, list(key), "left_anti").select(*batch.columns)
    files = [] if fresh.isEmpty() else live.add(table, fresh, list(key))
    return live.commit({}, {table: files}), rejects

"""Tables as sets of live files: a change writes new files and a new list, and leaves all other files alone.

The lists are versions below ``_live`` of one folder for all its tables, so one
new list makes a change of several tables visible at once. A version counts when
it is complete; two writers that start from one version cannot both make the
next. Files that no version lists any more are left to a clean-up. A list also
keeps the range of the first key column of each file, where it is a number or a
time, so that a reader of some keys opens the files that may hold them.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from math import inf, nextafter
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.plans.lines import as_number, on_a_line
from modelweave.plans.positions import in_order

_LIST = "table_name string, file_name string, schema string, low double, high double"


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


@dataclass
class LiveTables:
    """The tables of a folder as of one version."""

    spark: SparkSession
    folder: str
    version: int
    files: dict[str, list[str]]
    schemas: dict[str, T.StructType]
    ranges: dict[str, tuple[float, float]] = field(default_factory=dict)  # by file name without folder

    def read(self, table: str, only: Iterable[str] | None = None) -> DataFrame:
        """Rows of the live files, or of those named in ``only``."""
        wanted = None if only is None else set(only)
        chosen = [f for f in self.files[table] if wanted is None or f.rpartition("/")[2] in wanted]
        if not chosen:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*[f"{self.folder}/{f}" for f in chosen])

    def read_with_file(self, table: str, name: str = "_file") -> DataFrame:
        """All rows with the name of the file that holds them; file names are used once."""
        if not self.files[table]:
            return self.read(table).withColumn(name, F.lit(None).cast("string"))
        rows = self.read(table)
        return rows.select("*", F.col("_metadata.file_name").alias(name))

    def add(self, table: str, rows: DataFrame, keys: Sequence[str] = (), partitions: int | None = None, unique: bool = False) -> list[str]:
        """Write rows as new files, in ranges of ``keys``; they are not live before ``commit``.

        Without ``partitions`` the number of files follows the size. ``unique``
        trusts that keys seldom come twice and saves the sorts that spread ties;
        rows of one key then stay in one file.
        """
        place = f"{table}/{uuid4().hex}"
        (in_order(rows, list(keys), unique, partitions) if keys else rows).write.parquet(f"{self.folder}/{place}")
        system, path = _hadoop(self.spark, f"{self.folder}/{place}")
        names = [s.getPath().getName() for s in system.listStatus(path) if s.getPath().getName().startswith("part-") and s.getLen() > 0]
        if names and keys and on_a_line(rows.schema[keys[0]].dataType):
            stored = self.spark.read.schema(rows.schema).parquet(f"{self.folder}/{place}")
            at = as_number(F.col(f"`{keys[0]}`"), rows.schema[keys[0]].dataType)
            ends = stored.select(F.col("_metadata.file_name").alias("f"), at.alias("x")).groupBy("f").agg(F.min("x"), F.max("x"))
            # one step wider, as a long may lie between two doubles
            self.ranges |= {r[0]: (nextafter(r[1], -inf), nextafter(r[2], inf)) for r in ends.collect() if r[1] is not None}
        return [f"{place}/{name}" for name in names]

    def commit(self, gone: dict[str, Iterable[str]], added: dict[str, list[str]], schemas: dict[str, T.StructType] | None = None) -> "LiveTables":
        """The next version: without the files named in ``gone``, with those in ``added``."""
        schemas = {**self.schemas, **(schemas or {})}
        files = {}
        for table in schemas:
            lost = set(gone.get(table, ()))
            kept = [f for f in self.files.get(table, []) if f.rpartition("/")[2] not in lost]
            files[table] = kept + added.get(table, [])
        ends = lambda f: self.ranges.get(f.rpartition("/")[2], (None, None))
        rows = [(t, f, None, *ends(f)) for t, names in files.items() for f in names] + [(t, None, s.json(), None, None) for t, s in schemas.items()]
        path = f"{self.folder}/_live/{self.version + 1:010d}"
        self.spark.createDataFrame(rows, _LIST).coalesce(1).write.mode("errorifexists").parquet(path)
        return LiveTables(self.spark, self.folder, self.version + 1, files, schemas, dict(self.ranges))


def open_tables(spark: SparkSession, folder: str) -> LiveTables:
    """The last complete version of a folder; an empty one has no tables."""
    system, path = _hadoop(spark, f"{folder}/_live")
    versions = [s.getPath().getName() for s in system.listStatus(path)] if system.exists(path) else []
    done = [v for v in versions if system.exists(_hadoop(spark, f"{folder}/_live/{v}/_SUCCESS")[1])]
    if not done:
        return LiveTables(spark, folder, 0, {}, {})
    last = max(done)
    # one entry per file, which the driver holds for a scan anyway
    rows = spark.read.schema(_LIST).parquet(f"{folder}/_live/{last}").collect()
    schemas = {r["table_name"]: T.StructType.fromJson(json.loads(r["schema"])) for r in rows if r["schema"]}
    files: dict[str, list[str]] = {t: [] for t in schemas}
    for r in rows:
        if r["file_name"]:
            files[r["table_name"]].append(r["file_name"])
    ranges = {r["file_name"].rpartition("/")[2]: (r["low"], r["high"]) for r in rows if r["low"] is not None}
    return LiveTables(spark, folder, int(last), {t: sorted(f) for t, f in files.items()}, schemas, ranges)


def create_tables(spark: SparkSession, folder: str, tables: dict[str, DataFrame], keys: dict[str, Sequence[str]], partitions: int | None = None, unique: bool = False) -> LiveTables:
    """First version of ``tables``, each in files of ranges of its keys; see ``LiveTables.add``."""
    empty = open_tables(spark, folder)
    if empty.version:
        raise ValueError(f"{folder} has tables already")
    added = {name: empty.add(name, df, keys.get(name, ()), partitions, unique) for name, df in tables.items()}
    return empty.commit({}, added, {name: df.schema for name, df in tables.items()})

"""Kinds of values at every path of JSON columns, through objects and lists to the last level."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.functions.scalars import variant_kind

_TEXT = r'"(?:[^"\\]|\\.)*+"'


def _depth(text: str) -> Column:
    """Brackets of a JSON text that are open at once, at most; those inside of texts do not count."""
    bare = F.regexp_replace(F.regexp_replace(F.col(f"`{text}`"), _TEXT, ""), r"[^\[\]{}]+", "")
    # after each bracket: how many are open now, and the most so far
    opens = lambda c: F.when(c.isin("[", "{"), 1).otherwise(-1)
    step = lambda a, c: F.struct((a["now"] + opens(c)).alias("now"), F.greatest(a["most"], a["now"] + opens(c)).alias("most"))
    brackets = F.filter(F.split(bare, ""), lambda c: c != "")
    return F.aggregate(brackets, F.struct(F.lit(0).alias("now"), F.lit(0).alias("most")), step, lambda a: a["most"])


def json_depth(df: DataFrame, columns: Sequence[str]) -> int:
    """Levels of objects and lists in the deepest value of JSON columns; one aggregate."""
    found = [F.max(F.when(F.try_parse_json(c).isNotNull(), _depth(c))) for c in columns]
    return max((n or 0 for n in df.agg(*found).first()), default=0)


def _below(e: Column) -> Column:
    """(path, v) of what stands in a value: members as ``path.name``, entries of a list as ``path[]``."""
    members = F.map_entries(F.try_variant_get(e["v"], F.lit("$"), "map<string,variant>"))
    items = F.try_variant_get(e["v"], F.lit("$"), "array<variant>")
    dot = F.when(e["path"] == "", F.lit("")).otherwise(F.lit("."))
    named = F.transform(members, lambda m: F.struct(F.concat(e["path"], dot, m["key"]).alias("path"), m["value"].alias("v")))
    listed = F.transform(items, lambda x: F.struct(F.concat(e["path"], F.lit("[]")).alias("path"), x.alias("v")))
    return F.coalesce(named, listed, F.array().cast("array<struct<path:string,v:variant>>"))


def _named(column: str) -> Callable[[Column], Column]:
    return lambda e: F.struct(F.lit(column).alias("column_name"), e["path"].alias("path"), variant_kind(e["v"]).alias("kind"))


def path_kinds(df: DataFrame, columns: Sequence[str], depth: int | None = None) -> DataFrame:
    """(column_name, path, kind, n) over all values that parse; the value itself has the path ''.

    Every level is made from the one above it inside its row, so that all levels
    of all columns are one scan and one shuffle of counts. Without ``depth`` an
    aggregate measures it first.
    """
    if depth is None:
        depth = json_depth(df, columns)
    rows = df
    levels: list[Column] = []
    for i, c in enumerate(columns):
        root = F.array(F.struct(F.lit("").alias("path"), F.try_parse_json(c).alias("v")))
        rows = rows.withColumn(f"_{i}_0", F.filter(root, lambda e: e["v"].isNotNull()))
        for k in range(depth):
            rows = rows.withColumn(f"_{i}_{k + 1}", F.flatten(F.transform(f"_{i}_{k}", _below)))
        levels += [F.transform(f"_{i}_{k}", _named(c)) for k in range(depth + 1)]
    every = rows.select(F.explode(F.flatten(F.array(*levels))).alias("_e")).select("_e.*")
    return every.groupBy("column_name", "path", "kind").agg(F.count("*").alias("n"))

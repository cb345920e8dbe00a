"""E01..E11: moving a table from one model version to the next."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.plans.paths import json_depth, path_kinds
from modelweave.model import Column as ColumnDef
from modelweave.model import ForeignKey, Step
from modelweave.operators.joins import fk_orphans
from modelweave.operators.projections import generated_column
from modelweave.operators.sequences import assign_identity
from modelweave.operators.types import cast_check, lossy


def add_column(df: DataFrame, column: ColumnDef, order: Sequence[str] = ()) -> DataFrame:
    """A new column with its generated rule, identity or default, in its declared type."""
    if column.name in df.columns:
        raise ValueError(f"{column.name} is there already")
    made = column.generated
    if made is not None and made.as_identity:
        df = assign_identity(df, column.name, order or df.columns, made)
    elif made is not None and made.expression.strip():
        df = generated_column(df, column.name, made.expression)
    else:
        df = df.withColumn(column.name, F.expr(column.default) if column.default else F.lit(None))
    return df.withColumn(column.name, F.col(column.name).cast(column.type))


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Destructive; a plan runs it only when drops are allowed."""
    return df.drop(name)


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """E03"""
    if new in df.columns:
        raise ValueError(f"{new} is there already")
    return df.withColumnRenamed(old, new)


def change_type(df: DataFrame, name: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the new type, rejected rows with ``reasons``): no counterpart, or changed by the cast."""
    value, reason = cast_check(df, name, target)
    rejects = df.filter(reason.isNotNull()).withColumn("reasons", F.array(reason))
    return df.filter(reason.isNull()).withColumn(name, value), rejects


def _at(value: Column, dtype: T.DataType, path: Sequence[str], edit: Callable[[Column, T.DataType], Column]) -> Column:
    """``value`` with ``edit`` applied to the struct at ``path``; steps through lists entry by entry."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: _at(x, dtype.elementType, path, edit))
    if not path:
        return edit(value, dtype)
    below = _at(value[path[0]], dtype[path[0]].dataType, path[1:], edit)
    return F.when(value.isNotNull(), value.withField(path[0], below))


def edit_path(df: DataFrame, path: str, edit: Callable[[Column, T.DataType], Column]) -> DataFrame:
    """Apply ``edit`` to the struct that ``path`` names."""
    top, *rest = path.split(".")
    return df.withColumn(top, _at(F.col(top), df.schema[top].dataType, rest, edit))


def _split(path: str) -> tuple[str, str]:
    block, _, name = path.rpartition(".")
    return block, name


def add_field(df: DataFrame, path: str, value: Column | Any) -> DataFrame:
    """A new attribute at ``path``; NULL structs stay NULL."""
    block, name = _split(path)
    value = value if isinstance(value, Column) else F.lit(value)
    return edit_path(df, block, lambda s, _: F.when(s.isNotNull(), s.withField(name, value)))


def drop_field(df: DataFrame, path: str) -> DataFrame:
    """Destructive, like E02."""
    block, name = _split(path)
    return edit_path(df, block, lambda s, _: F.when(s.isNotNull(), s.dropFields(name)))


def rename_field(df: DataFrame, path: str, new: str) -> DataFrame:
    """Another name, the values and their place stay."""
    block, name = _split(path)

    def edit(s: Column, dtype: T.StructType) -> Column:
        fields = [s[f.name].alias(new if f.name == name else f.name) for f in dtype.fields]
        return F.when(s.isNotNull(), F.struct(*fields))

    return edit_path(df, block, edit)


def change_field_type(df: DataFrame, path: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(rows in the new type, rejects): a row is rejected when a value at ``path`` has no counterpart or changes."""
    block, name = _split(path)
    bad = _any_lost(F.col(block.split(".")[0]), df.schema[block.split(".")[0]].dataType, block.split(".")[1:], name, target)
    bad = F.coalesce(bad, F.lit(False))
    rejects = df.filter(bad).withColumn("reasons", F.array(F.lit(f"{path}: no {target}")))
    good = edit_path(
        df.filter(~bad), block, lambda s, _: F.when(s.isNotNull(), s.withField(name, s[name].try_cast(target)))
    )
    return good, rejects


def _any_lost(value: Column, dtype: T.DataType, path: Sequence[str], name: str, target: str) -> Column:
    if isinstance(dtype, T.ArrayType):
        return F.exists(value, lambda x: F.coalesce(_any_lost(x, dtype.elementType, path, name, target), F.lit(False)))
    if path:
        return _any_lost(value[path[0]], dtype[path[0]].dataType, path[1:], name, target)
    source, result = value[name], value[name].try_cast(target)
    return source.isNotNull() & (result.isNull() | F.coalesce(lossy(source, dtype[name].dataType, result, target), F.lit(False)))


def revalidate_fk(frames: dict[str, DataFrame], changes: Sequence[tuple[str, ForeignKey]]) -> DataFrame:
    """(constraint, action, orphans) of added and modified foreign keys; incomplete ones are skipped.

    Dropped keys need no check and are left out.
    """
    parts = []
    for action, fk in changes:
        complete = all([fk.name, fk.child, fk.parent, fk.columns, fk.parent_columns])
        if action == "drop" or not complete or not fk.active:
            continue
        lost = fk_orphans(frames[fk.child], frames[fk.parent], fk.columns, fk.parent_columns)
        parts.append(
            lost.agg(F.count("*").alias("orphans")).select(
                F.lit(fk.name).alias("constraint_name"), F.lit(action).alias("action"), "orphans"
            )
        )
    if not parts:
        spark = next(iter(frames.values())).sparkSession
        return spark.createDataFrame([], "constraint_name string, action string, orphans bigint")
    return reduce(DataFrame.unionByName, parts)


_ORDER = {"add": 0, "drop": 1, "rename": 2, "type": 3}


def evolve(df: DataFrame, plan: Sequence[Step], allow_drops: bool = False) -> tuple[DataFrame, DataFrame | None, list[Step]]:
    """(rows after the plan, rejects or None, skipped steps) as one lazy plan.

    Steps run in the order add, drop, rename, type. Drops stay out unless
    allowed, inactive steps always. A dotted column is a nested attribute.
    """
    skipped = [s for s in plan if not s.active or (s.action == "drop" and not allow_drops)]
    rejects: list[DataFrame] = []
    for step in sorted([s for s in plan if s not in skipped], key=lambda s: _ORDER[s.action]):
        nested = "." in step.column
        if step.action == "add":
            df = add_field(df, step.column, step.to) if nested else add_column(df, step.to)
        elif step.action == "drop":
            df = drop_field(df, step.column) if nested else drop_column(df, step.column)
        elif step.action == "rename":
            df = rename_field(df, step.column, step.to) if nested else rename_column(df, step.column, step.to)
        else:
            df, bad = (change_field_type if nested else change_type)(df, step.column, step.to)
            text = F.to_json(F.struct(*[c for c in bad.columns if c != "reasons"])).alias("row")
            rejects.append(bad.select(text, "reasons"))
    return df, (reduce(DataFrame.unionByName, rejects) if rejects else None), skipped


def _kinds(df: DataFrame, json_col: str, side: str, depth: int) -> DataFrame:
    """(field, kinds, rows) of all paths of a JSON column; a path has at most six kinds."""
    counts = path_kinds(df, [json_col], depth).filter("path <> ''")
    return counts.groupBy(F.col("path").alias("field")).agg(
        F.array_join(F.sort_array(F.collect_set("kind")), ",").alias(f"{side}_kinds"),
        F.sum("n").alias(f"{side}_rows"),
    )


def field_drift(old: DataFrame, new: DataFrame, json_col: str, depth: int | None = None) -> DataFrame:
    """(field, change, kinds and rows before and after) of a JSON column in two snapshots.

    Fields of nested objects are named by their path, entries of a list by
    ``[]`` behind it, at every depth; ``depth`` stops there instead, and saves
    the pass that measures it. Entries are counted per (field, kind) first; what
    meets in the join are these few lines.
    """
    if depth is None:
        depth = max(json_depth(old, [json_col]), json_depth(new, [json_col]))
    a, b = _kinds(old, json_col, "old", depth), _kinds(new, json_col, "new", depth)
    change = (
        F.when(F.col("old_kinds").isNull(), "added")
        .when(F.col("new_kinds").isNull(), "dropped")
        .when(F.col("old_kinds") != F.col("new_kinds"), "type changed")
        .otherwise("same")
    )
    joined = a.join(b, "field", "full_outer")
    return joined.select("field", change.alias("change"), "old_kinds", "new_kinds", "old_rows", "new_rows")

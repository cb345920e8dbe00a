"""M01..M09: rules that bring nested records of an older version to a newer one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.operators.evolution import edit_path
from modelweave.plans.pages import PAGE_ROWS, collect_groups


def _type_at(schema: T.StructType, path: str) -> T.DataType | None:
    dtype: T.DataType = schema
    for part in path.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            return None
        dtype = dtype[part].dataType
    return dtype


def _put(df: DataFrame, path: str, value: Column) -> DataFrame:
    """``value`` at ``path``; structs on the way are made where they are missing."""
    top, *rest = path.split(".")
    if not rest:
        return df.withColumn(top, value)

    def place(current: Column | None, dtype: T.DataType | None, parts: Sequence[str]) -> Column:
        if not parts:
            return value
        head, *tail = parts
        if not isinstance(dtype, T.StructType):
            made = F.struct(place(None, None, tail).alias(head))
            return F.when(value.isNotNull(), made)
        inner = place(current[head] if head in dtype.names else None, dtype[head].dataType if head in dtype.names else None, tail)
        fields = [current[n].alias(n) for n in dtype.names if n != head]
        names = [n for n in dtype.names if n != head]
        order = [*names[: dtype.names.index(head)], head, *names[dtype.names.index(head) :]] if head in dtype.names else [*names, head]
        by_name = {**dict(zip(names, fields)), head: inner.alias(head)}
        made = F.struct(*[by_name[n] for n in order])
        return F.when(current.isNotNull() | value.isNotNull(), made)

    current = F.col(top) if top in df.columns else None
    dtype = df.schema[top].dataType if top in df.columns else None
    return df.withColumn(top, place(current, dtype, rest))


def _cut(df: DataFrame, path: str) -> DataFrame:
    """Without the value at ``path``; a struct left empty goes as well."""
    block, _, name = path.rpartition(".")
    if not block:
        return df.drop(path)
    dtype = _type_at(df.schema, block)
    if dtype is None:
        return df
    if list(dtype.names) == [name]:
        return _cut(df, block)
    return edit_path(df, block, lambda s, _: F.when(s.isNotNull(), s.dropFields(name)))


def set_where(df: DataFrame, match: dict[str, Any], values: dict[str, Any], only: Column | None = None) -> DataFrame:
    """Records that have all the given values get new ones."""
    hit = F.coalesce(reduce(and_, [F.col(k) == v for k, v in match.items()]), F.lit(False))
    return _assign(df, hit, values, only)


def _assign(df: DataFrame, hit: Column, values: dict[str, Any], only: Column | None) -> DataFrame:
    # the condition is taken before any value changes
    df = df.withColumn("_hit", hit if only is None else hit & only)
    for path, value in values.items():
        dtype = _type_at(df.schema, path)
        if dtype is None:
            df = _put(df, path, F.when(F.col("_hit"), F.lit(value)))
        else:
            df = _put(df, path, F.when(F.col("_hit"), F.lit(value).cast(dtype)).otherwise(F.col(path)))
    return df.drop("_hit")


def move_path(df: DataFrame, source: str, target: str) -> DataFrame:
    """A nested value at another path; a record without it keeps what the target holds."""
    if _type_at(df.schema, source) is None:
        return df
    # kept aside, so that the target may lie inside the source or beside it
    there = _type_at(df.schema, target) is not None
    df = df.withColumn("_moved", F.coalesce(F.col(source), F.col(target)) if there else F.col(source))
    df = _cut(df, source)
    return _put(df, target, F.col("_moved")).drop("_moved")


def rename_block(df: DataFrame, old: str, new: str, sub: dict[str, str]) -> DataFrame:
    """A block and its attributes under other names."""
    dtype = _type_at(df.schema, old)
    if dtype is None:
        return df
    fields = [F.col(old)[n].alias(sub.get(n, n)) for n in dtype.names]
    renamed = F.when(F.col(old).isNotNull(), F.struct(*fields))
    if "." not in old and "." not in new:
        return df.select(*[renamed.alias(new) if c == old else F.col(c) for c in df.columns])
    df = df.withColumn("_block", renamed)
    return _put(_cut(df, old), new, F.col("_block")).drop("_block")


def add_missing_id(
    df: DataFrame, block: str, path: str, key: Sequence[str], only: Column | None = None
) -> DataFrame:
    """An id for a block without one, from the key of the record, so that a second run gives the same."""
    made = F.sha2(F.to_json(F.struct(F.lit(block).alias("block"), *key)), 256)
    present = F.col(block).isNotNull() if only is None else F.col(block).isNotNull() & only
    known = F.col(path) if _type_at(df.schema, path) is not None else F.lit(None).cast("string")
    return _put(df, path, F.coalesce(known, F.when(present, made)))


def add_fields(df: DataFrame, path: str, values: dict[str, Any], only: Column | None = None) -> DataFrame:
    """Constants below ``path``, where that block exists."""
    if _type_at(df.schema, path) is None:
        return df
    df = df.withColumn("_hit", F.col(path).isNotNull() if only is None else F.col(path).isNotNull() & only)
    for name, value in values.items():
        full = f"{path}.{name}"
        dtype = _type_at(df.schema, full)
        old = F.col(full) if dtype is not None else F.lit(None)
        df = _put(df, full, F.when(F.col("_hit"), F.lit(value)).otherwise(old))
    return df.drop("_hit")


def remove_fields(df: DataFrame, path: str, names: Sequence[str]) -> DataFrame:
    """The named attributes below ``path`` go."""
    for name in names:
        full = f"{path}.{name}" if path else name
        if _type_at(df.schema, full) is not None:
            df = _cut(df, full)
    return df


_KINDS = {
    "object": (T.StructType, T.MapType),
    "array": (T.ArrayType,),
    "string": (T.StringType,),
    "boolean": (T.BooleanType,),
    "number": (T.NumericType,),
}


def condition(df: DataFrame, tree: dict[str, Any]) -> Column:
    """A condition tree as a column: not, and, or over tests of a key: value, exist, valueType."""
    kind = tree.get("type")
    if kind == "not":
        return ~reduce(and_, [condition(df, t) for t in tree["values"]])
    if kind == "and":
        return reduce(and_, [condition(df, t) for t in tree["values"]])
    if kind == "or":
        return ~reduce(and_, [~condition(df, t) for t in tree["values"]])
    dtype = _type_at(df.schema, tree["key"])
    if "exist" in tree:
        there = F.lit(False) if dtype is None else F.col(tree["key"]).isNotNull()
        return there if tree["exist"] else ~there
    if dtype is None:
        return F.lit(False)
    if "valueType" in tree:
        return F.col(tree["key"]).isNotNull() & F.lit(isinstance(dtype, _KINDS[tree["valueType"]]))
    return F.col(tree["key"]).eqNullSafe(F.lit(tree["value"]))


def assign_if(df: DataFrame, tree: dict[str, Any], values: dict[str, Any], only: Column | None = None) -> DataFrame:
    """New values where the condition tree holds."""
    return _assign(df, condition(df, tree), values, only)


def flags_to_lists(
    df: DataFrame, key: Sequence[str], flags: Sequence[str], name: str = "flags", item: str = "", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Flags set on single items as one ordered list per parent.

    The list holds the flag names in the order of ``flags``; with ``item`` the
    values of that column, one list per (key, flag).
    """
    pairs = F.array(*[F.struct(F.lit(i).alias("pos"), F.lit(f).alias("flag"), F.col(f).cast("boolean").alias("on")) for i, f in enumerate(flags)])
    items = df.select(*key, *([item] if item else []), F.explode(pairs).alias("_e")).filter("_e.on")
    if item:
        lists, _ = collect_groups(
            items.withColumn("flag", F.col("_e.flag")), [*key, "flag"], F.col(item), (), name, page_rows=page_rows
        )
        return lists.select(*key, "flag", name, F.col("_page").alias("page"))
    each = items.select(*key, F.struct("_e.pos", "_e.flag").alias("_f")).distinct()
    # at most one entry per flag and key
    lists = each.groupBy(*key).agg(F.sort_array(F.collect_list("_f")).alias("_l"))
    return lists.select(*key, F.transform("_l", lambda x: x["flag"]).alias(name))


@dataclass(frozen=True)
class Rule:
    """One rule as data: ``op`` is a function of this module, ``args`` its arguments after the frame."""

    op: str
    args: dict[str, Any] = field(default_factory=dict)


_OPS = {
    f.__name__: f
    for f in (set_where, move_path, rename_block, add_missing_id, add_fields, remove_fields, assign_if)
}


_VERSION = r"^[0-9]{1,9}([.][0-9]{1,9})*$"


def version_parts(c: Column) -> Column:
    """0.2.17 as [0, 2, 17], without zeros at the end; NULL if it is no version. Arrays compare part by part, whatever their lengths."""
    significant = F.regexp_replace(c, "([.]0+)+$", "")
    return F.when(c.rlike(_VERSION), F.transform(F.split(significant, "[.]"), lambda p: p.try_cast("bigint")))


def _parts(version: str) -> list[int]:
    numbers = [int(p) for p in version.split(".")]
    while len(numbers) > 1 and not numbers[-1]:
        numbers.pop()
    return numbers


def migrate(df: DataFrame, version_col: str, target: str, rules: dict[str, Sequence[Rule]]) -> tuple[DataFrame, DataFrame]:
    """(records at their new version, rejects whose version does not parse).

    A record goes through the rules of all versions above its own, up to
    ``target``, in numeric order; no rule touches a record that is as new. The
    records are split by how many versions they have to go through, so a field
    that a rule removes stays for the newer records that hold it.
    """
    steps = [v for v in sorted(rules, key=_parts) if _parts(v) <= _parts(target)]
    own = version_parts(F.col(version_col))
    number = [F.array(*[F.lit(p).cast("bigint") for p in _parts(v)]) for v in steps]
    done = []
    for k in range(len(steps) + 1):
        # above version k - 1 and below version k
        inside = own.isNotNull()
        if k:
            inside = inside & (own >= number[k - 1])
        if k < len(steps):
            inside = inside & (own < number[k])
        some = df.filter(inside)
        for version in steps[k:]:
            for rule in rules[version]:
                some = _OPS[rule.op](some, **rule.args)
        done.append(some.withColumn(version_col, F.lit(steps[-1])) if k < len(steps) else some)
    rejects = df.filter(own.isNull()).withColumn("reasons", F.array(F.lit(f"{version_col}: no version")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), done), rejects

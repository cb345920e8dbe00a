"""P01..P12: columns, filters, defaults and generated values."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelweave.functions.scalars import trim_all

from modelweave.plans.keys import tied



def project(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns; an unknown name gives an empty text column."""
    return df.select(*[F.col(n) if n in df.columns else F.lit(None).cast("string").alias(n) for n in names])


def view_project(frames: dict[str, DataFrame], columns: Sequence[tuple[str, str, str]], on: str = "") -> DataFrame:
    """View columns as (table, column, name); several tables need the join text ``on``."""
    used = list(dict.fromkeys(t for t, _, _ in columns))
    view = frames[used[0]].alias(used[0])
    tied(on, used)
    for table in used[1:]:
        view = view.join(frames[table].alias(table))
    if on.strip():
        view = view.filter(F.expr(on))
    return view.select(
        *[F.col(f"{t}.{c}") if not name or name == c else F.col(f"{t}.{c}").alias(name) for t, c, name in columns]
    )


def view_sql(spark: SparkSession, select_statement: str, **tables: DataFrame) -> DataFrame:
    """A select text; ``${name}`` in it stands for the frame given under that name."""
    if not tables:
        return spark.sql(select_statement)
    parts = re.split(r"\$\{(\w+)\}", select_statement)
    # other braces are part of the text
    text = [p.replace("{", "{{").replace("}", "}}") if i % 2 == 0 else f"{{{p}}}" for i, p in enumerate(parts)]
    return spark.sql("".join(text), **tables)


def select_by_type(df: DataFrame, types: Iterable[str]) -> DataFrame:
    """The columns whose type name is in ``types``."""
    wanted = set(types)
    return df.select(*[f.name for f in df.schema.fields if f.dataType.simpleString() in wanted])


def filter_optional(df: DataFrame, predicates: Iterable[Column | str | None]) -> DataFrame:
    """All predicates that are set, joined by AND; none set keeps every row."""
    set_ones = [p for p in predicates if p is not None and not (isinstance(p, str) and not p.strip())]
    given = [F.expr(p) if isinstance(p, str) else p for p in set_ones]
    return df.filter(reduce(and_, given)) if given else df


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    """P06"""
    return df.filter(F.col(column).isNotNull())


def check_violations(df: DataFrame, name: str, expression: str) -> DataFrame:
    """Rows for which the check is FALSE; NULL passes."""
    return df.filter(~F.coalesce(F.expr(expression), F.lit(True))).withColumn("constraint_name", F.lit(name))


def filtered_view(df: DataFrame, where: str) -> DataFrame:
    """Rows a view with a root filter shows."""
    return df.filter(F.expr(where)) if where.strip() else df


def check_option_rejects(df: DataFrame, where: str) -> DataFrame:
    """Rows that may not be written through the view (WITH CHECK OPTION: NULL is refused too)."""
    return df.filter(~F.coalesce(F.expr(where), F.lit(False))) if where.strip() else df.limit(0)


def generated_column(df: DataFrame, name: str, expression: str) -> DataFrame:
    """GENERATED ALWAYS AS (expression)."""
    return df.withColumn(name, F.expr(expression.strip()))


def fill_default(df: DataFrame, name: str, expression: object, on_null: bool = False) -> DataFrame:
    """P10: value of an absent column; ``on_null`` also replaces NULL. 0 is a default, an empty text is none."""
    if expression is None or (isinstance(expression, str) and not expression.strip()):
        return df
    value = F.expr(expression) if isinstance(expression, str) else F.lit(expression)
    if name not in df.columns:
        return df.withColumn(name, value)
    return df.withColumn(name, F.coalesce(F.col(name), value)) if on_null else df


def split_by(df: DataFrame, predicate: Column | str, missing: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows that hold, the others); ``missing`` decides for NULL (True for an active flag)."""
    test = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(missing))
    return df.filter(test), df.filter(~test)


def drop_blank(df: DataFrame, text: str) -> DataFrame:
    """Trimmed texts without the blank ones; a group of blanks only vanishes with them."""
    trimmed = trim_all(text)
    return df.filter(trimmed != "").withColumn(text, trimmed)

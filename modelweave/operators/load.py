"""T01, P09, P10, Q01 together: rows loaded into a declared table."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.model import Column as Declared
from modelweave.model import Generated, Table
from modelweave.operators.aggregates import _row_tests
from modelweave.operators.sequences import assign_identity
from modelweave.operators.types import cast_check, too_long


def _numeric(type_text: str) -> bool:
    return isinstance(T.DataType.fromDDL(type_text), T.NumericType)


def _identity(c: Declared) -> Generated | None:
    """Identity is for numbers; elsewhere the declaration says nothing."""
    return c.generated if c.generated and c.generated.as_identity and _numeric(c.type) else None


def _formula(c: Declared) -> tuple[str, bool, bool]:
    """(expression, also over given values, also for NULL) of a column: generated before default; '' is none."""
    g = c.generated
    if _identity(c):
        return "", False, False
    if g and g.expression.strip():
        always = g.type.upper() == "ALWAYS"
        return g.expression.strip(), always, g.on_null
    text = "" if c.default is None else str(c.default).strip()
    return text, False, c.default_on_null


def names_in(expression: str, names: Sequence[str]) -> set[str]:
    """Which of the names an expression mentions, outside of its text literals."""
    bare = re.sub(r"'(?:[^'\\]|\\.|'')*'", " ", expression)
    words = {w.lower() for w in re.findall(r"\w+", bare)}
    return {n for n in names if n.lower() in words}


def computing_order(table: Table) -> list[Declared]:
    """Columns so that each comes after those its expression needs; a circle is refused."""
    by_name = {c.name: c for c in table.columns}
    needs = {c.name: names_in(_formula(c)[0], [n for n in by_name if n != c.name or _formula(c)[1]]) for c in table.columns}
    done: list[Declared] = []
    left = dict(needs)
    while left:
        free = [n for n, need in left.items() if not need & set(left)]
        if not free:
            raise ValueError(f"columns of {table.name} need each other: {', '.join(sorted(left))}")
        for n in free:
            done.append(by_name[n])
            del left[n]
    return done


def load_table(df: DataFrame, table: Table, order: Sequence[str] = (), unique: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows of the declared table, rejected source rows with their ``reasons``).

    Every column is its given value, else its identity, generated or default
    value: ALWAYS writes over what is given, a default or BY DEFAULT fills an
    absent column, ON NULL also the NULLs. Expressions see the loaded values of
    other columns and are computed in the order in which they need each other; a
    circle raises. Given values must survive the cast to the declared type, and
    rows must keep lengths, NOT NULL, value rules and checks. Identities follow
    ``order`` and count rejected rows too; with one, the rows are ordered and
    stored once, else all is one lazy scan. Columns that are not declared stay
    in the rejects only.
    """
    columns = computing_order(table)
    clash = [c for c in df.columns if c.startswith("_s_") or c == "_given"]
    if clash:
        raise ValueError(f"reserved column names: {', '.join(clash)}")
    given = {n.lower(): n for n in df.columns}
    rows = df.withColumn("_given", F.struct(*[F.col(f"`{c}`") for c in df.columns]))
    for c in columns:
        spec = _identity(c)
        if spec:
            named = rows.withColumnRenamed(given[c.name.lower()], c.name) if c.name.lower() in given else rows
            rows = assign_identity(named, c.name, order, spec, unique)
            given[c.name.lower()] = c.name
    rows = rows.select("_given", *[F.col(f"`{n}`").alias(f"_s_{low}") for low, n in given.items() if n in rows.columns])
    reasons: list[Column] = []
    for c in columns:
        source = f"_s_{c.name.lower()}"
        expression, always, on_null = _formula(c)
        own = F.lit(None).cast(c.type)
        if source in rows.columns and not (always and expression):
            own, reason = cast_check(rows, source, c.type)
            reasons.append(F.regexp_replace(reason, "^_s_[^:]*", c.name.replace("$", r"\$")))
        if expression:
            made = F.expr(expression).cast(c.type)
            if always or source not in rows.columns:
                own = made
            elif on_null:
                own = F.when(F.col(source).isNull(), made).otherwise(own)
        rows = rows.withColumn(c.name, own)
    for c in table.columns:
        if c.length is not None:
            reasons.append(too_long(c))
    for name, _, validate, passes in _row_tests(table):
        if validate:
            reasons.append(F.when(~passes, F.lit(name)))
    judged = rows.withColumn("_why", F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>"))
    loaded = [F.col(f"`{c.name}`").alias(c.name, metadata={"comment": c.comment}) if c.comment else F.col(f"`{c.name}`") for c in table.columns]
    return judged.filter(F.size("_why") == 0).select(*loaded), judged.filter(F.size("_why") > 0).select("_given.*", F.col("_why").alias("reasons"))

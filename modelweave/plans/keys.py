"""Joins over pairs of columns, safe when both frames come from one table."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Pairs = Sequence[tuple[str, str]]


def same_keys(left: DataFrame, right: DataFrame, pairs: Pairs) -> Column:
    """Join condition over column pairs of two frames that do not stem from each other."""
    return reduce(and_, [left[f"`{a}`"] == right[f"`{b}`"] for a, b in pairs])


def by_name(pairs: Pairs, null_safe: bool = False) -> Column:
    """Join condition where no column name is on both sides."""
    cols = [(F.col(f"`{a}`"), F.col(f"`{b}`")) for a, b in pairs]
    return reduce(and_, [a.eqNullSafe(b) if null_safe else a == b for a, b in cols])


def single(count: str, value: str, name: str) -> Column:
    """``value``, or an error where a lookup key has more than one row."""
    message = F.lit(f"{name}: a lookup key comes more than once")
    return F.when(F.col(count) > 1, F.raise_error(message)).otherwise(F.col(value)).alias(name)


def tied(on: str, names: Sequence[str]) -> None:
    """Raise unless the join text ties every table to an earlier one by an equality of columns.

    Only parts that hold in every case count: those joined by AND at the top.
    """
    column = r"`?(\w+)`?\s*[.]\s*`?\w+`?"
    flat, depth, out = [], 0, []
    for c in on:
        depth += (c == "(") - (c == ")")
        out.append(c if depth == 0 else " ")
    for part in re.split(r"\band\b", "".join(out), flags=re.I):
        m = re.fullmatch(rf"\s*{column}\s*(?:=|==|<=>)\s*{column}\s*", part)
        if m:
            flat.append({m[1], m[2]})
    if re.search(r"\bor\b", "".join(out), re.I):
        flat = []
    for i, name in enumerate(names[1:], 1):
        if not any(name in pair and len(pair) == 2 and (pair - {name}) <= set(names[:i]) for pair in flat):
            raise ValueError(f"no equality of columns ties {name} to a table before it")


def lookup(
    left: DataFrame, right: DataFrame, pairs: Pairs, how: str, null_safe: bool = False, unique: bool = False
) -> DataFrame:
    """``left_semi`` or ``left_anti`` join.

    The right side shrinks to its keys, made distinct before the shuffle unless
    they are ``unique``: run time splitting of a hot key helps the left side only.
    """
    keys = right.select(*[F.col(f"`{b}`").alias(f"_k{i}") for i, (_, b) in enumerate(pairs)])
    if not unique:
        keys = keys.distinct()
    return left.join(keys, by_name([(a, f"_k{i}") for i, (a, _) in enumerate(pairs)], null_safe), how)

"""Q01..Q05: identity columns and sequences as functions of a dense position, without state."""

from __future__ import annotations

from collections.abc import Sequence as Seq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.model import Generated, Sequence
from modelweave.plans.positions import dense_index
from modelweave.plans.workspace import store

_BIGINT_MAX = (1 << 63) - 1
_BIGINT_MIN = -(1 << 63)


def bounds(spec: Sequence) -> tuple[int, int, int]:
    """(start, lowest, highest): up from 1, down from -1 when nothing else is declared."""
    if spec.increment == 0:
        raise ValueError("the increment must not be 0")
    up = spec.increment > 0
    low = spec.min_value if spec.min_value is not None else (1 if up else _BIGINT_MIN)
    high = spec.max_value if spec.max_value is not None else (_BIGINT_MAX if up else -1)
    start = spec.start if spec.start is not None else (low if up else high)
    if not low <= start <= high:
        raise ValueError(f"start {start} is outside {low}..{high}")
    return start, low, high


def value_at(position: Column, spec: Sequence) -> Column:
    """The value of a sequence at a 0-based position; past the bound an error, or the cycle."""
    start, low, high = bounds(spec)
    inc = spec.increment
    room = (high - start) // inc + 1 if inc > 0 else (start - low) // -inc + 1
    value = F.lit(start) + position * F.lit(inc)
    if room > _BIGINT_MAX:
        return value
    if not spec.cycle:
        return F.when(position < room, value).otherwise(F.raise_error(F.lit("sequence passes its bound")).cast("bigint"))
    again = (high - low) // abs(inc) + 1
    edge = low if inc > 0 else high
    later = F.lit(edge) + F.pmod(position - F.lit(room), F.lit(again)) * F.lit(inc)
    return F.when(position < room, value).otherwise(later)


def sequence_values(df: DataFrame, order: Seq[str], spec: Sequence, name: str = "id", unique: bool = False) -> DataFrame:
    """Q02, Q03: one value per row in ``order``. ``unique`` declares the order columns a key."""
    indexed = dense_index(df, order, "_idx", unique)
    return indexed.select(*[c for c in df.columns if c != name], value_at(F.col("_idx"), spec).cast("bigint").alias(name))


def assign_identity(df: DataFrame, column: str, order: Seq[str], generated: Generated, unique: bool = False) -> DataFrame:
    """Q01: ALWAYS writes every row, BY DEFAULT an absent column only, ON NULL also the NULLs."""
    spec = Sequence(generated.start, generated.increment, None if generated.start >= 1 else generated.start)
    if generated.increment < 0:
        spec = Sequence(generated.start, generated.increment, None, max(generated.start, -1))
    if generated.type == "ALWAYS" or column not in df.columns:
        return sequence_values(df, order, spec, column, unique)
    if not generated.on_null:
        return df
    empty = sequence_values(df.filter(F.col(column).isNull()), order, spec, column, unique)
    given = df.filter(F.col(column).isNotNull()).withColumn(column, F.col(column).cast("bigint"))
    return given.unionByName(empty)


def continue_sequence(
    df_new: DataFrame,
    order: Seq[str],
    stored: DataFrame,
    column: str,
    spec: Sequence,
    old_spec: Sequence | None = None,
    unique: bool = False,
) -> DataFrame:
    """Q04: ids of a further batch, after the last stored id (the largest, going down the smallest).

    Nothing stored: from the start. A MINVALUE raised since ``old_spec`` begins at the start again.
    """
    if spec.cycle:
        raise ValueError("a cycling sequence has no last stored value")
    start, low, high = bounds(spec)
    inc = spec.increment
    last = stored.agg((F.max(column) if inc > 0 else F.min(column)).cast("bigint").alias("_last"))
    first = last.select(F.coalesce(F.col("_last") + inc, F.lit(start))).scalar()
    if old_spec is not None and bounds(old_spec)[1] < low:
        first = F.lit(start)
    indexed = dense_index(df_new, order, "_idx", unique)
    value = first + F.col("_idx") * F.lit(inc)
    inside = (value >= low) & (value <= high)
    value = F.when(inside, value).otherwise(F.raise_error(F.lit("sequence passes its bound")).cast("bigint"))
    return indexed.select(*[c for c in df_new.columns if c != column], value.cast("bigint").alias(column))


def scaled_ids(df: DataFrame, digits: int, extend: bool, name: str = "id", offset_digits: int = 6) -> DataFrame:
    """Q05: unique ids without an order over the whole table: a partition offset in front of a local number.

    EXTEND: ``offset_digits`` + ``digits`` in length, else within ``digits``.
    The rows are stored with their place first, so that every run reads the same ids.
    """
    local_digits = digits if extend else digits - offset_digits
    if local_digits < 1 or offset_digits + local_digits > 18:
        raise ValueError("the length leaves no room")
    placed = store(df.withColumn("_at", F.monotonically_increasing_id()), "scaled")
    part = F.shiftrightunsigned("_at", 33)
    local = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    base = 10 ** (offset_digits - 1)
    fits = (local < 10**local_digits) & (part < 9 * base)
    value = (part + base) * F.lit(10**local_digits) + local
    value = F.when(fits, value).otherwise(F.raise_error(F.lit("scaled ids run out of digits")).cast("bigint"))
    return placed.select(*df.columns, value.alias(name))

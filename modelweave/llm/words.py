"""Column expressions shared by the native text operators."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# a word: digits, letters and everything beyond ASCII, after A-Z were lowered
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
EMPTY_SHA256 = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is.

    ``lower`` does the same on plain ASCII and is several times faster.
    """
    beyond = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.when(F.bit_length(text) == 8 * F.char_length(text), F.lower(text)).otherwise(beyond)


def words_of(text: Column) -> Column:
    """The words of a text in order; no words for null."""
    return F.regexp_extract_all(lower_ascii(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Null-safe equality of columns that both frames name alike (the right one as ``_r_<name>``)."""
    out = F.lit(True)
    for n in names:
        out = out & left[f"`{n}`"].eqNullSafe(right[f"`_r_{n}`"])
    return out


def right_keys(names: list[str]) -> list[Column]:
    return [F.col(f"`{n}`").alias(f"_r_{n}") for n in names]

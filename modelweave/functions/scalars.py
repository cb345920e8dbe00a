"""F01..F20: column functions; all run inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_all(c: Column | str) -> Column:
    """Without white space at both ends, line ends included."""
    return F.btrim(_c(c), F.lit(" \t\n\r\f\v"))


def quote_name(c: Column | str, mode: str = "auto") -> Column:
    """``always``, ``never``, or ``auto``: only with a blank, digit or lower-case letter."""
    c = _c(c)
    quoted = F.concat(F.lit('"'), c, F.lit('"'))
    if mode == "always":
        return quoted
    return c if mode == "never" else F.when(c.rlike(r"[\s0-9a-z]"), quoted).otherwise(c)


def escape_quotes(c: Column | str, wrap: bool = False) -> Column:
    """' becomes ''; ``wrap`` puts single quotes around."""
    doubled = F.replace(_c(c), F.lit("'"), F.lit("''"))
    return F.concat(F.lit("'"), doubled, F.lit("'")) if wrap else doubled


def wrap_once(c: Column | str, start: str = "'", end: str = "'") -> Column:
    """``start`` and ``end`` around the text, unless they are there."""
    c = _c(c)
    there = F.startswith(c, F.lit(start)) & F.endswith(c, F.lit(end)) & (F.length(c) >= len(start))
    return F.when(there, c).otherwise(F.concat(F.lit(start), c, F.lit(end)))


def qualified_name(schema: Column | str, name: Column | str) -> Column:
    """schema.name, or the name alone when the schema is empty."""
    return F.concat_ws(".", F.nullif(_c(schema), F.lit("")), _c(name))


def indent(c: Column | str, prefix: str = "\t") -> Column:
    """``prefix`` before every line."""
    return F.concat(F.lit(prefix), F.replace(_c(c), F.lit("\n"), F.lit("\n" + prefix)))


def comment_out(c: Column | str, active: Column, inline: bool = False, mark: str = "--") -> Column:
    """an inactive text becomes a comment, a block when it has several lines. A missing flag is active."""
    c = _c(c)
    if inline:
        dead = F.concat(F.lit("/* "), c, F.lit(" */"))
    else:
        dead = F.when(F.contains(c, F.lit("\n")), F.concat(F.lit("/*\n"), c, F.lit(" */\n"))).otherwise(
            F.concat(F.lit(mark + " "), c)
        )
    return F.when(F.coalesce(active, F.lit(True)), c).otherwise(dead)


def render_template(template: str, columns: dict[str, Column | str]) -> Column:
    """``${name}`` replaced by the column of that name; missing or NULL gives an empty text."""
    parts = re.split(r"\$\{(.*?)\}", template)
    pieces = []
    for i, part in enumerate(parts):
        if i % 2 == 0:
            pieces.append(F.lit(part))
        elif part in columns:
            pieces.append(F.coalesce(_c(columns[part]).cast("string"), F.lit("")))
    return F.concat(*pieces)


def extract_after(c: Column | str, marker: str, smaller_of: tuple[Column, Column]) -> Column:
    """the word after a marker as a number; without the marker the smaller of two columns."""
    c = _c(c)
    word = F.regexp_extract(c, re.escape(marker) + r"\s+(\w+)", 1)
    return F.when(F.contains(c, F.lit(marker)), word.try_cast("bigint")).otherwise(F.least(*smaller_of))


def strip_suffix_lower(c: Column | str, suffix: str) -> Column:
    """remove a suffix (a regular expression), lower-case the rest."""
    return F.lower(F.regexp_replace(_c(c), suffix + "$", ""))


def decode_flags(c: Column | str, words: dict[str, str], only_if: Column | None = None) -> Column:
    """a flag to its word; blank when the option it depends on is off, NULL for an unknown flag."""
    c = _c(c)
    word = F.lit(None).cast("string")
    for flag, text in words.items():
        word = F.when(c == flag, F.lit(text)).otherwise(word)
    return word if only_if is None else F.when(only_if, word).otherwise(F.lit(""))


def major_version(c: Column | str, known: Sequence[str], default: str) -> Column:
    """the first known version that begins with the first part of a dotted version, else the default."""
    major = F.split(_c(c), "[.]")[0]
    found = F.lit(None).cast("string")
    for version in reversed(known):
        found = F.when(F.startswith(F.lit(version), major), F.lit(version)).otherwise(found)
    return F.coalesce(F.when(major != "", found), F.lit(default))


def bytes_to_text(c: Column | str) -> Column:
    """a byte buffer as UTF-8 text; bad bytes become U+FFFD."""
    return F.make_valid_utf8(_c(c).cast("string"))


def drop_nulls(m: Column | str) -> Column:
    """a map without its NULL entries."""
    return F.map_filter(_c(m), lambda _, v: v.isNotNull())


def variant_kind(v: Column) -> Column:
    """Kind of a VARIANT value: object, array, string, number, boolean or null."""
    schema = F.schema_of_variant(v)
    return (
        F.when(F.startswith(schema, F.lit("OBJECT")), "object")
        .when(F.startswith(schema, F.lit("ARRAY")), "array")
        .when(schema == "STRING", "string")
        .when(schema == "BOOLEAN", "boolean")
        .when(schema == "VOID", "null")
        .when(schema.isNotNull(), "number")
    )


def json_kind(c: Column | str) -> Column:
    """kind of a JSON text; NULL for bad JSON."""
    return variant_kind(F.try_parse_json(_c(c)))


def number_or_null(c: Column | str) -> Column:
    """a number when the text is one, else NULL (also for an empty text)."""
    return trim_all(_c(c).cast("string")).try_cast("double")


def strip_outer_parens(c: Column | str) -> Column:
    """F16: trim and drop one outer pair, only when the first parenthesis closes at the very end."""
    t = trim_all(c)
    # depth after each character; the opening one is closed at the end only if no earlier depth is 0
    chars = F.filter(F.split(F.regexp_replace(t, "[^()]", ""), ""), lambda x: x != "")
    depths = F.aggregate(
        chars,
        F.struct(F.lit(0).alias("d"), F.lit(0).alias("zeros")),
        lambda a, x: F.struct(
            (a["d"] + F.when(x == "(", 1).when(x == ")", -1).otherwise(0)).alias("d"),
            (
                a["zeros"]
                + F.when(a["d"] + F.when(x == "(", 1).when(x == ")", -1).otherwise(0) <= 0, 1).otherwise(0)
            ).alias("zeros"),
        ),
    )
    outer = F.startswith(t, F.lit("(")) & F.endswith(t, F.lit(")")) & (depths["zeros"] == 1) & (depths["d"] == 0)
    return F.when(outer, trim_all(F.substring(t, F.lit(2), F.length(t) - 2))).otherwise(t)


def split_statements(c: Column | str) -> Column:
    """parts between blank lines, without the empty ones, ``/`` and ``;`` trimmed, in order.

    An array of (pos, statement); ``pos`` counts the parts kept.
    """
    parts = F.filter(F.split(_c(c), "\n\n"), lambda p: trim_all(p) != "")
    return F.transform(
        parts,
        lambda p, i: F.struct(
            i.alias("pos"), F.regexp_replace(p, r"^[\s/;]+|[\s/;]+$", "").alias("statement")
        ),
    )


def headline(c: Column | str, n: int = 150) -> Column:
    """the first line, at most ``n`` characters."""
    return F.substring(F.substring_index(_c(c), "\n", 1), 1, n)


# The text formats of a date or timestamp by fraction digits.
TIME_FORMATS = {
    ("date", 0): "yyyy-MM-dd",
    ("timestamp", 0): "yyyy-MM-dd HH:mm:ss",
    ("timestamp", 3): "yyyy-MM-dd HH:mm:ss.SSS",
    ("timestamp", 6): "yyyy-MM-dd HH:mm:ss.SSSSSS",
    ("timestamp", 9): "yyyy-MM-dd HH:mm:ss.SSSSSSSSS",
}


def parse_time(c: Column | str, mode: str = "timestamp", frac: int = 0, tz: bool = False) -> Column:
    """text to date or timestamp; NULL when it does not fit. Nine digits are cut to six."""
    c = _c(c)
    pattern = TIME_FORMATS[(mode, frac if mode == "timestamp" else 0)]
    if mode == "date":
        return F.try_to_timestamp(c, F.lit(pattern)).cast("date")
    if tz:
        return F.try_to_timestamp(c, F.lit(pattern + "XX"))
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def rename_keys(code: Column | str, name: Column | str, ref: Column | str) -> Column:
    """explicit code, else property name, else column name."""
    return F.coalesce(F.nullif(_c(code), F.lit("")), F.nullif(_c(name), F.lit("")), _c(ref))

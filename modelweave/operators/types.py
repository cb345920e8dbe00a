"""T01..T11: declared types on data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.functions.scalars import json_kind
from modelweave.model import Table
from modelweave.plans.keys import single


def _plain_number(text: Column) -> Column:
    """A number written without exponent, in one form: no sign of plus, no zeros that say nothing."""
    cut = F.regexp_replace(F.trim(text), "^[+]", "")
    cut = F.regexp_replace(cut, "^(-?)0+(?=[0-9])", "$1")
    cut = F.when(F.contains(cut, F.lit(".")), F.regexp_replace(cut, "[.]?0+$", "")).otherwise(cut)
    cut = F.regexp_replace(F.regexp_replace(cut, "^(-?)[.]", "$10."), "[.]$", "")
    return F.when(cut.isin("-0", "", "-"), F.lit("0")).otherwise(cut)


def _shortest(result: Column) -> Column:
    """The number that a float is written as: 0.1 for the float nearest to 0.1."""
    return result.cast("string").try_cast("double")


def lossy(source: Column, source_type: T.DataType, result: Column, target: str) -> Column:
    """True when the value came through the cast changed: it differs when cast back."""
    kind = T.DataType.fromDDL(target)
    if isinstance(source_type, T.StringType):
        if isinstance(kind, T.DateType):
            # a time of day would be lost
            return source.try_cast("timestamp_ntz") != result.cast("timestamp_ntz")
        if not isinstance(kind, T.NumericType):
            return F.lit(False)
        if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
            return source.try_cast("double") != _shortest(result)
        rough = source.try_cast("double") != result.cast("double")
        plain = source.rlike(r"^\s*[+-]?[0-9]*[.]?[0-9]*\s*$")
        written = F.when(plain, _plain_number(source) != _plain_number(result.cast("string"))).otherwise(
            F.coalesce(source.try_cast("decimal(38,18)") != result.try_cast("decimal(38,18)"), rough)
        )
        # the patterns are for the few texts that do not come back as they were
        return F.when(result.cast("string") == source, F.lit(False)).otherwise(written)
    if isinstance(kind, T.FloatType) and isinstance(source_type, (T.DoubleType, T.DecimalType)):
        return _shortest(result) != source.cast("double")
    if isinstance(source_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)) and target != "string":
        return result.try_cast(source_type.simpleString()) != source
    return F.lit(False)


def cast_check(df: DataFrame, column: str, target: str) -> tuple[Column, Column]:
    """(value in the target type, reason it is refused or NULL) of one column."""
    source = F.col(column)
    result = source.try_cast(target)
    changed = F.coalesce(lossy(source, df.schema[column].dataType, result, target), F.lit(False))
    reason = F.when(source.isNotNull() & result.isNull(), F.lit(f"{column}: no {target}")).when(
        changed, F.lit(f"{column}: changed by {target}")
    )
    return result, reason


def too_long(c) -> Column:
    """Reason, or NULL, of a text above the declared length of its column."""
    size = F.octet_length(c.name) if c.length_semantics == "BYTE" else F.char_length(c.name)
    return F.when(size > c.length, F.lit(f"{c.name}: longer than {c.length}"))


def conform(df: DataFrame, table: Table, keep_lossy: bool = False) -> tuple[DataFrame, DataFrame]:
    """(rows in the declared types, rejected source rows with their ``reasons``).

    A row is rejected when a value has no counterpart in the declared type, when
    the cast changes it (unless ``keep_lossy``), or when it is too long. A
    declared column that the rows do not have is NULL. Comments go along as
    column metadata.
    """
    absent = {c.name: F.lit(None).cast(c.type) for c in table.columns if c.name not in df.columns}
    df = df.withColumns(absent) if absent else df
    values, reasons = [], []
    for c in table.columns:
        value, reason = cast_check(df, c.name, c.type)
        values.append(value.alias(c.name, metadata={"comment": c.comment}) if c.comment else value.alias(c.name))
        if keep_lossy:
            reason = F.when(F.col(c.name).isNotNull() & value.isNull(), F.lit(f"{c.name}: no {c.type}"))
        reasons.append(reason)
        if c.length is not None:
            reasons.append(too_long(c))
    why = F.array_compact(F.array(*reasons))
    return df.filter(F.size(why) == 0).select(*values), df.filter(F.size(why) > 0).withColumn("reasons", why)


def length_violations(df: DataFrame, column: str, n: int, semantics: str = "BYTE") -> DataFrame:
    """Rows whose text or bytes are longer than ``n``."""
    size = F.octet_length(column) if semantics == "BYTE" else F.char_length(column)
    return df.filter(size > n)


def to_number(c: Column | str, precision: int | str | None = None, scale: int = 0) -> Column:
    """NUMBER(p,s); ``*`` is 38 digits; no precision is decimal(38,10), our choice.

    A negative scale rounds before the point: NUMBER(5,-2) holds up to 9,999,900.
    """
    c = F.col(c) if isinstance(c, str) else c
    if precision is None:
        return c.try_cast("decimal(38,10)")
    p = 38 if precision == "*" else int(precision)
    if p > 38:
        raise ValueError("at most 38 digits")
    if scale < 0:
        return F.round(c.try_cast("decimal(38,10)"), scale).try_cast(f"decimal({min(38, p - scale)},0)")
    return c.try_cast(f"decimal({p},{scale})")


def to_float(c: Column | str, binary_digits: int = 126) -> Column:
    """FLOAT(p): single precision up to 24 binary digits, else double."""
    c = F.col(c) if isinstance(c, str) else c
    return c.try_cast("float" if binary_digits <= 24 else "double")


def to_timestamp_precision(c: Column | str, frac: int = 6, tz: str = "") -> Column:
    """Cut to ``frac`` fraction digits (more than 6 do not exist in Spark); DATE is ``frac`` 0.

    ``tz`` "with" or "local" gives an instant shown in the session zone; the
    offset as written is not kept.
    """
    c = F.col(c) if isinstance(c, str) else c
    c = c.try_cast("timestamp" if tz else "timestamp_ntz")
    if frac >= 6:
        return c
    seconds = F.extract(F.lit("SECOND"), c)
    kept = F.floor(seconds * 10**frac) / F.lit(10**frac)
    zero = F.lit(0)
    return c - F.make_dt_interval(zero, zero, zero, (seconds - kept).cast("decimal(18,6)"))


def to_interval(c: Column | str, kind: str) -> Column:
    """A number of months (``year``) or seconds (``day``) as an interval."""
    c = F.col(c) if isinstance(c, str) else c
    zero = F.lit(0)
    if kind == "year":
        return F.make_ym_interval(zero, c.cast("int"))
    return F.make_dt_interval(zero, zero, zero, c.cast("decimal(18,6)"))


def interval_number(c: Column, kind: str) -> Column:
    """An interval back as months or seconds, for output."""
    if kind == "year":
        months = F.extract(F.lit("YEAR"), c) * 12 + F.extract(F.lit("MONTH"), c)
        return months.cast("int")
    parts = [("DAY", 86400), ("HOUR", 3600), ("MINUTE", 60), ("SECOND", 1)]
    total = F.lit(0).cast("decimal(24,6)")
    for unit, factor in parts:
        total = total + F.extract(F.lit(unit), c) * factor
    return total.cast("decimal(24,6)")


_ELEMENT = {"INT8": "tinyint", "FLOAT32": "float", "FLOAT64": "double"}


def vector_violations(df: DataFrame, column: str, dim: int | str = "*", fmt: str = "*") -> DataFrame:
    """Rows whose vector has another length, a NULL entry, or an entry outside the format."""
    bad = F.exists(column, lambda x: x.isNull())
    if dim != "*":
        bad = bad | (F.size(column) != int(dim))
    if fmt != "*":
        element = _ELEMENT[fmt.upper()]
        whole = fmt.upper() == "INT8"
        bad = bad | F.exists(
            column,
            lambda x: x.try_cast(element).isNull() | ((x.try_cast(element) != x) if whole else F.lit(False)),
        )
    return df.filter(F.col(column).isNotNull() & bad)


def json_kind_violations(df: DataFrame, column: str, kind: str) -> DataFrame:
    """Rows whose JSON is of another kind, or is none."""
    return df.filter(F.col(column).isNotNull() & ~json_kind(column).eqNullSafe(F.lit(kind.lower())))


def json_storage(df: DataFrame, column: str, native: bool) -> DataFrame:
    """JSON text to VARIANT (``native``) or back to text."""
    stored = F.parse_json(column) if native else F.to_json(column)
    return df.withColumn(column, stored)


def encrypt_columns(df: DataFrame, columns: Sequence[str], key: Column, salted: bool = True) -> DataFrame:
    """Salted: a new vector per value and an integrity tag; not salted: equal values stay equal, joinable."""
    mode = "GCM" if salted else "ECB"
    return df.withColumns({c: F.aes_encrypt(F.col(c).cast("string"), key, F.lit(mode)) for c in columns})


def decrypt_columns(df: DataFrame, columns: Sequence[str], key: Column, salted: bool = True) -> DataFrame:
    """Text again; NULL when the key is wrong or the value was changed."""
    mode = "GCM" if salted else "ECB"
    return df.withColumns({c: F.try_aes_decrypt(F.col(c), key, F.lit(mode)).cast("string") for c in columns})


def to_udt(attributes: dict[str, tuple[Column | str, str]]) -> Column:
    """An object type as a struct of named, typed attributes."""
    return F.struct(
        *[(F.col(c) if isinstance(c, str) else c).try_cast(t).alias(name) for name, (c, t) in attributes.items()]
    )


def collection_violations(df: DataFrame, column: str, n: int | None = 64, not_null: bool = False) -> DataFrame:
    """VARRAY(n) above its size (``n`` None: a nested table), or a NULL element where none may be."""
    bad = F.lit(False) if n is None else F.size(column) > n
    if not_null:
        bad = bad | F.exists(column, lambda x: x.isNull())
    return df.filter(F.col(column).isNotNull() & bad)


# Foreign type names and their canonical type (type, precision, scale, length).
CANONICAL_TYPES: dict[str, tuple[str, int | None, int | None, int | None]] = {
    "character": ("char", None, None, None),
    "character varying": ("varchar", None, None, None),
    "char varying": ("varchar", None, None, None),
    "national char": ("nchar", None, None, None),
    "national character": ("nchar", None, None, None),
    "national char varying": ("nvarchar2", None, None, None),
    "national character varying": ("nvarchar2", None, None, None),
    "nchar varying": ("nvarchar2", None, None, None),
    "tinyint": ("number", 5, None, None),
    "small int": ("number", 5, None, None),
    "shortinteger": ("number", 5, None, None),
    "shortint": ("number", 5, None, None),
    "smallint": ("number", 5, None, None),
    "int": ("number", 10, None, None),
    "integer": ("number", 10, None, None),
    "shortdecimal": ("number", 5, 0, None),
    "decimal": ("number", 5, 0, None),
    "longinteger": ("number", 20, None, None),
    "bigint": ("number", 20, None, None),
    "int8": ("number", 20, None, None),
    "bit": ("number", 1, None, None),
    "real": ("float", None, None, 23),
    "double precision": ("number", None, None, None),
    "small money": ("float", 16, 2, None),
    "money": ("float", 16, 2, None),
    "long varchar": ("long", None, None, None),
    "text": ("long", None, None, None),
    "ntext": ("long", None, None, None),
    "uniqueidentifier": ("char", None, None, 36),
    "uuid": ("char", None, None, 36),
    "datetime": ("date", None, None, None),
    "small datetime": ("date", None, None, None),
    "image": ("long raw", None, None, None),
    "binary": ("raw", None, None, None),
    "varbinary": ("raw", None, None, None),
    "string": ("nvarchar2", None, None, None),
}

# Canonical type of a kind that has no name above.
DEFAULT_TYPES: dict[str, str] = {
    "number": "numeric",
    "string": "nvarchar2",
    "date": "date",
    "timestamp": "timestamp",
    "binary": "raw",
    "boolean": "numeric",
    "document": "bfile",
    "array": "json",
    "objectId": "char",
    "default": "nvarchar2",
}


def map_codes(df: DataFrame, column: str, mapping: dict[str, str] | DataFrame, default: Column | str, name: str) -> DataFrame:
    """The code of a text, found without regard to case and outer blanks, else ``default``.

    A dict is a literal in the expression; a frame (code, value) is joined.
    """
    text = F.lower(F.trim(F.col(column)))
    fallback = F.lit(default) if isinstance(default, str) else default
    if isinstance(mapping, dict):
        table = F.create_map(*[F.lit(x) for pair in mapping.items() for x in (pair[0].lower(), pair[1])])
        return df.withColumn(name, F.coalesce(F.try_element_at(table, text), fallback))
    codes = mapping.toDF("_code", "_value").groupBy(F.lower(F.trim("_code")).alias("_code")).agg(F.count("*").alias("_n"), F.any_value("_value").alias("_v"))
    joined = df.join(codes.select("_code", single("_n", "_v", "_value")), text == F.col("_code"), "left")
    return joined.select(*df.columns, F.coalesce("_value", fallback).alias(name))

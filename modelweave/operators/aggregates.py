"""A01..A17: counts, JSON aggregation, profiles and constraint checks.

Every grouped result is a partial aggregate first, so a hot key costs one row
per task; lists per key are paged (``modelweave.plans.pages``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.functions.scalars import json_kind, trim_all
from modelweave.model import Model, Table
from modelweave.plans.keys import by_name, lookup
from modelweave.plans.pages import PAGE_ROWS, collect_groups
from modelweave.plans.paths import path_kinds
from modelweave.plans.workspace import store


def count_by(a: DataFrame, b: DataFrame, on: Sequence[tuple[str, str]], name: str = "n") -> DataFrame:
    """Number of rows of ``b`` for each row of ``a``, 0 when there are none."""
    counts = b.groupBy(*[F.col(k).alias(f"_k{i}") for i, (_, k) in enumerate(on)]).agg(F.count("*").alias("_n"))
    pairs = [(k, f"_k{i}") for i, (k, _) in enumerate(on)]
    joined = a.join(counts, by_name(pairs), "left")
    return joined.select(*a.columns, F.coalesce("_n", F.lit(0)).alias(name))


def json_object(mapping: dict[str, Column | str]) -> Column:
    """Text of a JSON object with NULL values kept."""
    fields = [(F.col(c) if isinstance(c, str) else c).alias(k) for k, c in mapping.items()]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def to_json_object(df: DataFrame, mapping: dict[str, Column | str], name: str = "json") -> DataFrame:
    """One JSON object per row."""
    return df.withColumn(name, json_object(mapping))


def to_json_array(
    df: DataFrame, key: Sequence[str], columns: Sequence[str], name: str = "json", page_rows: int = PAGE_ROWS
) -> DataFrame:
    """One JSON array of objects per key, sorted by the columns; long ones go on in further pages."""
    grouped, _ = collect_groups(df, key, F.struct(*columns), (), "_items", page_rows=page_rows)
    return grouped.select(*key, F.to_json("_items", {"ignoreNullFields": "false"}).alias(name), F.col("_page").alias("page"))


def collect_by_key(df: DataFrame, key: Sequence[str], value: str, name: str = "items", page_rows: int = PAGE_ROWS) -> DataFrame:
    """Key to its list of values (NULL left out), with ``is_empty`` and the page of a long list."""
    keys = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(key)]).distinct()
    grouped, _ = collect_groups(df.filter(F.col(value).isNotNull()), key, F.col(value), (), "_items", page_rows=page_rows)
    met = keys.join(grouped, by_name([(f"_k{i}", k) for i, k in enumerate(key)], null_safe=True), "left")
    none = F.array().cast(grouped.schema["_items"].dataType)
    return met.select(
        *[F.col(f"_k{i}").alias(k) for i, k in enumerate(key)],
        F.coalesce("_items", none).alias(name),
        F.col("_items").isNull().alias("is_empty"),
        F.coalesce("_page", F.lit(0)).cast("long").alias("page"),
    )


def _full(column: str) -> Column:
    return F.col(column).isNotNull() & (trim_all(F.col(column).cast("string")) != "")


def first_non_empty(df: DataFrame, key: Sequence[str], column: str, order: Sequence[str]) -> DataFrame:
    """Value of the first record of a key that has one."""
    return df.filter(_full(column)).groupBy(*key).agg(F.min_by(column, F.struct(*order)).alias(column))


def json_column_profile(df: DataFrame, columns: Sequence[str], order: Sequence[str] = (), mode: str = "first") -> DataFrame:
    """(column, kind) of the first value that is not NULL and parses; columns without one are left out.

    ``mode="all"`` gives (column, path, kind, n) over all values instead, at
    every path through objects and lists; the value itself has the path ''.
    """
    texts = [c for c in columns if df.schema[c].dataType.simpleString() == "string"]
    if mode == "all":
        return path_kinds(df, texts).withColumn("kind", F.concat(F.lit("json"), F.initcap("kind")))
    if mode != "first" or not order:
        raise ValueError("mode is 'first', with an order, or 'all'")
    position = F.struct(*order)
    first = [F.min_by(json_kind(c), F.when(json_kind(c).isNotNull(), position)).alias(c) for c in texts]
    row = df.agg(*first)
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("_k")) for c in texts])
    return (
        row.select(F.explode(pairs).alias("p"))
        .filter("p._k IS NOT NULL")
        .select("p.column_name", F.concat(F.lit("json"), F.initcap("p._k")).alias("kind"))
    )


def json_schema(df: DataFrame, column: str) -> DataFrame:
    """Merged nested schema of a JSON column, with the numbers of good and bad documents."""
    parsed = F.try_parse_json(column)
    return df.agg(
        F.schema_of_variant_agg(parsed).alias("json_schema"),
        F.count(parsed).alias("documents"),
        F.count(F.when(F.col(column).isNotNull() & parsed.isNull(), 1)).alias("bad_documents"),
    )


def key_violations(df: DataFrame, columns: Sequence[str], primary: bool = False) -> DataFrame:
    """(key columns, n) of keys with several rows; a primary key also rejects NULL parts, UNIQUE skips them."""
    empty = reduce(or_, [F.col(c).isNull() for c in columns])
    if primary:
        counts = df.groupBy(*columns).agg(F.count("*").alias("n"))
        return counts.filter((F.col("n") > 1) | empty)
    return df.filter(~empty).groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def expression_key_violations(df: DataFrame, expression: str, name: str = "key_value") -> DataFrame:
    """Values of a unique expression index that come more than once."""
    keyed = df.select(F.expr(expression).alias(name)).filter(F.col(name).isNotNull())
    return keyed.groupBy(name).agg(F.count("*").alias("n")).filter("n > 1")


def null_violations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, n) of NULLs per NOT NULL column, in one pass."""
    row = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n")) for c in columns])
    return row.select(F.explode(pairs).alias("p")).select("p.*")


def domain_rule(column: str, rule: str, value: Any) -> Column:
    """Condition for one value rule; NULL values pass."""
    c = F.col(column)
    if rule == "minimum":
        ok = c >= value
    elif rule == "exclusive_minimum":
        ok = c > value
    elif rule == "maximum":
        ok = c <= value
    elif rule == "exclusive_maximum":
        ok = c < value
    elif rule == "multiple_of":
        # in decimals, from the text of both: 0.3 is a multiple of 0.1
        exact = c.cast("string").try_cast("decimal(38,18)") % F.lit(str(value)).cast("decimal(38,18)")
        ok = F.coalesce(exact == 0, c % F.lit(value) == 0)
    elif rule == "enum":
        ok = c.isin(*value)
    elif rule == "min_length":
        ok = F.char_length(c) >= value
    elif rule == "max_length":
        ok = F.char_length(c) <= value
    elif rule == "pattern":
        ok = c.rlike(value)
    elif rule == "min_properties":
        ok = F.size(F.json_object_keys(c)) >= value
    elif rule == "max_properties":
        ok = F.size(F.json_object_keys(c)) <= value
    elif rule == "properties":
        ok = F.size(F.array_except(F.json_object_keys(c), F.array(*[F.lit(v) for v in value]))) == 0
    else:
        raise ValueError(f"unknown rule {rule}")
    return F.coalesce(ok, F.lit(True))


def _domain_rules(rules: dict[str, dict[str, Any]]) -> list[tuple[str, str, Column]]:
    return [(c, r, domain_rule(c, r, v)) for c, group in rules.items() for r, v in group.items()]


def domain_violations(df: DataFrame, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """(column, rule, n) over all value rules, in one pass."""
    tests = _domain_rules(rules)
    row = df.agg(*[F.count(F.when(~ok, 1)).alias(f"_{i}") for i, (_, _, ok) in enumerate(tests)])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"_{i}").alias("n"))
        for i, (c, r, _) in enumerate(tests)
    ]
    return row.select(F.explode(F.array(*entries)).alias("p")).select("p.*")


def domain_failures(df: DataFrame, rules: dict[str, dict[str, Any]]) -> DataFrame:
    """The failing rows themselves."""
    return df.filter(~reduce(and_, [ok for _, _, ok in _domain_rules(rules)]))


def any_flag(df: DataFrame, predicate: str, active: str | None = None, name: str = "flag") -> DataFrame:
    """One row, true when any active row meets the predicate."""
    test = F.expr(predicate)
    if active is not None:
        test = test & F.coalesce(F.expr(active), F.lit(True))
    return df.agg(F.coalesce(F.bool_or(test), F.lit(False)).alias(name))


def table_stats(df: DataFrame, value: Column | None = None) -> DataFrame:
    """Number of documents and their average size in bytes."""
    text = F.to_json(F.struct("*")) if value is None else value
    return df.agg(F.count("*").alias("documents"), F.avg(F.octet_length(text)).alias("avg_bytes"))


def inverted_index(
    df: DataFrame, id_col: str, members: Column, unique: bool = False, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """(value, ids, page): rows that hold a member; common members fill several pages.

    ``unique`` declares the id a key: members are then made distinct inside a row only.
    """
    pairs = df.select(F.col(id_col), F.explode(F.array_distinct(members)).alias("value"))
    if not unique:
        pairs = pairs.distinct()
    # read twice, to count and to collect: the members are taken out of the rows once
    pairs = store(pairs, "members")
    grouped, _ = collect_groups(pairs, ["value"], F.col(id_col), (), "ids", page_rows=page_rows)
    return grouped.select("value", "ids", F.col("_page").alias("page"))


def posting_blocks(df: DataFrame, id_col: str, members: Column, span: int = 1 << 16) -> DataFrame:
    """A13 as blocks: (value, block, first, last, n, offsets), one row per member and range of ``span`` ids.

    ``id_col`` is a whole number and a key of ``df``. A block holds its ids as
    offsets from the first one, ``span`` at most, so a member that is in a third
    of all rows fills many blocks, in many tasks; nothing is counted or stored
    before. Written in order of (value, first), a lookup reads few of them.
    """
    pairs = df.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("_id"), F.explode(F.array_distinct(members)).alias("value"))
    block = F.floor(F.col("_id") / span)
    wide = pairs.select("value", block.alias("block"), (F.col("_id") - block * span).cast("int").alias("_o"))
    lists = wide.groupBy("value", "block").agg(F.sort_array(F.collect_list("_o")).alias("_l"))
    least = F.get("_l", F.lit(0))
    return lists.select(
        "value",
        "block",
        (F.col("block") * span + least).alias("first"),
        (F.col("block") * span + F.element_at("_l", -1)).alias("last"),
        F.size("_l").alias("n"),
        F.transform("_l", lambda o: o - least).alias("offsets"),
    )


def lookup_postings(blocks: DataFrame, values: DataFrame | Sequence[str], low: int | None = None, high: int | None = None) -> DataFrame:
    """(value, id) of some members within low..high; only blocks whose range meets it are opened.

    A list of values and the range are filters on the files; a frame of values
    (one column) is joined.
    """
    kept = blocks
    if low is not None:
        kept = kept.filter(F.col("last") >= low)
    if high is not None:
        kept = kept.filter(F.col("first") <= high)
    if isinstance(values, DataFrame):
        kept = lookup(kept, values, [("value", values.columns[0])], "left_semi")
    else:
        kept = kept.filter(F.col("value").isin(list(values)))
    ids = kept.select("value", F.explode(F.transform("offsets", lambda o: F.col("first") + o)).alias("id"))
    inside = F.lit(True)
    if low is not None:
        inside = inside & (F.col("id") >= low)
    if high is not None:
        inside = inside & (F.col("id") <= high)
    return ids.filter(inside)


def cardinality_violations(
    parent: DataFrame, child: DataFrame, on: Sequence[tuple[str, str]], low: int, high: int | None = None
) -> DataFrame:
    """Parents with fewer than ``low`` or more than ``high`` children."""
    counted = count_by(parent, child, on)
    wrong = F.col("n") < low
    return counted.filter(wrong if high is None else wrong | (F.col("n") > high))


def _row_tests(table: Table) -> list[tuple[str, str, bool, Column]]:
    """(constraint, kind, validate, passes) of the rules that look at one row."""
    tests = [
        (f"{table.name}.{c.name}.not_null", "NOT NULL", True, F.col(c.name).isNotNull())
        for c in table.columns
        if not c.nullable
    ]
    for c in table.columns:
        for rule, value in c.rules.items():
            tests.append((f"{table.name}.{c.name}.{rule}", "DOMAIN", True, domain_rule(c.name, rule, value)))
    for check in table.checks:
        passes = F.coalesce(F.expr(check.expression), F.lit(True))
        tests.append((f"{table.name}.{check.name}", "CHECK", check.validate, passes))
    return tests


@dataclass(frozen=True)
class _Rule:
    """A constraint as an entry of the ledger: the values ``ref`` stands for, and what is said of them in ``slot``."""

    name: str
    kind: str
    state: str
    ref: int
    slot: int


# slots of a reference that are not foreign keys: its own rows, checked as PRIMARY KEY or as UNIQUE
_PRIMARY, _UNIQUE = -1, -2


class _Ledger:
    """All constraints of a model over one stream of (ref, k0, k1, rest, slot) entries.

    A ref is a list of columns of a table that is a key or is referred to; each
    row enters its own key values there, and each row of a child the values it
    refers to. What fails a rule on single rows is an entry of a ref of its own.
    One aggregate over ref and value then sees duplicates and orphans of all tables.
    The first two whole numbers of a value are ``k0`` and ``k1``, all else is text
    in ``rest``: a few bytes per entry, also in a join.
    """

    def __init__(self, frames: dict[str, DataFrame], model: Model) -> None:
        self.frames = frames
        self.rules: list[_Rule] = []
        self.idle: list[tuple[str, str, str]] = []
        self.refs: dict[tuple[str, tuple[str, ...]], int] = {}
        self.entries: dict[str, list[tuple[int, Column]]] = {}  # of a table: refs that its rows enter, and how
        self.tests: dict[str, list[Column]] = {}  # of a table: names of the rules that a row fails by itself
        self.slots = 1
        tables = [t for t in model.tables if t.name in frames]
        edges = [fk for fk in model.foreign_keys if fk.child in frames and fk.parent in frames]
        live = [fk for fk in edges if fk.validate and fk.active]
        primary: set[int] = set()
        for table in tables:
            for n, kind, validate, ok in _row_tests(table):
                if not validate:
                    self.idle.append((n, kind, "NOVALIDATE"))
                    continue
                ref = -1 - len(self.rules)
                self.rules.append(_Rule(n, kind, "VALIDATE", ref, 0))
                self._add(table.name, ref, F.when(~ok, _entry(ref, [], 0)))
                self.tests.setdefault(table.name, []).append(F.when(~ok, F.lit(n)))
            for key in table.keys:
                kind = "PRIMARY KEY" if key.primary else "UNIQUE"
                state = " ".join(["VALIDATE" if key.validate else "NOVALIDATE", *(["RELY"] if key.rely else []), *(["DEFERRABLE"] if key.deferrable else [])])
                if not key.validate:
                    self.idle.append((f"{table.name}.{key.name}", kind, state))
                    continue
                ref = self._ref(table.name, key.columns)
                primary |= {ref} if key.primary else set()
                self.rules.append(_Rule(f"{table.name}.{key.name}", kind, state, ref, _PRIMARY if key.primary else _UNIQUE))
        taken: dict[int, int] = {}
        for fk in edges:
            name = f"{fk.child}.{fk.name}"
            if fk not in live:
                self.idle.append((name, "FOREIGN KEY", "NOVALIDATE"))
                continue
            ref = self._ref(fk.parent, fk.parent_columns)
            slot = taken[ref] = taken.get(ref, -1) + 1
            self.slots = max(self.slots, slot + 1)
            self.rules.append(_Rule(name, "FOREIGN KEY", "VALIDATE", ref, slot))
            types = [frames[fk.parent].schema[c].dataType for c in fk.parent_columns]
            value = [(F.col(f"`{c}`").cast(t), t) for c, t in zip(fk.columns, types)]
            refers = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in fk.columns])
            self._add(fk.child, ref, F.when(refers, _entry(ref, value, slot)))
        for (table, columns), ref in self.refs.items():
            value = [(F.col(f"`{c}`"), frames[table].schema[c].dataType) for c in columns]
            whole = reduce(and_, [F.col(f"`{c}`").isNotNull() for c in columns])
            entry = _entry(ref, value, _PRIMARY)
            # only a primary key has something to say of a NULL part
            self._add(table, ref, entry if ref in primary else F.when(whole, entry))

    def _ref(self, table: str, columns: Sequence[str]) -> int:
        return self.refs.setdefault((table, tuple(columns)), len(self.refs))

    def _add(self, table: str, ref: int, entry: Column) -> None:
        self.entries.setdefault(table, []).append((ref, entry))

    def enter(self, table: str, refs: set[int] | None = None, beside: Sequence[Column] = ()) -> DataFrame:
        """(ref, k0, k1, rest, slot) that the rows of a table enter, or enter at some refs, with the columns ``beside`` as ``_r``."""
        each = F.array(*[e for ref, e in self.entries[table] if refs is None or ref in refs])
        entered = self.frames[table].select(F.explode(each).alias("_e"), *([F.struct(*beside).alias("_r")] if beside else []))
        return entered.filter("_e is not null").select("_e.*", *(["_r"] if beside else []))

    def groups(self) -> DataFrame:
        """(ref, k0, k1, rest, n, c0, c1 ...): rows of the referred table and of each reference, per value."""
        parts = [self.enter(t) for t in self.entries]
        counts = [F.count_if(F.col("slot") == j).alias(f"c{j}") for j in range(self.slots)]
        return reduce(DataFrame.unionByName, parts).groupBy("ref", *_VALUE).agg(F.count_if(F.col("slot") < 0).alias("n"), *counts)

    def failures(self) -> DataFrame:
        """(ref, slot, k0, k1, rest, amount): values with failing rows, and how many."""
        empty = F.startswith("rest", F.lit(_GAP))
        n = F.col("n")
        found = [(_PRIMARY, F.when((n > 1) | empty, n)), (_UNIQUE, F.when((n > 1) & ~empty, n))]
        found += [(j, F.when(n == 0, F.col(f"c{j}"))) for j in range(self.slots)]
        each = F.array(*[F.struct(F.lit(slot).alias("slot"), amount.alias("amount")) for slot, amount in found])
        # most values fail nothing and end before they become rows
        wrong = reduce(or_, [F.coalesce(amount > 0, F.lit(False)) for _, amount in found])
        rows = self.groups().filter(wrong).select("ref", *_VALUE, F.explode(each).alias("_f"))
        return rows.select("ref", "_f.slot", *_VALUE, "_f.amount").filter("amount > 0")


_VALUE = ("k0", "k1", "rest")
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_GAP = "?"  # begins the rest of a value with a NULL part, which has all its parts there


def _entry(ref: int, value: Sequence[tuple[Column, T.DataType]], slot: int) -> Column:
    numbers = [i for i, (_, kind) in enumerate(value) if isinstance(kind, _WHOLE)][:2]
    k0, k1 = [*[value[i][0].cast("bigint") for i in numbers], F.lit(0).cast("bigint"), F.lit(0).cast("bigint")][:2]
    text = lambda parts: F.to_json(F.array(*[c.cast("string") for c in parts]))
    others = [c for i, (c, _) in enumerate(value) if i not in numbers]
    rest = text(others) if others else F.lit("")
    if value:
        gap = reduce(or_, [c.isNull() for c, _ in value])
        rest = F.when(gap, F.concat(F.lit(_GAP), text([c for c, _ in value]))).otherwise(rest)
        k0, k1 = (F.when(gap, F.lit(0).cast("bigint")).otherwise(k) for k in (k0, k1))
    return F.struct(F.lit(ref).alias("ref"), k0.alias("k0"), k1.alias("k1"), rest.alias("rest"), F.lit(slot).alias("slot"))


def _listed(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A few constants as a frame, without a scan."""
    each = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows])
    return spark.range(1).select(F.explode(each).alias("_r")).select("_r.*")


def constraint_report(frames: dict[str, DataFrame], model: Model) -> DataFrame:
    """A10: (constraint, kind, state, violations) over all tables of the model.

    One scan per table and one shuffle for all: row rules, keys and references
    are entries of one ledger, counted within each task first. What is declared
    NOVALIDATE is listed with NULL, not run. ``violations`` counts failing rows.
    """
    ledger = _Ledger(frames, model)
    spark = next(iter(frames.values())).sparkSession
    parts: list[DataFrame] = []
    if ledger.rules:
        sums = ledger.failures().groupBy(F.col("ref").alias("_ref"), F.col("slot").alias("_slot")).agg(F.sum("amount").alias("_n"))
        named = _listed(spark, [(r.name, r.kind, r.state, r.ref, r.slot) for r in ledger.rules], ("constraint_name", "kind", "state", "ref", "slot"))
        met = named.join(sums, (F.col("ref") == F.col("_ref")) & (F.col("slot") == F.col("_slot")), "left")
        parts.append(met.select("constraint_name", "kind", "state", F.coalesce("_n", F.lit(0)).cast("bigint").alias("violations")))
    if ledger.idle:
        parts.append(_listed(spark, ledger.idle, ("constraint_name", "kind", "state")).withColumn("violations", F.lit(None).cast("bigint")))
    if not parts:
        return spark.createDataFrame([], "constraint_name string, kind string, state string, violations long")
    return reduce(DataFrame.unionByName, parts)


def exceptions_table(frames: dict[str, DataFrame], model: Model, row: dict[str, Sequence[str]]) -> DataFrame:
    """(table, constraint, row) of every failing row; ``row`` names the columns kept per table, as JSON.

    The values that fail a key or a reference come from the ledger of
    ``constraint_report`` and are stored. A row then meets them with what it
    enters at a key or reference that fails somewhere; rules on single rows
    need no join.
    """
    ledger = _Ledger(frames, model)
    spark = next(iter(frames.values())).sparkSession
    if not ledger.rules:
        return spark.createDataFrame([], "table_name string, constraint_name string, row string")
    names = {f"{r.ref}/{r.slot}": r.name for r in ledger.rules if r.ref >= 0}
    place = F.concat_ws("/", F.col("ref").cast("string"), F.col("slot").cast("string"))
    bad = store(ledger.failures().filter((F.col("ref") >= 0) & place.isin(list(names))).select("ref", "slot", *_VALUE), "failures")
    failing = {r[0] for r in bad.select("ref").distinct().collect()}  # a few numbers of the model
    parts: list[DataFrame] = []
    for table in ledger.entries:
        columns = [F.col(f"`{c}`") for c in dict.fromkeys(row[table])]
        found: list[DataFrame] = []
        if table in ledger.tests:
            failed = frames[table].select(F.explode(F.array(*ledger.tests[table])).alias("constraint_name"), F.struct(*columns).alias("_r"))
            found.append(failed.filter("constraint_name is not null"))
        mine = failing & {ref for ref, _ in ledger.entries[table]}
        if mine:
            own = ledger.enter(table, mine, columns)
            own = own.select("_r", *[F.col(c).alias(f"_{c}") for c in ("ref", "slot", *_VALUE)])
            # a row of a key enters once, and may fail it as PRIMARY KEY and as UNIQUE
            met = reduce(and_, [F.col(f"_{c}") == F.col(c) for c in ("ref", *_VALUE)])
            met = met & ((F.col("_slot") == F.col("slot")) | ((F.col("_slot") < 0) & (F.col("slot") < 0)))
            label = F.create_map(*[F.lit(x) for at_name in names.items() for x in at_name])
            hit = own.join(bad.filter(F.col("ref").isin(list(mine))), met)
            found.append(hit.select(F.element_at(label, place).alias("constraint_name"), "_r"))
        text = F.to_json("_r", {"ignoreNullFields": "false"})
        parts += [f.select(F.lit(table).alias("table_name"), "constraint_name", text.alias("row")) for f in found]
    if not parts:
        return spark.createDataFrame([], "table_name string, constraint_name string, row string")
    return reduce(DataFrame.unionByName, parts)

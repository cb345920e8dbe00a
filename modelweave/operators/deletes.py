"""Deletes followed over the whole reference graph: CASCADE, SET NULL and refusal."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.model import ForeignKey
from modelweave.plans.keys import by_name
from modelweave.plans.workspace import store


@dataclass
class Deletion:
    """after: rows of each table; refused: (table_name, row_key) of deletes that were not made;
    blocked_by: (constraint_name, n) of the rows that stood in the way at first."""

    after: dict[str, DataFrame]
    refused: DataFrame
    blocked_by: DataFrame


def _groups(names: Sequence[str], edges: Sequence[ForeignKey]) -> list[list[str]]:
    """Tables in groups that refer to each other in a circle, each group after those it refers to."""
    reach = {t: {t} for t in names}
    grown = True
    while grown:
        grown = False
        for fk in edges:
            more = reach[fk.parent] - reach[fk.child]
            if more:
                reach[fk.child] |= more
                grown = True
    groups, seen = [], set()
    for t in sorted(names, key=lambda t: (len(reach[t]), t)):
        if t not in seen:
            ring = [u for u in names if u in reach[t] and t in reach[u]]
            seen |= set(ring)
            groups.append(ring)
    return groups


def _action(fk: ForeignKey, fixed: set[tuple[str, str]]) -> str:
    """CASCADE, SET NULL or REFUSE; a column that may not be NULL cannot be set to it."""
    if fk.on_delete.upper() == "SET NULL" and not any((fk.child, c) in fixed for c in fk.columns):
        return "SET NULL"
    return "CASCADE" if fk.on_delete.upper() == "CASCADE" else "REFUSE"


class _Graph:
    def __init__(self, tables, edges: list[ForeignKey], keys, fixed) -> None:
        self.edges, self.keys = edges, keys
        self.action = {id(fk): _action(fk, fixed) for fk in edges}
        self.groups = _groups(list(tables), edges)

    def up(self, table: str) -> list[ForeignKey]:
        return [fk for fk in self.edges if fk.child == table]

    def named(self, table: str) -> list[str]:
        """Columns by which a row of a table is known: its key and what others refer to."""
        return list(dict.fromkeys([*self.keys.get(table, ()), *[c for fk in self.edges if fk.parent == table for c in fk.parent_columns]]))

    def narrow(self, table: str, df: DataFrame) -> DataFrame:
        wanted = dict.fromkeys([*self.named(table), *[c for fk in self.up(table) for c in fk.columns]])
        return df.select(*[F.col(f"`{c}`") for c in wanted])

    def flags(self, table: str, rows: DataFrame, gone: dict[str, DataFrame]) -> DataFrame:
        """``rows`` with ``_f0``, ``_f1`` ...: the parent of the reference is deleted."""
        for i, fk in enumerate(self.up(table)):
            if fk.parent not in gone:
                rows = rows.withColumn(f"_f{i}", F.lit(False))
                continue
            lost = gone[fk.parent].select(*[F.col(f"`{c}`").alias(f"_p{j}") for j, c in enumerate(fk.parent_columns)]).distinct()
            lost = lost.withColumn(f"_f{i}", F.lit(True))
            rows = rows.join(lost, by_name([(c, f"_p{j}") for j, c in enumerate(fk.columns)]), "left").drop(*[f"_p{j}" for j in range(len(fk.columns))])
            rows = rows.withColumn(f"_f{i}", F.coalesce(f"_f{i}", F.lit(False)))
        return rows

    def any_flag(self, table: str, action: str) -> Column:
        found = [F.col(f"_f{i}") for i, fk in enumerate(self.up(table)) if self.action[id(fk)] == action]
        return reduce(or_, found, F.lit(False))

    def asked(self, table: str, rows: DataFrame, deletes: dict[str, DataFrame]) -> DataFrame:
        """``rows`` with ``_d``: the row itself is to be deleted."""
        if table not in deletes:
            return rows.withColumn("_d", F.lit(False))
        key = self.keys[table]
        named = deletes[table].select(*[F.col(f"`{k}`").alias(f"_d{j}") for j, k in enumerate(key)]).distinct().withColumn("_d", F.lit(True))
        rows = rows.join(named, by_name([(k, f"_d{j}") for j, k in enumerate(key)]), "left")
        return rows.drop(*[f"_d{j}" for j in range(len(key))]).withColumn("_d", F.coalesce("_d", F.lit(False)))

    def gone(self, table: str, touched: DataFrame) -> DataFrame:
        return touched.filter(F.col("_d") | self.any_flag(table, "CASCADE"))

    def closure(self, rows: dict[str, DataFrame], deletes: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Per table the rows that a delete touches (deleted, or referring to a deleted row), stored with their flags."""
        gone: dict[str, DataFrame] = {}
        touched: dict[str, DataFrame] = {}
        for ring in self.groups:
            if len(ring) > 1 or any(fk.parent == fk.child for fk in self.up(ring[0])):
                gone |= self._ring(ring, rows, deletes, gone)
            for t in ring:
                marked = self.flags(t, self.asked(t, rows[t], deletes), gone)
                any_flag = reduce(or_, [F.col(f"_f{i}") for i in range(len(self.up(t)))], F.col("_d"))
                if t not in deletes and not any(fk.parent in gone for fk in self.up(t)):
                    continue
                touched[t] = store(marked.filter(any_flag), "touched")
                gone[t] = self.gone(t, touched[t])
        return touched

    def _ring(self, ring: list[str], rows: dict[str, DataFrame], deletes, gone: dict[str, DataFrame]) -> dict[str, DataFrame]:
        """Deleted rows of tables in a circle: each round follows only the rows the round before found."""
        inside = [fk for fk in self.edges if fk.child in ring and fk.parent in ring and self.action[id(fk)] == "CASCADE"]
        rows = {t: store(rows[t], "narrow") for t in ring}
        found: dict[str, DataFrame] = {}
        fresh: dict[str, DataFrame] = {}
        for t in ring:
            marked = self.flags(t, self.asked(t, rows[t], deletes), gone)
            fresh[t] = store(self.gone(t, marked).select(*rows[t].columns), "lost")
        while fresh := {t: df for t, df in fresh.items() if not df.isEmpty()}:
            for t, df in fresh.items():
                found[t] = df if t not in found else store(found[t].unionByName(df), "lost")
            after: dict[str, DataFrame] = {}
            for fk in inside:
                if fk.parent not in fresh:
                    continue
                lost = fresh[fk.parent].select(*[F.col(f"`{c}`").alias(f"_p{j}") for j, c in enumerate(fk.parent_columns)]).distinct()
                hit = rows[fk.child].join(lost, by_name([(c, f"_p{j}") for j, c in enumerate(fk.columns)]), "left_semi")
                after[fk.child] = hit if fk.child not in after else after[fk.child].unionByName(hit)
            fresh = {t: store(self._without(df.distinct(), found.get(t)), "lost") for t, df in after.items()}
        return found

    def _without(self, rows: DataFrame, known: DataFrame | None) -> DataFrame:
        if known is None:
            return rows
        named = [(c, f"_k{j}") for j, c in enumerate(rows.columns)]
        known = known.select(*[F.col(f"`{c}`").alias(k) for c, k in named]).distinct()
        return rows.join(known, by_name(named, null_safe=True), "left_anti")

    def blocking(self, touched: dict[str, DataFrame]) -> dict[int, DataFrame]:
        """Rows that stay and refer to a deleted row by a reference that forbids it."""
        out = {}
        for n, fk in enumerate(self.edges):
            if self.action[id(fk)] == "REFUSE" and fk.child in touched and fk.parent in touched:
                i = self.up(fk.child).index(fk)
                stays = ~(F.col("_d") | self.any_flag(fk.child, "CASCADE"))
                out[n] = touched[fk.child].filter(stays & F.col(f"_f{i}"))
        return out

    def _parents(self, fk: ForeignKey, children: DataFrame, touched: dict[str, DataFrame]) -> DataFrame:
        """Deleted rows that ``children`` refer to by ``fk``."""
        named = children.select(*[F.col(f"`{c}`").alias(f"_c{j}") for j, c in enumerate(fk.columns)]).distinct()
        pairs = [(p, f"_c{j}") for j, p in enumerate(fk.parent_columns)]
        return self.gone(fk.parent, touched[fk.parent]).join(named, by_name(pairs), "left_semi")

    def held(self, touched: dict[str, DataFrame], blocking: dict[int, DataFrame]) -> dict[str, DataFrame]:
        """Deleted rows that cannot go: blocked ones, and all whose delete would take one of them along."""
        fresh: dict[str, DataFrame] = {}
        for n, rows in blocking.items():
            fk = self.edges[n]
            hit = self._parents(fk, rows, touched)
            fresh[fk.parent] = hit if fk.parent not in fresh else fresh[fk.parent].unionByName(hit)
        fresh = {t: store(df.distinct(), "held") for t, df in fresh.items()}
        held: dict[str, DataFrame] = {}
        while fresh := {t: df for t, df in fresh.items() if not df.isEmpty()}:
            for t, df in fresh.items():
                held[t] = df if t not in held else store(held[t].unionByName(df), "held")
            above: dict[str, DataFrame] = {}
            for fk in self.edges:
                if fk.child in fresh and fk.parent in touched and self.action[id(fk)] == "CASCADE":
                    hit = self._parents(fk, fresh[fk.child], touched)
                    above[fk.parent] = hit if fk.parent not in above else above[fk.parent].unionByName(hit)
            fresh = {t: store(self._without(df.distinct(), held.get(t)), "held") for t, df in above.items()}
        return held


def delete_rows(
    tables: dict[str, DataFrame],
    foreign_keys: Sequence[ForeignKey],
    deletes: dict[str, DataFrame],
    keys: dict[str, Sequence[str]],
    not_null: Sequence[tuple[str, str]] = (),
    all_or_nothing: bool = False,
) -> Deletion:
    """``deletes`` (keys of rows per table) and all that follows from them.

    CASCADE deletes the referring rows, SET NULL empties their foreign key, and
    any other reference refuses: a row that is still referred to when all is
    done is not deleted, nor is any row whose delete would take it along. A
    refused delete brings back what only it would have deleted, which may refuse
    others; this goes on until nothing is refused. ``all_or_nothing`` refuses
    every delete then, as one statement would. Columns in ``not_null`` (table,
    column) and key columns cannot be set to NULL: such a reference refuses.

    Works on keys alone: one narrow scan per table, with a join per reference,
    finds the rows that are touched; the rounds of a circle of references and of
    refusal read only those. At the end each table is scanned once.
    """
    edges = [fk for fk in foreign_keys if fk.active and {fk.child, fk.parent} <= set(tables)]
    fixed = {(t, c) for t, key in keys.items() for c in key} | set(not_null)
    graph = _Graph(tables, edges, keys, fixed)
    spark = next(iter(tables.values())).sparkSession
    wanted = {t: store(df.select(*[F.col(f"`{k}`") for k in keys[t]]).distinct(), "deletes") for t, df in deletes.items()}
    first = graph.closure({t: graph.narrow(t, df) for t, df in tables.items()}, wanted)
    touched, refused, blocked = first, [], []
    while True:
        blocking = graph.blocking(touched)
        if all(df.isEmpty() for df in blocking.values()):
            break
        if not blocked:
            blocked = [df.agg(F.count("*").alias("n")).select(F.lit(graph.edges[n].name).alias("constraint_name"), "n") for n, df in blocking.items()]
        held = {t: df for t, df in graph.held(touched, blocking).items() if t in wanted}
        for t, df in wanted.items():
            if all_or_nothing:
                refused.append(_labelled(t, df, keys[t]))
                wanted[t] = df.limit(0)
            elif t in held:
                key = held[t].filter("_d").select(*[F.col(f"`{k}`") for k in keys[t]]).distinct()
                refused.append(_labelled(t, key, keys[t]))
                wanted[t] = store(graph._without(df, key), "deletes")
        # what remains is a part of what was touched at first
        touched = graph.closure({t: graph.narrow(t, first[t]) if t in first else graph.narrow(t, df.limit(0)) for t, df in tables.items()}, wanted)
    gone = {t: graph.gone(t, df) for t, df in touched.items()}
    after = {t: _remaining(graph, t, df, gone, wanted) for t, df in tables.items()}
    none = spark.createDataFrame([], "table_name string, row_key string")
    free = spark.createDataFrame([], "constraint_name string, n long")
    return Deletion(after, reduce(DataFrame.unionByName, refused, none), reduce(DataFrame.unionByName, blocked, free))


def _labelled(table: str, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    label = F.to_json(F.struct(*[F.col(f"`{k}`").cast("string").alias(k) for k in key]))
    return rows.select(F.lit(table).alias("table_name"), label.alias("row_key"))


def _remaining(graph: _Graph, table: str, df: DataFrame, gone: dict[str, DataFrame], deletes: dict[str, DataFrame]) -> DataFrame:
    if table not in deletes and not any(fk.parent in gone for fk in graph.up(table)):
        return df
    marked = graph.flags(table, graph.asked(table, df, deletes), gone)
    kept = marked.filter(~(F.col("_d") | graph.any_flag(table, "CASCADE")))
    empty: dict[str, Column] = {}
    for i, fk in enumerate(graph.up(table)):
        if graph.action[id(fk)] == "SET NULL":
            for c in fk.columns:
                empty[c] = empty.get(c, F.lit(False)) | F.col(f"_f{i}")
    return kept.select(*[F.when(~empty[c], F.col(f"`{c}`")).alias(c) if c in empty else F.col(f"`{c}`") for c in df.columns])

"""Deletes over the reference graph against a plain walk over rows."""

import random

import pytest

from modelweave.model import ForeignKey
from modelweave.operators.deletes import delete_rows
from tests.conftest import rows


def plain(tables, columns, edges, deletes, keys):
    """Rows one by one: delete, follow, look for rows in the way, take back, and again."""
    at = lambda t, row, cols: tuple(row[columns[t].index(c)] for c in cols)
    wanted = {(t, k) for t, ks in deletes.items() for k in ks}
    while True:
        gone = {(t, n) for t, all_rows in tables.items() for n, row in enumerate(all_rows) if (t, at(t, row, keys[t])) in wanted}
        cause = {}
        grown = True
        while grown:
            grown = False
            for fk in edges:
                if fk.on_delete != "CASCADE":
                    continue
                for n, row in enumerate(tables[fk.child]):
                    for m, up in enumerate(tables[fk.parent]):
                        if (fk.parent, m) in gone and None not in at(fk.child, row, fk.columns) and at(fk.child, row, fk.columns) == at(fk.parent, up, fk.parent_columns):
                            cause.setdefault((fk.child, n), set()).add((fk.parent, m))
                            if (fk.child, n) not in gone:
                                gone.add((fk.child, n))
                                grown = True
        held = set()
        for fk in edges:
            if fk.on_delete in ("CASCADE", "SET NULL"):
                continue
            for n, row in enumerate(tables[fk.child]):
                for m, up in enumerate(tables[fk.parent]):
                    if (fk.child, n) not in gone and (fk.parent, m) in gone and at(fk.child, row, fk.columns) == at(fk.parent, up, fk.parent_columns):
                        held.add((fk.parent, m))
        todo = list(held)
        while todo:
            for up in cause.get(todo.pop(), ()):
                if up not in held:
                    held.add(up)
                    todo.append(up)
        back = {(t, at(t, tables[t][n], keys[t])) for t, n in held} & wanted
        if not back:
            break
        wanted -= back
    after = {}
    for t, all_rows in tables.items():
        kept = [list(row) for n, row in enumerate(all_rows) if (t, n) not in gone]
        for fk in edges:
            if fk.child == t and fk.on_delete == "SET NULL":
                lost = {at(fk.parent, tables[fk.parent][m], fk.parent_columns) for p, m in gone if p == fk.parent}
                for row in kept:
                    if at(t, row, fk.columns) in lost:
                        for c in fk.columns:
                            row[columns[t].index(c)] = None
        after[t] = sorted(map(tuple, kept), key=repr)
    return after, wanted


@pytest.mark.parametrize("seed", range(4))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    columns = {"a": ["a", "x"], "b": ["b", "fa", "fb"], "c": ["c", "fb2", "fa2"], "d": ["d", "fc", "fd"]}
    keys = {"a": ["a"], "b": ["b"], "c": ["c"], "d": ["d"]}
    pick = lambda n: r.choice([None, *range(n)])
    tables = {
        "a": [(i, 0) for i in range(6)],
        "b": [(i, pick(6), pick(12)) for i in range(12)],
        "c": [(i, pick(12), pick(6)) for i in range(12)],
        "d": [(i, pick(12), pick(10)) for i in range(10)],
    }
    how = lambda: r.choice(["CASCADE", "CASCADE", "SET NULL", ""])
    edges = [
        ForeignKey("ba", "b", ("fa",), "a", ("a",), how()),
        ForeignKey("bb", "b", ("fb",), "b", ("b",), how()),
        ForeignKey("cb", "c", ("fb2",), "b", ("b",), how()),
        ForeignKey("ca", "c", ("fa2",), "a", ("a",), how()),
        ForeignKey("dc", "d", ("fc",), "c", ("c",), how()),
        ForeignKey("dd", "d", ("fd",), "d", ("d",), how()),
    ]
    deletes = {"a": [(0,), (1,), (2,), (77,)], "d": [(3,)]}
    want, made = plain(tables, columns, edges, deletes, keys)
    frames = {t: spark.createDataFrame(data, ", ".join(f"{c} int" for c in columns[t])) for t, data in tables.items()}
    asked = {t: spark.createDataFrame(ks, f"{keys[t][0]} int") for t, ks in deletes.items()}
    got = delete_rows(frames, edges, asked, keys)
    assert {t: rows(df) for t, df in got.after.items()} == want
    refused = {(t, k) for t, ks in deletes.items() for k in ks} - made
    assert rows(got.refused) == sorted((t, f'{{"{keys[t][0]}":"{k[0]}"}}') for t, k in refused)


def test_two_tables_in_a_circle(spark):
    frames = {
        "a": spark.createDataFrame([(i, i - 1 if i else None) for i in range(8)], "a int, to_b int"),
        "b": spark.createDataFrame([(i, i) for i in range(8)], "b int, to_a int"),
    }
    edges = [ForeignKey("ab", "a", ("to_b",), "b", ("b",), "CASCADE"), ForeignKey("ba", "b", ("to_a",), "a", ("a",), "CASCADE")]
    got = delete_rows(frames, edges, {"a": frames["a"].filter("a = 5")}, {"a": ["a"], "b": ["b"]})
    assert rows(got.after["a"], "a") == rows(got.after["b"], "b") == [(0,), (1,), (2,), (3,), (4,)]


def test_one_statement_or_nothing_and_not_null(spark):
    frames = {"p": spark.createDataFrame([(1,), (2,)], "p int"), "c": spark.createDataFrame([(1, 1), (2, None)], "c int, up int")}
    edges = [ForeignKey("fk", "c", ("up",), "p", ("p",), "SET NULL")]
    keys = {"p": ["p"], "c": ["c"]}
    got = delete_rows(frames, edges, {"p": frames["p"]}, keys)
    assert got.after["p"].count() == 0 and rows(got.after["c"]) == [(1, None), (2, None)]
    got = delete_rows(frames, edges, {"p": frames["p"]}, keys, not_null=[("c", "up")])
    assert rows(got.after["p"]) == [(1,)] and rows(got.refused) == [("p", '{"p":"1"}')] and rows(got.blocked_by) == [("fk", 1)]
    got = delete_rows(frames, edges, {"p": frames["p"]}, keys, not_null=[("c", "up")], all_or_nothing=True)
    assert rows(got.after["p"]) == [(1,), (2,)] and got.refused.count() == 2
    got = delete_rows(frames, edges, {}, keys)
    assert rows(got.after["c"]) == [(1, 1), (2, None)] and got.refused.count() == 0

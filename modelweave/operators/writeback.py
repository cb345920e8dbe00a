"""Documents written back to stored tables, file by file, under their tags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from zlib import crc32

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.model import DocNode
from modelweave.operators import documents as D
from modelweave.operators.projections import filtered_view
from modelweave.operators.setops import snapshot_diff
from modelweave.plans.keys import by_name
from modelweave.plans.workspace import store
from modelweave.sources.live import LiveTables

_FILE = "_file"


def _nodes(node: DocNode) -> list[DocNode]:
    return [node, *[n for child in node.children for n in _nodes(child)]]


def _within(rows: DataFrame, column: str, keys: DataFrame, key: str) -> DataFrame:
    """``rows`` inside the range of ``keys``: statistics of the files then skip most of them."""
    low, high = keys.agg(F.min(key), F.max(key)).first()
    return rows.filter(F.col(column).between(F.lit(low), F.lit(high))) if low is not None else rows.limit(0)


def _met(rows: DataFrame, sides: Sequence[tuple[DataFrame, Sequence[tuple[str, str]]]]) -> DataFrame:
    """``rows`` that meet a key of any side, in one pass over them; a side is (keys, pairs of own and key columns)."""
    hit = F.lit(False)
    out = rows
    for i, (keys, pairs) in enumerate(sides):
        named = [(own, f"_m{i}_{j}") for j, (own, _) in enumerate(pairs)]
        marked = keys.select(*[F.col(f"`{k}`").alias(f"_m{i}_{j}") for j, (_, k) in enumerate(pairs)]).distinct().withColumn(f"_hit{i}", F.lit(True))
        out = out.join(marked, by_name(named), "left")
        hit = hit | F.coalesce(F.col(f"_hit{i}"), F.lit(False))
    return out.filter(hit).select(*rows.columns)


def _row_key(key: Sequence[str]) -> Column:
    return F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in key])).alias("row_key")


def _stale(docs: DataFrame, scope: dict[str, DataFrame], root: DocNode, labels: Sequence[str], tag: str) -> DataFrame:
    """Root keys of documents whose tag is not the one of what is stored now.

    Pages of one document count as one: a stale page makes it stale as a whole.
    """
    now = D.build_documents(root, {t: df.drop(_FILE) for t, df in scope.items()})
    return D.etag_conflicts(now, docs, root, labels, tag).select(*labels).distinct()


def write_documents(live: LiveTables, docs: DataFrame, root: DocNode, deleted: DataFrame | None = None, tag: str = "") -> tuple[LiveTables, DataFrame]:
    """Write edited documents back: (the next version, rejects as (table_name, row_key, action)).

    Rows, rights, conflicts and deletes are those of ``apply_documents``. With
    ``tag``, the column of ``docs`` that holds the tag a document was read with,
    a document that somebody else changed or deleted meanwhile is refused whole
    (action ``stale``), and so is one without a tag where one is stored. Rows
    that a WHERE of the document hides are neither shown nor deleted.

    Each table is scanned once, within the range of the keys, for the rows that
    the documents stand for, with the files that hold them. Only files with a
    changed or removed row are read again and written anew; all others keep
    their names. Nothing is visible before all tables are written.
    """
    nodes = {n.table: n for n in _nodes(root)}
    if len(nodes) < len(_nodes(root)):
        raise ValueError("a table stands at two places of the document: write back is not defined")
    label = {f.column: f.label for f in root.fields}
    labels = [label[k] for k in root.key]
    docs = store(docs, "docs")
    new_rows, _ = D.shred(docs, root)
    keys = docs.select(*[F.col(f"`{lab}`").alias(k) for k, lab in zip(root.key, labels)]).distinct()
    if deleted is not None:
        keys = keys.unionByName(deleted.select(*root.key)).distinct()
    keys = store(keys, "keys")

    scope: dict[str, DataFrame] = {}
    for node in _nodes(root):
        rows = live.read_with_file(node.table, _FILE)
        if node is root:
            near = _within(rows, root.key[0], keys, root.key[0])
            scope[node.table] = store(_met(near, [(keys, [(k, k) for k in root.key])]), "scope")
            continue
        above = scope[next(n.table for n in _nodes(root) if node in n.children)]
        sides = [(above, [(c, p) for p, c in node.on])]
        if node.kind == "object":
            sides.append((new_rows[node.table], [(k, k) for k in node.key]))
        scope[node.table] = store(_met(filtered_view(rows, node.where), sides), "scope")

    rejects: list[DataFrame] = []
    if tag:
        stale = store(_stale(docs, scope, root, labels, tag), "stale")
        named = stale.select(*[F.col(f"`{lab}`").alias(k) for k, lab in zip(root.key, labels)])
        rejects.append(named.select(F.lit(root.table).alias("table_name"), _row_key(root.key), F.lit("stale").alias("action")))
        docs = docs.join(stale.select(*[F.col(f"`{lab}`").alias(f"_s{i}") for i, lab in enumerate(labels)]), by_name([(lab, f"_s{i}") for i, lab in enumerate(labels)], null_safe=True), "left_anti")
        kept = named.select(*[F.col(k).alias(f"_s{i}") for i, k in enumerate(root.key)])
        keys = keys.join(kept, by_name([(k, f"_s{i}") for i, k in enumerate(root.key)], null_safe=True), "left_anti")
        new_rows, _ = D.shred(docs, root)
    _, conflicts = D.shred(docs, root)

    gone: dict[str, list[str]] = {}
    added: dict[str, list[str]] = {}

    def visit(node: DocNode, stored: DataFrame) -> None:
        key = list(node.key)
        columns = list(new_rows[node.table].columns)
        fresh = D._typed(new_rows[node.table], stored)
        # the file as a number of fixed width; two names with one number only write a file more
        old = stored.select(*columns, F.crc32(_FILE).alias(_FILE))
        diff = store(snapshot_diff(old, fresh, key, [_FILE]), "changes")
        refused = D.refusal(node, columns)
        rejects.append(diff.filter(refused).select(F.lit(node.table).alias("table_name"), _row_key(key), F.col("change").alias("action")))
        if node.table in conflicts:
            clash = conflicts[node.table].select(*key).distinct()
            rejects.append(clash.select(F.lit(node.table).alias("table_name"), _row_key(key), F.lit("conflict").alias("action")))
        allowed = diff.filter(~refused)
        touched = allowed.filter("change <> 'added'").select(_FILE).distinct()
        marks = {r[0] for r in touched.collect()}  # as many as there are files at most
        names = [f for f in (f.rpartition("/")[2] for f in live.files[node.table]) if crc32(f.encode()) in marks]
        whole = live.read(node.table, names)
        new = D._merge(whole, allowed, key, columns)
        files = live.add(node.table, new, key, max(1, len(names)), unique=True) if names or not allowed.isEmpty() else []
        gone[node.table], added[node.table] = names, files
        for child in node.children:
            below = scope[child.table]
            if child.kind == "array":
                below = _met(below, [(stored, [(c, p) for p, c in child.on])])
            else:
                below = _met(below, [(new_rows[child.table], [(k, k) for k in child.key])])
            visit(child, below)

    visit(root, _met(scope[root.table], [(keys, [(k, k) for k in root.key])]))
    return live.commit(gone, added), reduce(DataFrame.unionByName, rejects)

"""J08, D01..D07: nested documents out of tables, and back."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.model import DocNode
from modelweave.operators.joins import once
from modelweave.operators.projections import filtered_view
from modelweave.operators.setops import snapshot_diff
from modelweave.plans.keys import by_name, lookup
from modelweave.plans.pages import PAGE_ROWS, attach, collect_groups, with_pages
from modelweave.plans.workspace import store


def has_arrays(node: DocNode) -> bool:
    """True when the node, or an object below it, holds a list and so may need more pages."""
    return any(c.kind == "array" or has_arrays(c) for c in node.children)


@dataclass
class _Built:
    """Rows of a node: its own columns as ``c:name``, its children as ``v:name``."""

    df: DataFrame
    paged: bool


def _raw(column: str) -> str:
    return f"c:{column}"


def _q(column: str) -> Column:
    return F.col(f"`{column}`")


def _needed(node: DocNode, own: Sequence[str]) -> list[str]:
    columns = [f.column for f in node.fields] + [*own, *node.order]
    columns += [p for child in node.children for p, _ in child.on]
    return list(dict.fromkeys(columns))


def _labels(node: DocNode) -> list[str]:
    names = [f.label for f in node.fields]
    for child in node.children:
        names += _labels(child) if child.kind == "object" and child.unnest else [child.name]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"names used twice in a document: {', '.join(twice)}")
    return names


def _values(node: DocNode) -> list[Column]:
    """Fields and children of a node under their output keys."""
    values = [_q(_raw(f.column)).alias(f.label) for f in node.fields]
    for child in node.children:
        value = _q(f"v:{child.name}")
        if child.kind == "object" and child.unnest:
            values += [value[label].alias(label) for label in _labels(child)]
        else:
            values.append(value.alias(child.name))
    return values


def _entry(node: DocNode) -> Column:
    page = [F.col("_page")] if has_arrays(node) else []
    return F.struct(*_values(node), *page)


def _build(node: DocNode, tables: dict[str, DataFrame], page_rows: int) -> _Built:
    own = [c for _, c in node.on]
    df = filtered_view(tables[node.table], node.where)
    df = df.select(*[F.col(c).alias(_raw(c)) for c in _needed(node, own)], F.lit(1).cast("long").alias("_weight"))
    built = _Built(with_pages(df), False)
    reset: dict[str, Column] = {}
    # objects first: a list is then attached to rows that are complete
    for child in sorted(node.children, key=lambda c: c.kind != "object"):
        if not child.on:
            raise ValueError(f"{child.name}: a subquery needs join columns")
        built.paged = _attach_child(built, child, tables, page_rows, reset) or built.paged
    return built


def _attach_child(
    built: _Built, child: DocNode, tables: dict[str, DataFrame], page_rows: int, reset: dict[str, Column]
) -> bool:
    below = _build(child, tables, page_rows)
    keys = [_raw(c) for _, c in child.on]
    rows = below.df.filter(reduce(and_, [_q(k).isNotNull() for k in keys]))
    pairs = [(_raw(p), _raw(c)) for p, c in child.on]
    name = f"v:{child.name}"
    if child.kind == "array":
        grouped, paged = collect_groups(
            rows, keys, _entry(child), [_raw(c) for c in child.order], name, F.col("_weight"), page_rows
        )
        empty = F.array().cast(grouped.schema[name].dataType)
    else:
        per_page = [*keys, "_page", "_pages"] if below.paged else keys
        grouped = rows.groupBy(*[_q(k) for k in per_page]).agg(
            F.count("*").alias("_n"), F.any_value(_entry(child)).alias("_v"), F.sum("_weight").alias("_weight")
        )
        paged = below.paged
        if not paged:
            grouped = with_pages(grouped)
        grouped = grouped.select(*[_q(k) for k in keys], once("_n", "_v", name), "_weight", "_page", "_pages")
        empty = F.lit(None).cast(grouped.schema[name].dataType)
    built.df = attach(built.df, grouped, pairs, name, empty, paged, reset)
    reset[name] = empty
    return paged


def nest(root: DocNode, tables: dict[str, DataFrame], page_rows: int = PAGE_ROWS) -> DataFrame:
    """The document of ``root`` as columns, subqueries of any depth nested below.

    Built from the leaves up, one join per edge. ``_page`` is 0 but for
    documents above ``page_rows`` entries, which go on in further rows.
    """
    _labels(root)
    built = _build(root, tables, page_rows)
    page = [F.col("_page")] if has_arrays(root) else []
    return built.df.select(*_values(root), *page)


def build_documents(
    root: DocNode, tables: dict[str, DataFrame], as_json: bool = False, page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Whole documents under their output keys; ``as_json`` gives (root key fields, doc, _page).

    A flex column is a JSON text under its own key; in the text form of a
    document its entries stand beside the fields of its node, at any level
    (``parse_documents`` takes them back).
    """
    docs = nest(root, tables, page_rows)
    if not as_json:
        return docs
    if any(f.flex for child in root.children for node in _walk(child) for f in node.fields):
        keys = [f.label for f in root.fields if f.column in root.key]
        page = ["_page"] if "_page" in docs.columns else []
        text = F.concat(F.lit("{"), _inner_text(root, lambda label: F.col(f"`{label}`")), F.lit("}"))
        return docs.select(*keys, text.alias("doc"), *page)
    flex = [f.label for f in root.fields if f.flex]
    body = [c for c in docs.columns if c != "_page" and c not in flex]
    keys = [f.label for f in root.fields if f.column in root.key]
    page = ["_page"] if "_page" in docs.columns else []
    doc = F.to_json(F.struct(*body), {"ignoreNullFields": "false"})
    for label in flex:
        doc = _beside(doc, label, body)
    return docs.select(*keys, doc.alias("doc"), *page)


def _beside(doc: Column, flex: str, taken: Sequence[str]) -> Column:
    """The text of an object with the entries of a JSON column put after its fields; a field wins."""
    entries = F.try_variant_get(F.try_parse_json(flex), F.lit("$"), "map<string,variant>")
    free = F.map_filter(entries, lambda k, _: ~k.isin(*taken))
    more = F.concat(F.substring(doc, F.lit(1), F.length(doc) - 1), F.lit(","), F.substring(F.to_json(free), F.lit(2), F.length(F.to_json(free))))
    return F.when(F.size(free) > 0, more).otherwise(doc)


def _cut(text: Column) -> Column:
    """The text of an object without its braces."""
    return F.substring(text, F.lit(2), F.length(text) - 2)


def _inner_text(node: DocNode, get) -> Column:
    """What stands between the braces of a node: fields, subqueries, then the entries of its flex columns; a field wins."""
    plain = [get(f.label).alias(f.label) for f in node.fields if not f.flex]
    if has_arrays(node) and node.kind != "root":
        plain.append(get("_page").alias("_page"))
    parts = [_cut(F.to_json(F.struct(*plain), {"ignoreNullFields": "false"}))] if plain else []
    for child in node.children:
        if child.kind == "object" and child.unnest:
            parts.append(_inner_text(child, get))
            continue
        value = get(child.name)
        whole = lambda get, c=child: F.concat(F.lit("{"), _inner_text(c, get), F.lit("}"))
        if child.kind == "object":
            text = F.when(value.isNull(), F.lit("null")).otherwise(whole(value.getItem))
        else:
            text = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: whole(x.getItem)), ","), F.lit("]"))
        parts.append(F.concat(F.lit(json.dumps(child.name, ensure_ascii=False) + ":"), text))
    taken = _level_names(node)
    for f in node.fields:
        if f.flex:
            entries = F.try_variant_get(F.try_parse_json(get(f.label)), F.lit("$"), "map<string,variant>")
            free = F.map_filter(entries, lambda k, _: ~k.isin(*taken))
            parts.append(F.when(F.size(free) > 0, _cut(F.to_json(free))))
    # a part without entries is NULL and left out
    return F.concat_ws(",", *[F.nullif(p, F.lit("")) for p in parts])


def _level_names(node: DocNode) -> list[str]:
    """Keys that are no flex entries on the level of a node."""
    names = [f.label for f in node.fields if not f.flex]
    for child in node.children:
        names += _level_names(child) if child.kind == "object" and child.unnest else [child.name]
    return [*names, "_page"]


def parse_documents(docs: DataFrame, root: DocNode, tables: dict[str, DataFrame], doc: str = "doc") -> DataFrame:
    """The column form of documents in text form, for ``shred``; types are those of ``tables``.

    Entries that are no field of their node go back into its flex column (the
    last one, if it has several; NULL without entries). Without a flex column
    they are dropped. Texts that do not parse give NULL fields.
    """

    def member(v: Column, name: str, kind: str) -> Column:
        return F.try_variant_get(v, F.lit(f"$[{json.dumps(name, ensure_ascii=False)}]"), kind)

    def entries(node: DocNode, v: Column, taken: Sequence[str]) -> list[Column]:
        types = tables[node.table].schema
        flex = [f for f in node.fields if f.flex]
        out = []
        for f in node.fields:
            if not f.flex:
                out.append(member(v, f.label, types[f.column].dataType.simpleString()).alias(f.label))
            elif f is flex[-1]:
                free = F.map_filter(F.try_variant_get(v, F.lit("$"), "map<string,variant>"), lambda k, _: ~k.isin(*taken))
                out.append(F.when(F.size(free) > 0, F.to_json(free)).alias(f.label))
            else:
                out.append(F.lit(None).cast("string").alias(f.label))
        for child in node.children:
            if child.kind == "object" and child.unnest:
                out += entries(child, v, taken)
                continue
            below = lambda x, c=child: F.struct(*entries(c, x, _level_names(c)), *([member(x, "_page", "bigint").alias("_page")] if has_arrays(c) else []))
            if child.kind == "object":
                inside = member(v, child.name, "variant")
                out.append(F.when(inside.isNotNull() & ~F.is_variant_null(inside), below(inside)).alias(child.name))
            else:
                items = F.coalesce(member(v, child.name, "array<variant>"), F.array().cast("array<variant>"))
                out.append(F.transform(items, lambda x: below(x)).alias(child.name))
        return out

    rows = docs.withColumn("_v", F.try_parse_json(doc))
    page = [F.col("_page")] if has_arrays(root) else []
    return rows.select(*entries(root, F.col("_v"), _level_names(root)), *page)


def rename_fields(columns: dict[str, str]) -> Column:
    """A struct of columns under other keys ({column: key})."""
    return F.struct(*[F.col(c).alias(k) for c, k in columns.items()])


def flex_merge(df: DataFrame, columns: Sequence[str], flex: str, name: str = "doc") -> DataFrame:
    """Entries of a JSON object column beside the fields, as a map of texts; a field wins over an entry."""
    fields = F.create_map(*[x for c in columns for x in (F.lit(c), F.col(c).cast("string"))])
    extra = F.coalesce(F.from_json(flex, "map<string,string>"), F.create_map().cast("map<string,string>"))
    free = F.map_filter(extra, lambda k, _: ~k.isin(*columns))
    return df.withColumn(name, F.map_concat(fields, free))


def _counts(tags, node_tags) -> bool:
    """CHECK or NOCHECK of the column, else of its table, else checked."""
    check = (tags.check if tags is not None else "") or node_tags.check
    return check.upper() != "NOCHECK"


def _checked(node: DocNode, get) -> Column:
    parts = [
        get(f.label).cast("string").alias(f.label) for f in node.fields if _counts(f.tags, node.tags)
    ]
    for child in node.children:
        if child.kind == "object" and child.unnest:
            value = _checked(child, get)
        elif child.kind == "object":
            whole = get(child.name)
            value = _checked(child, whole.getItem)
        else:
            value = F.transform(get(child.name), lambda x: _checked(child, x.getItem))
        parts.append(value.alias(child.name))
    return F.struct(*parts)


def etag_of(root: DocNode) -> Column:
    """SHA-256 over the checked fields in declared order; NOCHECK fields do not count.

    A document on several pages has one tag per page.
    """
    text = F.to_json(_checked(root, lambda label: F.col(f"`{label}`")), {"ignoreNullFields": "false"})
    return F.sha2(text, 256)


def etag(docs: DataFrame, root: DocNode, name: str = "_etag") -> DataFrame:
    """Documents with their tag."""
    return docs.withColumn(name, etag_of(root))


def etag_conflicts(stored: DataFrame, docs: DataFrame, root: DocNode, key: Sequence[str], tag: str = "_etag") -> DataFrame:
    """Incoming documents whose tag is not the one of the stored document.

    ``stored`` are documents as they are now; each page is compared with its
    like. A document with a tag of which nothing is stored any more was deleted
    meanwhile: a conflict. One without a tag and without a stored document is new.
    """
    pages = ["_page"] if "_page" in stored.columns and "_page" in docs.columns else []
    now = stored.select(*[F.col(k).alias(f"_s_{k}") for k in [*key, *pages]], etag_of(root).alias("stored_etag"))
    pairs = [(k, f"_s_{k}") for k in [*key, *pages]]
    joined = docs.join(now, by_name(pairs), "left")
    wrong = ~F.col(tag).eqNullSafe(F.col("stored_etag"))
    return joined.filter(wrong).select(*docs.columns, "stored_etag")


def _shred(node: DocNode, docs: DataFrame, get, linked: dict[str, Column], out: dict[str, list[DataFrame]]) -> None:
    """Rows of ``node`` out of frames whose columns ``get`` reads; ``linked`` are join columns of its parent."""
    columns = {f.column: get(f.label) for f in node.fields}
    for child in node.children:
        if child.kind != "object":
            continue
        source = get if child.unnest else (lambda label, c=child: get(c.name)[label])
        known = {f.column: f.label for f in child.fields}
        for parent_col, child_col in child.on:
            if parent_col not in columns and child_col in known:
                columns[parent_col] = source(known[child_col])
    for column, value in linked.items():
        columns.setdefault(column, value)
    rows = docs
    if has_arrays(node):
        rows = rows.filter(get("_page") == 0)
    if node.kind == "object":
        rows = rows.filter(reduce(or_, [v.isNotNull() for v in columns.values()]))
    out.setdefault(node.table, []).append(rows.select(*[v.alias(c) for c, v in columns.items()]))
    for child in node.children:
        links = {c: columns[p] for p, c in child.on if p in columns}
        if child.kind == "object":
            below = get if child.unnest else (lambda label, c=child: get(c.name)[label])
            _shred(child, docs, below, links, out)
            continue
        carried = [v.alias(f"_l_{c}") for c, v in links.items()]
        items = docs.select(F.explode(get(child.name)).alias("_item"), *carried)
        _shred(child, items, lambda label: F.col("_item")[label], {c: F.col(f"_l_{c}") for c in links}, out)


def shred(docs: DataFrame, root: DocNode) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The inverse of ``build_documents``: ({table: rows}, {table: conflicting rows}).

    A row shared by several documents (an object) comes back once when its
    content is the same everywhere; different contents for one key are a
    conflict, never the last one. List entries are not made distinct.
    """
    out: dict[str, list[DataFrame]] = {}
    _shred(root, docs, lambda label: F.col(f"`{label}`"), {}, out)
    nodes = {n.table: n for n in _walk(root)}
    rows: dict[str, DataFrame] = {}
    conflicts: dict[str, DataFrame] = {}
    for table, frames in out.items():
        df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        if nodes[table].kind != "object":
            rows[table] = df
            continue
        key = list(nodes[table].key)
        rest = [c for c in df.columns if c not in key]
        content = F.struct(*rest)
        seen = df.groupBy(*key).agg(F.min(content).alias("_a"), F.max(content).alias("_b"))
        same = F.col("_a").eqNullSafe(F.col("_b"))
        rows[table] = seen.filter(same).select(*key, *[F.col("_a")[c].alias(c) for c in rest]).select(*df.columns)
        bad = seen.filter(~same).select(*key)
        conflicts[table] = lookup(df, bad, [(k, k) for k in key], "left_semi", null_safe=True, unique=True)
    return rows, conflicts


def _walk(node: DocNode):
    yield node
    for child in node.children:
        yield from _walk(child)


def _may_update(node: DocNode, column: str) -> bool:
    tags = next((f.tags for f in node.fields if f.column == column and f.tags is not None), None)
    return tags.update if tags is not None else node.tags.update


def refusal(node: DocNode, columns: Sequence[str]) -> Column:
    """Condition on a row of ``snapshot_diff``: the rights of the node do not allow the change."""
    fixed = [c for c in columns if c not in node.key and not _may_update(node, c)]
    blocked = F.lit(False)
    if fixed:
        blocked = reduce(or_, [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in fixed])
    return (
        F.when(F.col("change") == "added", F.lit(not node.tags.insert))
        .when(F.col("change") == "removed", F.lit(not node.tags.delete))
        .when(F.col("change") == "modified", blocked)
        .otherwise(F.lit(True))
    )


def apply_documents(
    tables: dict[str, DataFrame], docs: DataFrame, root: DocNode, deleted: DataFrame | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Write edited documents back: ({table: rows after}, rejects).

    ``docs`` replace the documents with their root keys. List entries that are
    stored below such a document but missing in it are deletes; ``deleted``
    (root key columns) names documents to delete with their entries. Objects
    are inserted or updated, never deleted. What the rights of a table or column
    do not allow is a reject (table, key, action), and so are conflicting
    contents and keys that come twice.

    The documents, and the changes of each table, are stored once: rows after
    and rejects are then two views of the same comparison.
    """
    names = [n.table for n in _walk(root)]
    if len(set(names)) < len(names):
        raise ValueError("a table stands at two places of the document: write back is not defined")
    docs = store(docs, "docs")
    new_rows, conflicts = shred(docs, root)
    after = dict(tables)
    rejects: list[DataFrame] = []

    def visit(node: DocNode, stored_scope: DataFrame) -> None:
        """``stored_scope``: the stored rows the documents stand for."""
        key = list(node.key)
        fresh = new_rows[node.table]
        columns = list(fresh.columns)
        diff = store(snapshot_diff(stored_scope.select(*columns), _typed(fresh, stored_scope), key), "changes")
        refused = refusal(node, columns)
        label = F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in key])).alias("row_key")
        rejects.append(diff.filter(refused).select(F.lit(node.table).alias("table_name"), label, F.col("change").alias("action")))
        allowed = diff.filter(~refused)
        after[node.table] = _merge(after[node.table], allowed, key, columns)
        if node.table in conflicts:
            clash = conflicts[node.table].select(*key).distinct()
            rejects.append(clash.select(F.lit(node.table).alias("table_name"), label, F.lit("conflict").alias("action")))
        for child in node.children:
            stored = tables[child.table]
            if child.kind == "array":
                linked = [(p, c) for p, c in child.on]
                scope = lookup(stored, stored_scope, [(c, p) for p, c in linked], "left_semi")
            else:
                scope = lookup(stored, new_rows[child.table], [(k, k) for k in child.key], "left_semi")
            visit(child, scope)

    keys = new_rows[root.table].select(*root.key)
    if deleted is not None:
        keys = keys.unionByName(deleted.select(*root.key))
    visit(root, lookup(tables[root.table], keys, [(k, k) for k in root.key], "left_semi"))
    return after, reduce(DataFrame.unionByName, rejects)


def _typed(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast(like.schema[c].dataType).alias(c) for c in df.columns])


def _merge(stored: DataFrame, changes: DataFrame, key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Stored rows with allowed changes in place: removed rows out, new values in, added rows after them."""
    edits = changes.select(*[F.col(k).alias(f"_e_{k}") for k in key], "change", "new").filter("change <> 'added'")
    joined = stored.join(edits, by_name([(k, f"_e_{k}") for k in key], null_safe=True), "left")
    joined = joined.filter(~F.col("change").eqNullSafe(F.lit("removed")))
    hit = F.col("change") == "modified"
    kept = joined.select(
        *[F.when(hit, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in stored.columns]
    )
    added = changes.filter("change = 'added'").select(*[F.col(f"new.{c}").alias(c) for c in columns])
    return kept.unionByName(added, allowMissingColumns=True).select(*stored.columns)

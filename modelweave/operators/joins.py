"""J01..J18: joins, nesting, foreign keys, id resolution.

Equi joins carry no hints: Spark broadcasts a side it has measured to be small
and splits hot keys of a sort-merge join at run time (AQE skew join).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.operators.intervals import interval_join, interval_lists
from modelweave.plans.keys import Pairs, by_name, lookup, same_keys, single, tied
from modelweave.plans.pages import PAGE_ROWS, attach, collect_groups, with_pages
from modelweave.plans.workspace import store


def join_inner(a: DataFrame, b: DataFrame, on: Pairs, where: str = "") -> DataFrame:
    """Inner join, then a filter on either side (pushed below the join by Spark)."""
    joined = a.join(b, same_keys(a, b, on))
    return joined.filter(F.expr(where)) if where else joined


def join_left_flag(
    a: DataFrame, b: DataFrame, on: Pairs, flag: str, name: str, off: object, on_value: object
) -> DataFrame:
    """Left join, then ``off`` where the flag is NULL or 'N', else ``on_value``."""
    joined = a.join(b, same_keys(a, b, on), "left")
    unset = b[flag].isNull() | (b[flag].cast("string") == "N")
    return joined.select(*[a[c] for c in a.columns], F.when(unset, F.lit(off)).otherwise(F.lit(on_value)).alias(name))


def anti_by_null(a: DataFrame, b: DataFrame, on: Pairs) -> DataFrame:
    """LEFT JOIN ... WHERE right IS NULL."""
    return lookup(a, b, on, "left_anti")


def not_in(a: DataFrame, b: DataFrame, on: Pairs, sql_nulls: bool = False) -> DataFrame:
    """Rows of ``a`` without a partner in ``b``.

    ``sql_nulls`` follows NOT IN: a NULL among the keys of ``b`` empties the
    result, and a NULL key of ``a`` is dropped unless ``b`` is empty. The NULL
    test is a one-row aggregate, so no null-aware broadcast join is needed.
    """
    left = lookup(a, b, on, "left_anti")
    if not sql_nulls:
        return left
    missing = reduce(or_, [F.col(f"`{k}`").isNull() for _, k in on])
    any_null = b.agg(F.coalesce(F.bool_or(missing), F.lit(False))).scalar()
    no_rows = b.agg(F.count("*") == 0).scalar()
    own_null = reduce(or_, [F.col(f"`{k}`").isNull() for k, _ in on])
    return left.filter(no_rows | (~any_null & ~own_null))


def join_view(frames: dict[str, DataFrame], on: str) -> DataFrame:
    """View over several tables; ``on`` holds its join keys as text over the table names.

    Each further table must be tied to an earlier one by an equality of columns;
    anything else would be a product of the tables and is refused.
    """
    tied(on, list(frames))
    (first, df), *rest = frames.items()
    view = df.alias(first)
    for name, frame in rest:
        view = view.join(frame.alias(name))
    return view.filter(F.expr(on))


def nest_one(
    parent: DataFrame, child: DataFrame, on: Pairs, fields: Sequence[Column | str], name: str, rely: bool = False
) -> DataFrame:
    """One child row as a nested object, NULL when there is none.

    A child key with several rows raises when it is read; ``rely`` trusts a
    declared key and saves that check.
    """
    keys = [c for _, c in on]
    item = F.struct(*fields).alias(name)
    if rely:
        right = child.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], item)
    else:
        right = child.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
            F.count("*").alias("_n"), F.any_value(item).alias("_v")
        )
        right = right.select(*[f"_k{i}" for i in range(len(keys))], once("_n", "_v", name))
    pairs = [(p, f"_k{i}") for i, (p, _) in enumerate(on)]
    return parent.join(right, by_name(pairs), "left").select(*parent.columns, name)


def once(count: str, value: str, name: str) -> Column:
    """``value``, or an error when ``count`` is above 1."""
    message = F.lit(f"{name}: more than one row for a key of an object")
    return F.when(F.col(count) > 1, F.raise_error(message)).otherwise(F.col(value)).alias(name)


def nest_many(
    parent: DataFrame,
    child: DataFrame,
    on: Pairs,
    fields: Sequence[Column | str],
    name: str,
    order: Sequence[str] = (),
    page_rows: int = PAGE_ROWS,
) -> DataFrame:
    """Child rows as a list ordered by ``order``, then by the fields; empty when there are none.

    Lists above ``page_rows`` go on in further rows of the parent (``_page`` 1, 2, ...).
    """
    keys = [c for _, c in on]
    live = child.filter(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    grouped, paged = collect_groups(live, keys, F.struct(*fields), order, name, page_rows=page_rows)
    empty = F.array().cast(grouped.schema[name].dataType)
    return attach(with_pages(parent), grouped, on, name, empty, paged).drop("_pages")


def unnest_one(parent: DataFrame, child: DataFrame, on: Pairs, fields: Sequence[str], rely: bool = False) -> DataFrame:
    """Fields of an object subquery at the level of the parent; equal names are an error."""
    clash = sorted(set(parent.columns) & set(fields))
    if clash:
        raise ValueError(f"names on both levels: {', '.join(clash)}")
    nested = nest_one(parent, child, on, fields, "_child", rely)
    return nested.select(*parent.columns, *[F.col("_child")[f].alias(f) for f in fields])


def nest_where(
    parent: DataFrame,
    child: DataFrame,
    on: Pairs,
    where: str,
    key: Sequence[str],
    fields: Sequence[Column | str],
    name: str,
    order: Sequence[str] = (),
    page_rows: int = PAGE_ROWS,
    between: tuple[str, str, str] | None = None,
) -> DataFrame:
    """Like ``nest_many`` with any further predicate ``where`` over both tables.

    ``key`` identifies a parent row. The equality pairs ``on``, or ``between``
    (child column, low and high column of the parent), carry the join; the rest
    filters it. Without either it would compare all rows, and is refused. Lists
    of ranges are taken from arrays of points where ``interval_lists`` can, in
    pages that follow each other by ``order``, then by the fields.
    """
    if not on and not between:
        raise ValueError("the subquery needs a pair of equal columns or a range")
    ready = None
    if between and not on:
        lists = interval_lists(parent, child, where, key, fields, name, order, page_rows, between)
        if lists and lists[1] is None:
            return lists[0]
        if lists:
            ready, parent = lists
    left = parent.select("*", *[F.col(k).alias(f"_p_{k}") for k in key])
    if between:
        point, low, high = between
        met = interval_join(left, child, low, high, point, on)
    else:
        met = left.join(child, same_keys(left, child, on))
    met = met.filter(F.expr(where)) if where else met
    grouped, paged = collect_groups(met, [f"_p_{k}" for k in key], F.struct(*fields), order, name, page_rows=page_rows)
    empty = F.array().cast(grouped.schema[name].dataType)
    nested = attach(with_pages(parent), grouped, [(k, f"_p_{k}") for k in key], name, empty, paged).drop("_pages")
    return nested if ready is None else ready.unionByName(nested)


def nest_self(
    df: DataFrame, on: Pairs, fields: Sequence[str], name: str, order: Sequence[str] = (), page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Rows of a table with rows of the same table nested below."""
    child = df.select(*[F.col(c).alias(f"_b_{c}") for c in df.columns])
    inner = [(p, f"_b_{c}") for p, c in on]
    columns = [F.col(f"_b_{f}").alias(f) for f in fields]
    return nest_many(df, child, inner, columns, name, [f"_b_{c}" for c in order], page_rows)


def fk_orphans(child: DataFrame, parent: DataFrame, fk: Sequence[str], pk: Sequence[str], active: bool = True) -> DataFrame:
    """Child rows whose foreign key has no parent; a NULL part means no reference."""
    if not active:
        return child.limit(0)
    refers = child.filter(reduce(and_, [F.col(c).isNotNull() for c in fk]))
    return lookup(refers, parent, list(zip(fk, pk)), "left_anti")


def _hit_rows(child: DataFrame, lost: DataFrame, fk, how: str) -> DataFrame:
    return lookup(child, lost, list(zip(fk.columns, fk.parent_columns)), how)


def _parents_first(edges: Sequence, root: str) -> list[str] | None:
    """Tables below ``root``, each after all tables it refers to; None when the references form a cycle."""
    below, todo = {root}, [root]
    while todo:
        here = todo.pop()
        for fk in edges:
            if fk.parent == here and fk.child not in below:
                below.add(fk.child)
                todo.append(fk.child)
    order, left = [], set(below)
    while left:
        free = [t for t in sorted(left) if not any(fk.child == t and fk.parent in left for fk in edges)]
        if not free:
            return None
        order += free
        left -= set(free)
    return order


def cascade_delete(
    tables: dict[str, DataFrame],
    foreign_keys: Sequence,
    root: str,
    deletes: DataFrame,
    root_key: Sequence[str],
    keys: dict[str, Sequence[str]] | None = None,
) -> dict[str, DataFrame]:
    """Tables after deleting ``deletes`` from ``root``, followed along ON DELETE CASCADE.

    Tables are visited parents first, so that each sees all its lost parents;
    the result is one lazy plan. References in a cycle (also a table to itself)
    need ``keys`` and run in rounds until no further row is lost.
    """
    edges = [
        fk for fk in foreign_keys if fk.active and fk.on_delete == "CASCADE" and {fk.child, fk.parent} <= set(tables)
    ]
    first = deletes.select(*root_key).distinct()
    order = _parents_first(edges, root)
    if order is None:
        return _cascade_rounds(tables, edges, root, first, root_key, keys or {})
    gone = {root: tables[root].join(first, list(root_key), "left_semi")}
    after = {**tables, root: tables[root].join(first, list(root_key), "left_anti")}
    for name in order[1:]:
        for fk in edges:
            if fk.child == name and fk.parent in gone:
                lost = _hit_rows(tables[name], gone[fk.parent], fk, "left_semi")
                gone[name] = lost if name not in gone else gone[name].unionByName(lost)
                after[name] = _hit_rows(after[name], gone[fk.parent], fk, "left_anti")
    return after


def _cascade_rounds(tables, edges, root, first, root_key, keys) -> dict[str, DataFrame]:
    """Round by round from the rows lost last; each round is stored, so lineage stays short."""
    keys = {root: root_key, **keys}
    after = {**tables, root: tables[root].join(first, list(root_key), "left_anti")}
    lost = {root: store(tables[root].join(first, list(root_key), "left_semi"), "lost")}
    while lost:
        found: dict[str, DataFrame] = {}
        for fk in edges:
            if fk.parent in lost:
                hit = _hit_rows(after[fk.child], lost[fk.parent], fk, "left_semi")
                found[fk.child] = hit if fk.child not in found else found[fk.child].unionByName(hit)
        lost = {}
        for name, rows in found.items():
            rows = store(rows, "lost")
            if rows.isEmpty():
                continue
            lost[name] = rows
            after[name] = store(after[name].join(rows.select(*keys[name]), list(keys[name]), "left_anti"), "kept")
    return after


def set_null_on_delete(child: DataFrame, deletes: DataFrame, fk: Sequence[str], pk: Sequence[str]) -> DataFrame:
    """The foreign key becomes NULL where its parent is deleted."""
    lost = deletes.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(pk)]).distinct().withColumn("_hit", F.lit(True))
    pairs = [(c, f"_k{i}") for i, c in enumerate(fk)]
    joined = child.join(lost, by_name(pairs), "left")
    return joined.select(
        *[F.when(F.col("_hit"), None).otherwise(F.col(c)).alias(c) if c in fk else F.col(c) for c in child.columns]
    )


def _facing(edges: DataFrame, src: str, dst: str, how: str) -> DataFrame:
    """Edges that have, or have not, their reverse; self loops are not mutual.

    Only edges from what is an end somewhere, to what is a start somewhere, can
    have a reverse: two joins with single vertices leave these. One aggregate
    over their two ends finds the pairs that are there both ways, without a
    sort; the edges then meet these pairs only.
    """
    a, b = F.col(f"`{src}`"), F.col(f"`{dst}`")
    ends = lookup(edges.filter(a != b), edges, [(src, dst)], "left_semi")
    ends = lookup(ends, edges, [(dst, src)], "left_semi")
    ends = ends.select(F.least(a, b).alias("_lo"), F.greatest(a, b).alias("_hi"), (a < b).alias("_up"))
    both = ends.groupBy("_lo", "_hi").agg(F.min("_up").alias("_min"), F.max("_up").alias("_max")).filter("_min <> _max")
    ways = F.array(F.struct(F.col("_lo").alias("a"), F.col("_hi").alias("b")), F.struct(F.col("_hi").alias("a"), F.col("_lo").alias("b")))
    pairs = both.select(F.explode(ways).alias("_w")).select("_w.a", "_w.b")
    return lookup(edges, pairs, [(src, "a"), (dst, "b")], how, unique=True)


def mutual_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Edges whose reverse is there as well."""
    return _facing(edges, src, dst, "left_semi")


def without_mutual_edges(edges: DataFrame, src: str, dst: str) -> DataFrame:
    """Edges without a reverse, self loops included."""
    return _facing(edges, src, dst, "left_anti")


_WORD, _GAP = "[a-z0-9_]+", "[^a-z0-9_]+"
TERM_PIECES = f"{_WORD}|{_GAP}"


def text_runs(text: Column, k: int, word_first: bool) -> Column:
    """All runs of ``k`` pieces of a lower-case text, each word and each gap between words being a piece.

    A look-ahead finds runs that overlap, in one pass of the regular expression.
    """
    classes = [_WORD if (i % 2 == 0) == word_first else _GAP for i in range(k)]
    if k == 1:
        return F.regexp_extract_all(text, F.lit(classes[0]), F.lit(0))
    # a run begins where a piece does: what stands before is of the other class
    start = f"(?<!{classes[0][:-1]})"
    return F.regexp_extract_all(text, F.lit(f"{start}(?=({''.join(classes)}))"), F.lit(1))


def terms_used(corpus: DataFrame, text: str, dictionary: DataFrame, term: str) -> DataFrame:
    """Dictionary rows whose term occurs as a whole word somewhere in the corpus, ignoring case.

    A term of k pieces is looked for among the runs of k pieces of a text, all
    lengths in one scan. The terms are stored first, and the lengths in use are
    collected: a few numbers.
    """
    pieces = F.regexp_extract_all(F.lower(term), F.lit(TERM_PIECES), F.lit(0))
    words = dictionary.select(
        F.lower(term).alias("_t"), F.size(pieces).alias("_k"), F.lower(term).rlike(f"^{_WORD}").alias("_w")
    )
    words = store(words.distinct(), "terms")
    shapes = sorted((r[0], r[1]) for r in words.filter("_k > 0").select("_k", "_w").distinct().collect())
    if not shapes:
        return dictionary.limit(0)
    runs = [text_runs(F.lower(text), k, w) for k, w in shapes]
    # distinct inside a text first: fewer rows to look up, and to shuffle if the dictionary is large
    seen = corpus.select(F.explode(F.array_distinct(F.concat(*runs))).alias("_t"))
    found = seen.join(words.select("_t"), "_t", "left_semi").distinct()
    return dictionary.join(found, F.lower(dictionary[term]) == F.col("_t"), "left_semi")


def resolve_ids(df: DataFrame, id_col: str, dim: DataFrame, dim_id: str, dim_name: str, name: str, flag: str = "") -> DataFrame:
    """The name of the matching row in place of an id; an unmatched id stays.

    ``flag`` also brings a flag of the row, true when missing.
    """
    named = F.struct(F.col(dim_name).alias("_name"), *([F.col(flag).alias("_flag")] if flag else []))
    right = dim.groupBy(F.col(dim_id).alias("_id")).agg(F.count("*").alias("_n"), F.any_value(named).alias("_v"))
    right = right.select("_id", single("_n", "_v", "_found")).select("_id", "_found.*")
    joined = df.join(right, df[id_col] == right["_id"], "left")
    extra = [F.coalesce("_flag", F.lit(True)).alias(flag)] if flag else []
    return joined.select(*[df[c] for c in df.columns], F.coalesce("_name", df[id_col].cast("string")).alias(name), *extra)


def resolve_id_array(
    df: DataFrame, key: Sequence[str], ids: str, dim: DataFrame, dim_id: str, dim_name: str, dim_new_name: str = ""
) -> DataFrame:
    """The same for a list of ids in one row, order kept; a new name wins over the old one.

    ``key`` identifies a row, so a group is one list that already fits in a row.
    """
    items = df.select(*key, F.posexplode_outer(ids).alias("_pos", "_id"))
    label = F.coalesce(F.col(dim_new_name), F.col(dim_name)) if dim_new_name else F.col(dim_name)
    right = dim.groupBy(F.col(dim_id).alias("_rid")).agg(F.count("*").alias("_n"), F.any_value(label).alias("_v"))
    right = right.select("_rid", single("_n", "_v", "_name"))
    named = items.join(right, items["_id"] == right["_rid"], "left")
    entry = F.when(F.col("_pos").isNotNull(), F.struct("_pos", F.coalesce("_name", F.col("_id").cast("string")).alias("_n")))
    lists = named.groupBy(*key).agg(F.sort_array(F.collect_list(entry)).alias("_l"))
    return lists.select(*key, F.transform("_l", lambda x: x["_n"]).alias(ids))

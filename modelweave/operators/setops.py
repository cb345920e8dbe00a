"""U01..U06: putting tables together, taking them apart, and comparing two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelweave.plans.keys import by_name, lookup
from modelweave.plans.workspace import store


_FIXED = (T.IntegralType, T.FractionalType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def combine(frames: dict[str, DataFrame], tag: str = "origin") -> DataFrame:
    """All rows of all frames, duplicates kept, with the name of their frame."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def subtract_by_key(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``, compared part by part; NULL equals NULL."""
    return lookup(a, b, [(k, k) for k in keys], "left_anti", null_safe=True)


def _one_side(df: DataFrame, key: Sequence[str], columns: Sequence[str], side: str, carry: Sequence[str] = ()) -> DataFrame:
    # grouped before the join: copies of a key meet as one row, never pair by pair
    names = [f"_k{i}" for i in range(len(key))]
    flat = df.select(*[F.col(k).alias(n) for k, n in zip(key, names)], *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)], *carry)
    fixed = all(isinstance(flat.schema[f"_c{i}"].dataType, _FIXED) for i in range(len(columns)))
    if fixed:
        # values of a fixed width are aggregated in a hash table; the first row gives them all
        values = [F.any_value(f"_c{i}").alias(f"_c{i}") for i in range(len(columns))]
        whole = F.struct(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])
    else:
        values = [F.any_value(F.struct(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(columns)])).alias("_c")]
        whole = F.col("_c")
    one = flat.groupBy(*names).agg(F.count("*").alias("_n"), *values, *[F.any_value(c).alias(c) for c in carry])
    return one.select(*[F.col(n).alias(f"_{side}_{k}") for k, n in zip(key, names)], F.col("_n").alias(f"_n_{side}"), whole.alias(side), *carry)


def snapshot_diff(old: DataFrame, new: DataFrame, key: Sequence[str], carry: Sequence[str] = ()) -> DataFrame:
    """(key, change, old, new) of rows that are added, removed or modified.

    A key that comes more than once in a snapshot is reported as ``ambiguous``.
    ``carry`` names further columns of ``old`` that are not compared and stand beside.
    """
    columns = list(new.columns)
    a, b = _one_side(old, key, columns, "old", carry), _one_side(new, key, columns, "new")
    both = a.join(b, by_name([(f"_old_{k}", f"_new_{k}") for k in key], null_safe=True), "full_outer")
    change = (
        F.when((F.coalesce("_n_old", F.lit(0)) > 1) | (F.coalesce("_n_new", F.lit(0)) > 1), "ambiguous")
        .when(F.col("_n_old").isNull(), "added")
        .when(F.col("_n_new").isNull(), "removed")
        .when(~F.col("old").eqNullSafe(F.col("new")), "modified")
    )
    keys = [F.when(F.col("_n_new").isNull(), F.col(f"_old_{k}")).otherwise(F.col(f"_new_{k}")).alias(k) for k in key]
    return both.select(*keys, change.alias("change"), "old", "new", *carry).filter("change IS NOT NULL")


def _digests(df: DataFrame, place: Sequence[Column], columns: Sequence[str], side: str) -> DataFrame:
    """Per place the number of rows and order-free sums over hashes of whole rows, in 126 bits."""
    low = F.lit((1 << 31) - 1)
    rows = df.select(*[p.alias(f"_{side}{i}") for i, p in enumerate(place)], F.xxhash64(*columns).alias("_h"), F.xxhash64(F.lit(7), *columns).alias("_g"))
    sums = [F.count("*"), F.bit_xor("_h"), F.sum(F.col("_h").bitwiseAND(low)), F.sum(F.col("_g").bitwiseAND(low))]
    return rows.groupBy(*[f"_{side}{i}" for i in range(len(place))]).agg(F.struct(*[x.alias(f"s{i}") for i, x in enumerate(sums)]).alias(f"_{side}"))


def _differing(old: DataFrame, new: DataFrame, place: Sequence[Column], columns: Sequence[str]) -> DataFrame:
    """(p0, p1 ...): places whose digests are not the same on both sides."""
    a, b = _digests(old, place, columns, "a"), _digests(new, place, columns, "b")
    both = a.join(b, by_name([(f"_a{i}", f"_b{i}") for i in range(len(place))], null_safe=True), "full_outer")
    names = [F.coalesce(f"_a{i}", f"_b{i}").alias(f"p{i}") for i in range(len(place))]
    return both.filter(~F.col("_a").eqNullSafe(F.col("_b"))).select(*names)


def snapshot_diff_large(old: DataFrame, new: DataFrame, key: Sequence[str], buckets: int = 1 << 14, parts: int = 256) -> DataFrame:
    """U03 for large snapshots that are nearly equal: the rows of ``snapshot_diff``, for keys that come once.

    A key that comes more than once, alike on both sides, is no change here and
    may not be reported as ``ambiguous``. Digests of ``buckets`` by key are compared first, then those of ``parts`` of
    the buckets that differ; only rows of differing parts are shuffled whole.
    The rest of both snapshots costs two scans and a row of sums per task and
    bucket. Where most buckets differ the parts are not looked at.
    """
    columns = list(dict.fromkeys([*key, *new.columns]))
    old = old.select(*columns)
    wide = [F.pmod(F.xxhash64(*key), F.lit(buckets)), F.pmod(F.xxhash64(F.lit(3), *key), F.lit(parts))]
    first = store(_differing(old, new, wide[:1], columns), "buckets")
    if 2 * first.count() > buckets:
        return snapshot_diff(old.select(*new.columns), new, key)

    def inside(df: DataFrame, places: DataFrame, n: int) -> DataFrame:
        marked = df.select("*", *[p.alias(f"_w{i}") for i, p in enumerate(wide[:n])])
        return lookup(marked, places, [(f"_w{i}", f"p{i}") for i in range(n)], "left_semi", unique=True).select(*df.columns)

    near = inside(old, first, 1), inside(new, first, 1)
    second = store(_differing(*near, wide, columns), "parts")
    return snapshot_diff(inside(old, second, 2).select(*new.columns), inside(new, second, 2), key)


def snapshot_diff_two_keys(old: DataFrame, new: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """(matched_by, old, new): the same item when the id matches, else when the name does.

    Two equi joins, the second over what the first left. An id that comes more
    than once in a snapshot is ``ambiguous``, and so are the items that are left
    of a name that more than one old or new item has.
    """
    columns = list(new.columns)
    o = _one_side(old, [id_col], columns, "old").withColumn("_oname", F.col(f"old.{name_col}"))
    n = _one_side(new, [id_col], columns, "new").withColumn("_nname", F.col(f"new.{name_col}"))
    same_id = F.col(f"_old_{id_col}").eqNullSafe(F.col(f"_new_{id_col}"))
    twice = (F.coalesce("_n_old", F.lit(0)) > 1) | (F.coalesce("_n_new", F.lit(0)) > 1)
    sides = o.join(n, same_id, "full_outer")
    label = F.when(twice, "ambiguous").otherwise("id")
    by_id = sides.filter(twice | (F.col("_n_old").isNotNull() & F.col("_n_new").isNotNull()))
    by_id = by_id.select(label.alias("matched_by"), "old", "new")
    # what has no partner by id, normally little, is read four times below
    rest = store(sides.filter(~twice & (F.col("_n_old").isNull() | F.col("_n_new").isNull())), "unmatched")
    rest_o, rest_n = rest.filter("_n_new IS NULL"), rest.filter("_n_old IS NULL")
    old_names = rest_o.groupBy(F.col("_oname").alias("_o")).agg(F.count("*").alias("_no"))
    new_names = rest_n.groupBy(F.col("_nname").alias("_n")).agg(F.count("*").alias("_nn"))
    names = old_names.join(new_names, F.col("_o") == F.col("_n"))
    several = names.filter("_no > 1 or _nn > 1").select(F.col("_o").alias("_many"))
    pairs = names.filter("_no = 1 and _nn = 1").select(F.col("_o").alias("_one"))
    met = rest_o.join(pairs, F.col("_oname") == F.col("_one")).select("_one", "old")
    met = met.join(rest_n.select("_nname", "new"), F.col("_one") == F.col("_nname")).select(F.lit("name").alias("matched_by"), "old", "new")

    def alone(side: DataFrame, column: str, label: str) -> DataFrame:
        marked = side.join(names.select(F.col("_o").alias("_name")), F.col(column) == F.col("_name"), "left")
        marked = marked.join(several, F.col(column) == F.col("_many"), "left")
        state = F.when(F.col("_name").isNull(), label).when(F.col("_many").isNotNull(), "ambiguous")
        return marked.select(state.alias("matched_by"), "old", "new").filter("matched_by is not null")

    return by_id.unionByName(met).unionByName(alone(rest_n, "_nname", "added")).unionByName(alone(rest_o, "_oname", "removed"))


def changed_names(columns: Sequence[str]) -> Column:
    """Names of the columns that differ between ``old`` and ``new``."""
    return F.array_compact(
        F.array(*[F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in columns])
    )


def classify_change(diff: DataFrame, recreate: Sequence[str], rename: Sequence[str], rebuild: Sequence[str]) -> DataFrame:
    """Adds ``changed`` and ``action``: recreate when such a column changed, else rename and/or rebuild."""
    out = diff.withColumn("changed", changed_names([*recreate, *rename, *rebuild]))

    def touched(names: Sequence[str]) -> Column:
        return F.arrays_overlap("changed", F.array(*[F.lit(n) for n in names]))

    softer = F.concat_ws("+", F.when(touched(rename), "rename"), F.when(touched(rebuild), "rebuild"))
    return out.withColumn(
        "action", F.when(touched(recreate), "recreate").when(softer != "", softer).otherwise("none")
    )


def changed_columns(diff: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Adds ``changes``, an array of (name, old, new) as text, of the attributes that differ."""
    entries = F.array(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.col(f"old.{c}").cast("string").alias("old_value"),
                F.col(f"new.{c}").cast("string").alias("new_value"),
            )
            for c in columns
        ]
    )
    changed = changed_names(columns)
    return diff.withColumn("changes", F.filter(entries, lambda e: F.array_contains(changed, e["name"])))

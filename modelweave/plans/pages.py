"""Lists per group that stay whole when one group holds a third of all rows.

A list must fit in one row, so a group above ``page_rows`` entries goes on in
further rows: page 0, 1, 2 ... of the same key, in order, nothing dropped.
Groups below the limit, normally all, take the plain one-shuffle path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.plans.keys import by_name, lookup
from modelweave.plans.positions import running_total
from modelweave.plans.workspace import store

PAGE_ROWS = 100_000


def _lists(rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    # a list is no smaller on the map side: shuffle the rows, then collect once
    rows = rows.repartition(*[F.col(f"`{k}`") for k in keys])
    items = F.transform(F.sort_array(F.collect_list("_x")), lambda x: x["_i"])
    return rows.groupBy(*keys).agg(items.alias(name), F.sum("_w").alias("_weight"))


def collect_groups(
    df: DataFrame,
    keys: Sequence[str],
    item: Column,
    order: Sequence[str] = (),
    name: str = "items",
    weight: Column | None = None,
    page_rows: int = PAGE_ROWS,
) -> tuple[DataFrame, bool]:
    """One ordered list per key: (keys, ``name``, _weight, _page, _pages), and whether any key has more pages.

    Runs one counting job over the key columns to find groups above
    ``page_rows``. ``weight`` is the number of entries a row stands for.
    """
    keys = list(keys)
    rows = df.select(
        *[F.col(f"`{k}`") for k in keys],
        F.struct(*[F.col(f"`{c}`").alias(f"_o{i}") for i, c in enumerate(order)], item.alias("_i")).alias("_x"),
        (F.lit(1) if weight is None else weight).cast("long").alias("_w"),
    )
    big = rows.groupBy(*keys).agg(F.sum("_w").alias("_n")).filter(F.col("_n") > page_rows).drop("_n")
    found = big.agg(F.count("*")).first()[0]
    if found == 0:
        one = _lists(rows, keys, name)
        return one.withColumns({"_page": F.lit(0).cast("long"), "_pages": F.lit(1).cast("long")}), False

    big = store(big, "big_keys")
    pairs = [(k, k) for k in keys]
    small = _lists(lookup(rows, big, pairs, "left_anti", null_safe=True, unique=True), keys, name)
    small = small.withColumns({"_page": F.lit(0).cast("long"), "_pages": F.lit(1).cast("long")})

    hot = lookup(rows, big, pairs, "left_semi", null_safe=True, unique=True)
    # range keys are sampled to the driver: the declared order and a hash, not the entries
    place = [*[F.col(f"_x._o{i}") for i in range(len(order))], F.xxhash64("_x")] if order else ["_x"]
    hot = running_total(hot, [*keys, *place], "_w", "_pos")
    paged = _beside(hot, keys, F.min("_pos").alias("_first")).withColumn(
        "_page", F.floor((F.col("_pos") - F.col("_first")) / F.lit(page_rows))
    )
    paged = _lists(paged, [*keys, "_page"], name)
    # a number may stay unused where one entry outweighs a page
    paged = _beside(paged, keys, (F.max("_page") + 1).alias("_pages"))
    paged = paged.select(*[F.col(f"`{k}`") for k in keys], name, "_weight", "_page", "_pages")
    return small.unionByName(paged), True


def _beside(df: DataFrame, keys: Sequence[str], total: Column) -> DataFrame:
    """Every row with an aggregate of its key: a partial aggregate and a join, no window over the group.

    Spark broadcasts the totals if it measures them as small, and splits a hot key otherwise.
    """
    named = [F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]
    totals = df.groupBy(*named).agg(total)
    met = df.join(totals, by_name([(k, f"_k{i}") for i, k in enumerate(keys)], null_safe=True))
    return met.drop(*[f"_k{i}" for i in range(len(keys))])


def with_pages(df: DataFrame) -> DataFrame:
    """Every row starts as page 0 of 1."""
    if "_page" in df.columns:
        return df
    return df.withColumns({"_page": F.lit(0).cast("long"), "_pages": F.lit(1).cast("long")})


def attach(
    parent: DataFrame,
    grouped: DataFrame,
    pairs: Sequence[tuple[str, str]],
    name: str,
    empty: Column,
    paged: bool,
    reset: dict[str, Column] | None = None,
) -> DataFrame:
    """Left join of a grouped column to its parents, page by page.

    ``parent`` carries ``_page`` and ``_pages`` (see ``with_pages``). ``reset``
    gives, for columns attached before, the value they have on added pages.
    """
    right = grouped.select(
        *[F.col(f"`{b}`").alias(f"_k{i}") for i, (_, b) in enumerate(pairs)],
        F.col(f"`{name}`").alias("_value"),
        F.col("_weight").alias("_add"),
        F.col("_page").alias("_rp"),
        F.col("_pages").alias("_rps"),
    )
    renamed = [(a, f"_k{i}") for i, (a, _) in enumerate(pairs)]
    keep = [f"`{c}`" for c in parent.columns if c not in ("_page", "_pages", "_weight", name)]
    has_weight = "_weight" in parent.columns
    hit = by_name(renamed)

    def shaped(joined: DataFrame, page: Column, pages: Column, override: dict[str, Column]) -> DataFrame:
        cols = [override[c].alias(c) if c in override else F.col(f"`{c}`") for c in map(lambda q: q.strip("`"), keep)]
        weight = [(F.col("_weight") + F.coalesce("_add", F.lit(0))).alias("_weight")] if has_weight else []
        return joined.select(
            *cols, F.coalesce("_value", empty).alias(name), *weight, page.alias("_page"), pages.alias("_pages")
        )

    if not paged:
        return shaped(parent.join(right, hit, "left"), F.col("_page"), F.col("_pages"), {})
    pages = F.greatest("_pages", F.coalesce("_rps", F.lit(1)))
    same = parent.join(right, hit & (F.col("_page") == F.col("_rp")), "left")
    more = parent.filter("_page = 0").join(right, hit & (F.col("_rp") >= F.col("_pages")))
    return shaped(same, F.col("_page"), pages, {}).unionByName(shaped(more, F.col("_rp"), pages, reset or {}))

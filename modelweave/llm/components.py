"""Connected components by joins: smallest labels spread over the links, then labels of labels shorten the way."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelweave.plans.workspace import store


def smallest_reachable(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of ``links``: comp is the smallest node reachable, itself included.

    Each round takes the smallest label among a node's neighbours (a partial
    aggregate, so that a node with very many links is no hot spot) and follows
    labels of labels; they are written, so a lost executor costs no more than
    its round. Rows with a null end are not links; no links give no rows.
    """
    links = links.filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    both = links.select(F.col(a).alias("node"), F.col(b).alias("other")).union(links.select(F.col(b), F.col(a)))
    labels = store(both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("other"), F.col("comp").alias("_c")), "other")
        near = near.groupBy("node").agg(F.min("_c").alias("_near"))
        best = store(labels.join(near, "node").select("node", "comp", F.least("comp", "_near").alias("_new")), "labels")
        if not best.filter("_new != comp").limit(1).count():
            return labels
        jump = best.select(F.col("node").alias("_new"), F.col("_new").alias("_far"))
        labels = store(best.join(jump, "_new", "left").select("node", F.coalesce("_far", "_new").alias("comp")), "labels")

"""Sharding by balanced label propagation.

Linked documents look at the shards of their neighbours and move to the one
that holds most of them, as far as the quotas allow: moves between two shards
are matched against each other, and a shard takes more while it has room.
Documents without links fill every shard up to its quota at the end, so the
counts are exact. Links are memberships in hubs (documents with one hub are
neighbours of each other), so a hub with a third of all documents costs one
count per shard and never its pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelweave.plans.positions import dense_index
from modelweave.plans.workspace import store

SHARDS = 8
ROUNDS = 6


def quotas(total: int, shards: int) -> list[int]:
    """Documents of each shard: at most one apart."""
    return [total // shards + (s < total % shards) for s in range(shards)]


def _allowed(demand: dict[tuple[int, int], int], held: list[int], quota: list[int]) -> dict[tuple[int, int], int]:
    """How many moves from shard i to shard j may be made at once."""
    out = {(i, j): min(n, demand.get((j, i), 0)) for (i, j), n in demand.items()}
    room = [max(q - h, 0) for q, h in zip(quota, held)]
    for (i, j), n in sorted(demand.items(), key=lambda x: (-x[1], x[0])):
        more = min(n - out[i, j], room[j])
        out[i, j] += more
        room[j] -= more
    return out


def _case(column: Column, values: dict, otherwise: int = 0) -> Column:
    out = F.lit(otherwise)
    for key, value in values.items():
        out = F.when(column == key, F.lit(value)).otherwise(out)
    return out


def propagate(members: DataFrame, total: int, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(node, shard) for the nodes of ``members`` (node, hub), no shard above its quota of ``total``.

    node is a whole number, hub any value; a node may be in many hubs. Stops
    when no move is left or after ``rounds`` rounds.
    """
    quota = quotas(total, shards)
    nodes = dense_index(members.select("node").distinct(), ["node"], "_i", unique=True)
    state = store(nodes.select("node", (F.col("_i") % shards).cast("int").alias("shard")), "shards")
    for turn in range(rounds):
        held = {r["shard"]: r["count"] for r in state.groupBy("shard").count().collect()}
        counts = [held.get(s, 0) for s in range(shards)]
        seen = members.join(state, "node").groupBy("hub", "shard").agg(F.count("*").alias("n"))
        votes = members.join(seen.withColumnRenamed("shard", "to"), "hub").groupBy("node", "to").agg(F.sum("n").alias("n"))
        votes = votes.join(state, "node")
        room = [s for s in range(shards) if counts[s] < quota[s]]
        # ties go the same way for all members of a hub in one round
        rank = F.struct(F.col("n"), F.xxhash64("to", F.lit(turn)).alias("t"), F.col("to"))
        best = votes.groupBy("node", "shard").agg(
            F.max(rank).alias("_any"),
            F.max(F.when(F.col("to").isin(room), rank)).alias("_roomy"),
            F.max(F.when(F.col("to") == F.col("shard"), F.col("n"))).alias("_own"),
        )
        # the wish is the best shard; where it is full, the best one with room
        want = F.when(F.col("_any.to").isin(room) | (F.col("_any.to") == F.col("shard")), F.col("_any")).otherwise(F.coalesce("_roomy", "_any"))
        movers = best.select("node", "shard", want["to"].alias("to"), (want["n"] - F.col("_own")).alias("gain")).filter("to != shard and gain >= 0")
        movers = movers.filter((F.col("gain") > 0) | (F.xxhash64("to", F.lit(turn)) > F.xxhash64("shard", F.lit(turn))))
        movers = store(movers, "movers")
        demand = {(r["shard"], r["to"]): r["count"] for r in movers.groupBy("shard", "to").count().collect()}
        allowed = _allowed(demand, counts, quota)
        if not any(allowed.values()):
            break
        first, before = {}, 0
        for pair in sorted(demand):
            first[pair] = before
            before += demand[pair]
        way = F.col("shard") * shards + F.col("to")
        ordered = dense_index(movers.select("node", "shard", "to", (-F.col("gain")).alias("loss")), ["shard", "to", "loss", "node"], "_i", unique=True)
        code = lambda d: {i * shards + j: n for (i, j), n in d.items()}
        gone = ordered.filter(F.col("_i") - _case(way, code(first)) < _case(way, code(allowed)))
        after = state.join(gone.select("node", "to"), "node", "left").select("node", F.coalesce("to", "shard").alias("shard"))
        state = store(after, "shards")
    return state


def cut_links(members: DataFrame, placed: DataFrame) -> DataFrame:
    """One row: links (pairs within a hub, counted, not made) and how many are cut."""
    seen = members.join(placed, "node").groupBy("hub", "shard").agg(F.count("*").alias("n"))
    per_hub = seen.groupBy("hub").agg(F.sum("n").alias("_n"), F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("_in"))
    return per_hub.agg(F.sum(F.col("_n") * (F.col("_n") - 1) / 2).cast("long").alias("links"), F.sum(F.col("_n") * (F.col("_n") - 1) / 2 - F.col("_in")).cast("long").alias("cut"))


def shard_documents(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents with equal texts are linked. The law is ``rows``: counts at most
    one apart. A null text has size 1 and the checksum of no bytes, and is
    linked with nothing. Repeated rows are rows of their own. No documents give
    no rows.
    """
    body = F.col(f"`{text}`")
    rows = docs.select(
        F.col(f"`{doc_id}`").alias("doc_id"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("text_crc32"), F.xxhash64(body).alias("_h"), body.isNull().alias("_null"),
    )
    rows = store(dense_index(rows, ["doc_id", "_h"], "node"), "documents")
    total = rows.count()
    hub = F.struct("_h", "size", "text_crc32")
    shared = rows.filter("not _null").groupBy("_h", "size", "text_crc32").count().filter("count > 1").drop("count")
    members = store(rows.join(shared, ["_h", "size", "text_crc32"], "left_semi").select("node", hub.alias("hub")), "members")
    placed = propagate(members, total, shards)

    held = {r["shard"]: r["count"] for r in placed.groupBy("shard").count().collect()}
    free = [q - held.get(s, 0) for s, q in enumerate(quotas(total, shards))]
    loose = rows.join(placed, "node", "left_anti").select("node")
    loose = dense_index(loose, ["node"], "_i", unique=True)
    into, below = F.lit(shards - 1), 0
    for s in range(shards - 2, -1, -1):
        below = sum(free[: s + 1])
        into = F.when(F.col("_i") < below, F.lit(s)).otherwise(into)
    every = placed.select("node", "shard").union(loose.select("node", into.cast("int").alias("shard")))
    numbered = dense_index(rows.drop("_h", "_null").join(every, "node"), ["shard", "node"], "_i", unique=True)
    start, starts = 0, {}
    for s, q in enumerate(quotas(total, shards)):
        starts[s] = start
        start += q
    slot = (F.col("_i") - _case(F.col("shard"), starts)).cast("long")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", slot.alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )

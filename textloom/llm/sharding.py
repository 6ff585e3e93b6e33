"""Balanced label propagation: linked documents gather in shards whose sizes stay even."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import meet
from textloom.operators.ranking import buckets_for, ranked
from textloom.session import Workspace

SHARDS = 40
ROUNDS, IDLE = 20, 3


def keyed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """row_key, doc_id, size, text_crc32 and hub (the text's SHA-256) of each document."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(
        F.monotonically_increasing_id().alias("row_key"),
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.unhex(F.sha2(text, 256)).alias("hub"),
    )


def capacities(rows: int, shards: int) -> list[int]:
    """Row counts that sum to rows and are at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _pick(values: list[int], at: str | Column) -> Column:
    return F.element_at(F.array(*(F.lit(v).cast("long") for v in values)), (F.col(at) if isinstance(at, str) else at).cast("int") + 1)


def _spread(hub: str, row: str, hub_rows: str, n: int, each: int = 20_000) -> Column:
    """A bucket that keeps a hub's rows together, unless it has too many: those are salted by row. Buckets of larger hubs come first."""
    salt = F.pmod(F.xxhash64(row), F.greatest(F.lit(1), F.ceil(F.col(hub_rows) / each)))
    small = 40 - F.least(F.floor(F.log2(hub_rows)), F.lit(40))
    return (small * n + F.pmod(F.xxhash64(hub) + salt, F.lit(n))).cast("int")


def _salted(rows: DataFrame, table: DataFrame, each: int = 20_000) -> DataFrame:
    """rows (hub, hub_rows, row_key) joined to one row a hub (hub, hub_rows and more), a large hub's rows over several tasks."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("hub_rows") / each)).cast("int")
    salted = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts - 1))).drop("hub_rows")
    return rows.withColumn("_salt", F.pmod(F.xxhash64("row_key"), parts).cast("int")).join(salted, ["hub", "_salt"]).drop("_salt")


def propagate(linked: DataFrame, capacity: list[int], rounds: int = ROUNDS) -> DataFrame:
    """Shard of each linked row (row_key, hub, hub_rows): rows of a hub are linked to each other.

    All rows start dealt by hash within the quotas. In each round a hub's rows vote for the
    shard that has most of them (counted by a partial aggregation, so a hub of any size is
    one row a shard) and the others want to move there. Those who want to move are lifted;
    a shard takes as many as its quota leaves beside its stayers, movers being numbered
    without gaps in buckets, large hubs first and hub by hub, so that a quota cuts few hubs;
    those who find no place are dealt row by row to the room that is left, so that their
    hubs' votes can turn to other shards. So quotas hold after every round, and full shards
    can still exchange rows. Stops when nobody wants to move, or when IDLE rounds have not
    left fewer who want to; at `rounds` in any case. Only counts by shard reach the driver.
    """
    work = Workspace(linked.sparkSession, "propagate")
    shards, total = len(capacity), linked.count()
    n = buckets_for(total)
    start = _numbered(linked, n)
    now = work.keep(start.select("row_key", "hub", "hub_rows", _dealt("_rank", capacity, total).alias("shard")), "labels")
    fewest, idle = total + 1, 0
    for _ in range(rounds):
        votes = now.groupBy("hub", "shard").agg(F.count("*").alias("n"), F.max("hub_rows").alias("hub_rows"))
        best = votes.groupBy("hub").agg(F.max_by("shard", F.struct("n", F.xxhash64("hub", "shard"))).alias("target"), F.max("hub_rows").alias("hub_rows"))
        wishes = work.keep(_salted(now, best).withColumn("_bucket", _spread("hub", "row_key", "hub_rows", n)), "wishes")
        stay, come = [0] * shards, [0] * shards
        for r in wishes.groupBy("target", (F.col("shard") == F.col("target")).alias("stays")).count().collect():
            (stay if r.stays else come)[r.target] = r["count"]
        idle = 0 if sum(come) < fewest else idle + 1
        if not any(come) or idle == IDLE:
            break
        fewest = min(fewest, sum(come))
        room = [c - s for c, s in zip(capacity, stay)]
        taken = [min(r, c) for r, c in zip(room, come)]
        movers = work.keep(ranked(wishes.where("shard <> target"), ["target"], "_bucket", ["hub", "row_key"], "_rank"), "movers")
        fits = F.col("_rank") < _pick(room, "target")
        columns = ["row_key", "hub", "hub_rows"]
        settled = wishes.where("shard = target").select(*columns, "shard")
        moved = movers.where(fits).select(*columns, F.col("target").alias("shard"))
        rest, over = [r - t for r, t in zip(room, taken)], sum(come) - sum(taken)
        after = settled.unionByName(moved)
        if over:
            lifted = _numbered(movers.where(~fits).drop("_rank", "_bucket"), n)
            after = after.unionByName(lifted.select(*columns, _dealt("_rank", rest, over).alias("shard")))
        now = work.keep(after, "labels")
    return now


def _numbered(rows: DataFrame, n: int) -> DataFrame:
    """Gapless numbers for all rows in the order of their keys' hashes."""
    spread = rows.withColumn("_bucket", F.pmod(F.xxhash64("row_key"), F.lit(n)).cast("int")).withColumn("_all", F.lit(0))
    return ranked(spread, ["_all"], "_bucket", ["row_key"], "_rank").drop("_all")


def _held(labels: DataFrame, shards: int) -> list[int]:
    found = {r[0]: r[1] for r in labels.groupBy("shard").count().collect()}
    return [found.get(s, 0) for s in range(shards)]


def _dealt(rank: str, room: list[int], total: int) -> Column:
    """Shard for a rank among total rows, in proportion to the shards' room and never beyond it."""
    ends, at = [], 0
    whole = sum(room)
    for r in room:
        at += r
        ends.append(at * total // whole if whole else 0)
    out = F.lit(0)
    for e in ends[:-1]:
        out = out + (F.col(rank) >= e).cast("int")
    return out


def shard(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text", keyed: DataFrame | None = None) -> DataFrame:
    """Every row with its shard and slot: row_key, doc_id, size, text_crc32, law, shard, slot.

    Law `rows`: shard sizes are at most one row apart, exactly. Documents with equal texts
    are linked; propagate() gathers them, the others (free to go anywhere) then fill every
    shard to its quota. A group larger than a shard is spread over as few as the quotas
    allow. Slots number a shard's rows from 0 without gaps. Null texts count as empty for
    links and crc, with size 16; null and equal ids and repeated rows are rows like others; an
    empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "sharding")
    rows = keyed if keyed is not None else work.keep(keyed_documents(docs, id_col, text_col), "rows")
    hubs = rows.groupBy("hub").agg(F.count("*").alias("hub_rows"))
    total = rows.count()
    capacity = capacities(total, shards)
    parts = F.ceil(F.col("hub_rows") / max(1.0, 0.9 * min(capacity)))  # a group beyond a shard's size is several
    part = F.pmod(F.xxhash64("row_key", F.lit(2)), parts).cast("int")
    known = meet(rows.select("row_key", "hub"), work.keep(hubs, "sizes"), "hub", "hub_rows", total).withColumn("hub", F.when(parts > 1, F.xxhash64("hub", part)).otherwise(F.xxhash64("hub")))
    known = work.keep(known, "hubs")
    labels = propagate(known.where("hub_rows > 1"), capacity, rounds)
    room = [c - h for c, h in zip(capacity, _held(labels, shards))]
    n = buckets_for(total)
    filled = _numbered(known.where("hub_rows = 1"), n).select("row_key", _dealt("_rank", room, sum(room)).alias("shard"))
    placed = work.keep(labels.select("row_key", "shard").unionByName(filled), "placed")
    m = buckets_for(max(1, total // shards))
    slots = ranked(placed.withColumn("_bucket", F.pmod(F.xxhash64("row_key"), F.lit(m)).cast("int")), ["shard"], "_bucket", ["row_key"], "slot")
    return rows.join(slots.select("row_key", "shard", "slot"), "row_key").select("row_key", "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot")


def cut_links(sharded: DataFrame, hub: str = "text_crc32") -> DataFrame:
    """How many rows of a hub lie outside the shard that holds most of it, in all."""
    by = sharded.groupBy(hub, "shard").agg(F.count("*").alias("n"))
    return by.groupBy(hub).agg((F.sum("n") - F.max("n")).alias("n")).agg(F.sum("n").alias("cut"))


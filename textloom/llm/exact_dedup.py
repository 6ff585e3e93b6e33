"""Exact dedup against a minimal perfect hash index over the digests seen before."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import key_column, keyed, meet
from textloom.session import Workspace

#: Digests in one shard of the index, about; a shard is built and probed in one task's memory.
SHARD_DIGESTS = 50_000
_HASHED = "row_key long, doc_id long, digest binary, old boolean"
_INDEX = "shard int, n int, levels array<binary>, slots binary, keeps array<struct<doc_id:long,row_key:long>>, counts array<long>"


def digests(docs: DataFrame, old: str = "false", id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """A row key, the id, the SHA-256 of the text with A-Z lower-cased (null: empty), and whether the row is old.

    old is an SQL condition on docs that says which rows are history. Texts stay where
    they are; only digests go on.
    """

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, batch in keyed(batches):
            texts = batch.column(2).cast(pa.large_binary()).to_pylist()
            found = [hashlib.sha256((t or b"").lower()).digest() for t in texts]
            yield pa.RecordBatch.from_arrays([keys, batch.column(1), pa.array(found, pa.binary()), batch.column(3)], names=["row_key", "doc_id", "digest", "old"])

    is_old = F.coalesce(F.expr(old).cast("boolean"), F.lit(False))
    picked = docs.select(key_column(row_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"), is_old)
    return picked.mapInArrow(hashed, _HASHED)


def _word(digest: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each (n, 32) digest for one level of the perfect hash."""
    words = np.ascontiguousarray(digest).view("<u8")
    x = words[:, 1] ^ (words[:, 2] + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


class PerfectHash:
    """Minimal perfect hash by levels of bits.

    At each level the keys not placed yet hash to twice as many bits; a key alone on its
    bit is placed there. A key's slot is the number of set bits before its own over all
    levels, so n keys fill slots 0 to n - 1. About 4 to 5 bits a key; keys that are not
    members get some slot or none, and the slot's full digest tells them apart.
    """

    def __init__(self, levels: list[bytes]):
        self.bits = [np.frombuffer(x, np.uint8) for x in levels]
        base = 0
        self.before = []
        for bits in self.bits:
            ones = np.bitwise_count(bits).astype(np.int64)
            self.before.append(base + np.cumsum(ones) - ones)
            base += int(ones.sum())

    @classmethod
    def build(cls, keys: np.ndarray) -> "PerfectHash":
        """keys: (n, 32) distinct digests."""
        levels: list[bytes] = []
        while len(keys):
            size = -(-max(64, 2 * len(keys)) // 8) * 8
            at = (_word(keys, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(np.packbits(alone, bitorder="little").tobytes())
            keys = keys[~alone[at]]
            if len(levels) > 400:
                raise ValueError("digests repeat")
        return cls(levels)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that no level holds."""
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, (bits, before) in enumerate(zip(self.bits, self.before)):
            if not len(left):
                break
            at = (_word(keys[left], level) % np.uint64(len(bits) * 8)).astype(np.int64)
            byte, bit = at >> 3, (at & 7).astype(np.uint8)
            hit = (bits[byte] >> bit) & 1 == 1
            below = np.bitwise_count(bits[byte] & ((np.uint16(1) << bit.astype(np.uint16)) - np.uint16(1)).astype(np.uint8))
            out[left[hit]] = (before[byte] + below)[hit]
            left = left[~hit]
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def build_index(grouped: DataFrame, shards: int) -> DataFrame:
    """Index of distinct digests (digest, keep, n): one row a shard, with its perfect hash and slots.

    A slot holds the full digest, the winner's locator (doc_id and row key) and the number
    of copies. Digests are spread over shards by their first bytes, so shards are even.
    """

    def built(table: pa.Table) -> pa.Table:
        keys = _matrix(table.column("digest"))
        found = PerfectHash.build(keys)
        order = np.argsort(found.slots(keys))
        keep = table.column("keep").combine_chunks().take(pa.array(order))
        rows = [
            [table.column("shard")[0].as_py()], [len(keys)], [[x.tobytes() for x in found.bits]],
            [keys[order].tobytes()], [keep.to_pylist()], [table.column("n").take(pa.array(order)).to_pylist()],
        ]
        return pa.table([pa.array(x, f.type) for x, f in zip(rows, _INDEX_ARROW)], schema=_INDEX_ARROW)

    return grouped.withColumn("shard", _shard(shards)).groupBy("shard").applyInArrow(built, _INDEX)


_LOCATOR = pa.struct([("doc_id", pa.int64()), ("row_key", pa.int64())])
_INDEX_ARROW = pa.schema(
    [("shard", pa.int32()), ("n", pa.int32()), ("levels", pa.list_(pa.binary())), ("slots", pa.binary()), ("keeps", pa.list_(_LOCATOR)), ("counts", pa.list_(pa.int64()))]
)


def _shard(shards: int):
    return F.pmod(F.conv(F.hex(F.substring("digest", 1, 6)), 16, 10).cast("long"), F.lit(shards)).cast("int")


def look_up(grouped: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Each grouped digest (digest, keep, n) with `old_keep` and `old_n` of the index slot that holds it, else null.

    A slot counts only if its full digest equals the probe byte by byte.
    """
    out = "digest binary, keep struct<doc_id:long,row_key:long>, n long, old_keep struct<doc_id:long,row_key:long>, old_n long"

    def probed(left: pa.Table, right: pa.Table) -> pa.Table:
        n = left.num_rows
        old_keep, old_n = pa.nulls(n, _LOCATOR), pa.nulls(n, pa.int64())
        if n and right.num_rows:
            row = right.to_pylist()[0]
            keys = _matrix(left.column("digest"))
            slot = PerfectHash(row["levels"]).slots(keys)
            held = np.frombuffer(row["slots"], np.uint8).reshape(-1, 32)
            member = (slot >= 0) & (held[slot] == keys).all(axis=1)
            at = pa.array(np.where(member, slot, 0), mask=~member)
            old_keep, old_n = pa.array(row["keeps"], _LOCATOR).take(at), pa.array(row["counts"], pa.int64()).take(at)
        columns = [left.column("digest"), left.column("keep"), left.column("n"), old_keep, old_n]
        return pa.table(columns, names=["digest", "keep", "n", "old_keep", "old_n"])

    left = grouped.withColumn("shard", _shard(shards)).groupBy("shard")
    return left.cogroup(index.groupBy("shard")).applyInArrow(probed, out)


def groups(hashed: DataFrame) -> DataFrame:
    """Digest, keep (locator of the row that stays) and group_size for written digests().

    Rows are first counted by digest where they lie, so a group of copies crosses the
    shuffle as one row a task. The history's distinct digests make the index; the digests
    of new rows are looked up in it; members merge with their slot, nonmembers make groups
    of their own, and history that no new row meets stays as it is.
    """
    work = Workspace(hashed.sparkSession, "dedup")
    locator = F.struct("doc_id", "row_key")
    counted = work.keep(hashed.groupBy("old", "digest").agg(F.max(locator).alias("keep"), F.count("*").alias("n")), "digests")
    history, new = counted.where("old").drop("old"), counted.where("not old").drop("old")
    shards = max(1, -(-history.count() // SHARD_DIGESTS))
    index = work.keep(build_index(history, shards), "index")
    found = work.keep(look_up(new, index, shards), "found")
    members, others = found.where("old_n is not null"), found.where("old_n is null")
    merged = members.select("digest", F.greatest("keep", "old_keep").alias("keep"), (F.col("n") + F.col("old_n")).alias("n"))
    alone = others.groupBy("digest").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))
    rest = history.join(members.select("digest"), "digest", "left_anti").select("digest", "keep", "n")
    return merged.unionByName(alone).unionByName(rest).withColumnRenamed("n", "group_size")


def exact_dedup(docs: DataFrame, old: str = "false", id_col: str = "doc_id", text_col: str = "text", hashed: DataFrame | None = None) -> DataFrame:
    """One row a document: row_key, doc_id, keep_id, group_size, kept, digest.

    Texts are equal when identical after lower-casing A-Z; null is the empty text. Of equal
    texts the row with the largest id stays (rows with a null id lose to all others); of
    rows with the same text and id exactly one stays. old marks the rows that form the
    historical index; it never changes the result. Other columns are not read; an empty
    table gives no rows.
    """
    if hashed is None:
        hashed = Workspace(docs.sparkSession, "dedup").keep(digests(docs, old, id_col, text_col), "hashed")
    found = Workspace(docs.sparkSession, "dedup").keep(groups(hashed), "groups")
    joined = meet(hashed, found, "digest", "group_size", hashed.count())
    return joined.select(
        "row_key", "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("keep.row_key") == F.col("row_key")).alias("kept"), "digest"
    )

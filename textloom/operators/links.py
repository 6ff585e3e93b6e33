"""Verified links of rows that lists bring together, without pairing all rows of a list.

Each row of a list is first compared with the list's most central row, which ties a group
of copies together by as many pairs as it has rows; only rows that components still keep
apart are then looked at pair by pair, where they lie, and only pairs that sizes and parity
maps allow leave the list to be verified.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.components import connected_components
from textloom.session import Workspace

#: Rounds in which lists are tied to a central row before their remaining pairs are looked at.
ROUNDS = 2
#: Rows of a list that are looked at together; longer lists are cut into chunks, each pair of which is looked at.
CHUNK = 1024


def parity_map(elements: np.ndarray) -> bytes:
    """For each of some classes of 64-bit hashes whether a set has an odd number of them: about two bits an element, a power of two.

    Each element that only one of two sets has flips one bit, so maps never differ in more
    bits than there are such elements. Halving a map by exclusive or gives the smaller one.
    """
    bits = 1 << max(6, (2 * len(elements)).bit_length())
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((counts & 1).astype(np.uint8)).tobytes()


def central_pairs(lists: DataFrame, turn: int, shared: int, of: int) -> DataFrame:
    """Distinct pairs a < b of each list's most central row with its rows of other components that may be alike by sizes and parity maps.

    lists: list, row_key, size, own, component, map. The row with the smallest share of
    elements of its own is central in the first turn; in later ones any row may be, by a hash.
    """
    order = F.col("own") / F.greatest("size", F.lit(1)) if turn == 0 else F.xxhash64(F.lit(turn), "list", "row_key").cast("double")
    centre = lists.groupBy("list").agg(F.min_by(F.struct("row_key", "size", "own", "component", "map"), F.struct(order, "row_key")).alias("c"))
    met = lists.join(centre, "list").where("c.component <> component")
    most = F.floor((F.col("c.size") + F.col("size")) * (of - shared) / (of + shared)) - F.col("c.own") - F.col("own")
    met = met.select(F.least("c.row_key", "row_key").alias("a"), F.greatest("c.row_key", "row_key").alias("b"), most.cast("long").alias("most"), F.col("c.map").alias("x"), F.col("map").alias("y"), F.abs(F.col("c.size") - F.col("c.own") - F.col("size") + F.col("own")).alias("least"))
    met = met.where("least <= most")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [x is None or y is None or _differ(x, y) <= most for most, x, y in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4)))]
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return met.select("a", "b", "most", "x", "y").mapInArrow(near, "a long, b long").distinct()


def _differ(x: bytes, y: bytes) -> int:
    """In how many bits two parity maps differ, the larger halved to the smaller."""
    width = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(np.frombuffer(m, np.uint8).reshape(-1, width), axis=0) for m in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def remaining_pairs(lists: DataFrame, shared: int, of: int) -> DataFrame:
    """Distinct pairs a < b of rows of one list whose components differ and which may be alike by sizes and parity maps.

    Rows are gathered CHUNK at a time at most: of a longer list every two chunks meet.
    """
    sizes = lists.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("_m"))
    rows = lists.join(sizes, "list").withColumn("_k", F.pmod(F.xxhash64("row_key"), F.col("_m")).cast("int"))
    rows = rows.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_m") - 1)))
    rows = rows.groupBy("list", F.least("_k", "_j").alias("i"), F.greatest("_k", "_j").alias("j")).agg(F.collect_list(F.struct("row_key", "size", "own", "component", "map", F.col("_k").alias("chunk"))).alias("rows"))

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.zeros((2, 0), np.int64)]
            for first, second, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                flat = rows.values
                key, size, own, component, chunk = (flat.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("row_key", "size", "own", "component", "chunk"))
                found.append(_possible(key, size, own, component, flat.field("map"), chunk if first != second else None, shared, of))
            a, b = np.concatenate(found, axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    return rows.where(F.size("rows") > 1).select("i", "j", "rows").mapInArrow(paired, "a long, b long").distinct()


def _possible(key: np.ndarray, size: np.ndarray, own: np.ndarray, component: np.ndarray, maps: pa.Array, chunk: np.ndarray | None, shared: int, of: int) -> np.ndarray:
    """The pairs of keys that may be alike: alike sets differ in at most (of - shared) / (of + shared) of both sizes.

    Elements of their own count as differences, and so do the bits in which maps differ.
    """
    i, j = np.nonzero(np.triu(component[:, None] != component[None, :], 1) if chunk is None else (component[:, None] != component[None, :]) & (chunk[:, None] < chunk[None, :]))
    most = (of - shared) * (size[i] + size[j]) // (of + shared)
    least = own[i] + own[j] + np.abs((size[i] - own[i]) - (size[j] - own[j]))
    keep = least <= most
    i, j, most = i[keep], j[keep], most[keep]
    if len(i) and not maps.null_count:
        data = [np.frombuffer(m.as_buffer(), np.uint8) for m in maps]
        width = np.array([len(m) for m in data])
        for w in np.unique(np.minimum(width[i], width[j])):
            mine = np.flatnonzero(np.minimum(width[i], width[j]) == w)
            used = np.unique(np.concatenate((i[mine], j[mine])))
            folded = np.zeros((len(key), w), np.uint8)
            for r in used:
                folded[r] = np.bitwise_xor.reduce(data[r].reshape(-1, w), axis=0)
            for at in range(0, len(mine), 1 << 14):
                some = mine[at : at + (1 << 14)]
                differ = np.bitwise_count(folded[i[some]] ^ folded[j[some]]).sum(axis=1, dtype=np.int64)
                most[some] -= own[i[some]] + own[j[some]] + differ
        keep = most >= 0
        i, j = i[keep], j[keep]
    return np.stack((key[i], key[j]))


def linked(
    postings: DataFrame, verified: Callable[[DataFrame], DataFrame], shared: int, of: int, rounds: int = ROUNDS, known: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Verified pairs (a < b) whose components are those of all alike pairs that some list holds, and node, component.

    postings: list, row_key, size, own (elements in no other set) and map (parity_map of the
    others, or null). Alike sets have shared/of of their union in common; verified keeps the
    alike ones of distinct pairs (a, b). Of lists that hold the same rows one is looked at.
    known: a written table of verified pairs, found otherwise, which count as links from the start.
    """
    work = Workspace(postings.sparkSession, "links")
    h = [F.bit_xor(F.xxhash64(F.lit(s), "row_key")).alias(f"h{s}") for s in (1, 2)]
    often = postings.groupBy("list").agg(F.count("*").alias("n"), *h).where("n > 1").groupBy("n", "h1", "h2").agg(F.min("list").alias("list"))
    postings = work.keep(postings.join(often.select("list"), "list"), "postings", compression="zstd")

    def named(components: DataFrame) -> DataFrame:
        return postings.join(components.withColumnRenamed("node", "row_key"), "row_key", "left").withColumn("component", F.coalesce("component", "row_key"))

    lists, links, done = postings.withColumn("component", F.col("row_key")), known, known
    if known is not None and not known.isEmpty():
        lists = named(work.keep(connected_components(known, "a", "b"), "components"))
    for turn in range(rounds + 1):
        pairs = central_pairs(lists, turn, shared, of) if turn < rounds else remaining_pairs(lists, shared, of)
        pairs = work.keep(pairs if done is None else pairs.join(done, ["a", "b"], "left_anti"), "pairs")
        done = pairs if done is None else done.unionByName(pairs)
        found = verified(pairs).select("a", "b")
        links = work.keep(found if links is None else links.unionByName(found), "links")
        components = work.keep(connected_components(links, "a", "b"), "components")
        if turn < rounds:
            placed = named(components)
            apart = placed.groupBy("list").agg((F.min("component") < F.max("component")).alias("apart")).where("apart").select("list")
            before, lists = lists, work.keep(placed.join(apart, "list"), "lists", compression="zstd")
            if turn:
                work.drop(before)
    work.drop(postings)
    return links, components

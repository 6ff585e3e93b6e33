"""SimHash near-duplicates by a byte-position inverted index with count filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import key_column, keyed
from textloom.operators.components import connected_components
from textloom.session import Workspace

BITS_APART = 2
SHINGLE = 3
SEED = 42
#: Marks of a list whose pairs are tallied at most; longer lists are split further.
LIST_MOST = 1024
_HASH_ROWS = 1 << 18


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """row_key, doc_id and the 64-bit SimHash (as a signed long) of each document's word shingles.

    A-Z is lower-cased, words are `[^\\x20\\x09-\\x0D]+`, shingles count with their repeats;
    a text with fewer words is one shingle, one without words has fingerprint 0, as have
    nulls. A bit is set if it is set in over half of the XXH64 hashes.
    """

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, batch in keyed(batches):
            marks = np.zeros(batch.num_rows, np.uint64)
            held: list[list[int]] = []
            rows: list[int] = []
            size = 0
            for row, text in enumerate(batch.column(2).cast(pa.large_binary()).to_pylist()):
                found = shingle_hashes(text, shingle)
                if found:
                    held.append(found)
                    rows.append(row)
                    size += len(found)
                if size >= _HASH_ROWS:
                    marks[rows] = _majority(held)
                    held, rows, size = [], [], 0
            if rows:
                marks[rows] = _majority(held)
            yield pa.RecordBatch.from_arrays([keys, batch.column(1), pa.array(marks.view(np.int64))], names=["row_key", "doc_id", "mark"])

    picked = docs.select(key_column(row_col), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string"))
    return picked.mapInArrow(made, "row_key long, doc_id long, mark long")


def shingle_hashes(text: bytes | None, shingle: int) -> list[int]:
    """XXH64 (seed 42) of each run of so many words of a text, A-Z lower-cased; of all words if there are fewer."""
    words = text.lower().split() if text else []
    if not words:
        return []
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return [digest(joined, SEED)]
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    return [digest(joined[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())]


def _majority(held: list[list[int]]) -> np.ndarray:
    """The fingerprint of each list of hashes."""
    counts = np.array([len(x) for x in held], np.int64)
    return majority(np.fromiter((h for x in held for h in x), np.uint64, int(counts.sum())), counts)


def majority(flat: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The fingerprint of each run of so many hashes, one after another; a run has at least one."""
    at = np.concatenate(([0], np.cumsum(counts)))
    ones = np.empty((len(counts), 64), np.int64)
    for byte in range(8):
        bits = np.unpackbits(np.ascontiguousarray(flat.view(np.uint8).reshape(-1, 8)[:, byte : byte + 1]), axis=1, bitorder="little")
        ones[:, 8 * byte : 8 * byte + 8] = np.add.reduceat(bits, at[:-1], axis=0, dtype=np.int64)
    return np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little").view("<u8")[:, 0]


def links(marks: DataFrame, apart: int = BITS_APART, most: int = LIST_MOST) -> DataFrame:
    """Edges (src, dst) whose components are those of all pairs of distinct marks at most `apart` bits apart.

    Two marks that differ in at most `apart` bits differ in at most `apart` of their eight
    bytes: at least 8 - apart positional bytes are shared, the guaranteed minimum. The
    inverted index lists marks by positional bytes, four at a time (two of the four byte
    pairs, of which two differing bytes spoil two at most), since a list by one byte would
    hold about 1/256 of all marks. Within a list every pair's shared positional bytes are
    tallied, pairs that reach the minimum are kept and their bits compared; as many of
    these links are returned as keep the list's components.

    A list of more than `most` marks is split by two more positional bytes: any pair that
    reaches the minimum shares two of the four bytes left, so it meets in one of the six
    sublists, which hold at most 65,536 marks that share six bytes. There a mark's possible
    partners are looked up rather than tallied: the result is the same.
    """
    if not 0 <= apart <= 2:
        raise ValueError("lists are bounded for at most two differing bytes")
    work = Workspace(marks.sparkSession, "lists")
    pairs = [(0, 1), (2, 3), (4, 5), (6, 7)]
    firsts = [a + b for a, b in combinations(pairs, 2)]
    index = work.keep(marks.select("mark", F.explode(F.array(*(_shared(f, i) for i, f in enumerate(firsts)))).alias("l")).select("mark", "l.*"), "index")
    sizes = index.groupBy("choice", "shared").agg(F.count("*").alias("n")).where("n > 1")
    sizes = work.keep(sizes, "sizes")
    short = index.join(sizes.where(f"n <= {most}"), ["choice", "shared"]).groupBy("choice", "shared").agg(F.collect_list("mark").alias("marks"))
    found = short.select("marks").mapInArrow(lambda batches: _tallied(batches, apart), "src long, dst long")
    long_ = index.join(sizes.where(f"n > {most}"), ["choice", "shared"])
    more = []
    for i, f in enumerate(firsts):
        rest = [b for b in range(8) if b not in f]
        more += [(i, f + two) for two in combinations(rest, 2)]
    frees = [tuple(b for b in range(8) if b not in held) for _, held in more]
    entries = [F.when(F.col("choice") == i, F.struct(F.lit(n).alias("free"), _shared(held, n)["shared"].alias("six"), _packed(frees[n]).alias("rest"))) for n, (i, held) in enumerate(more)]
    split = long_.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    lists = split.groupBy("free", "six").agg(F.collect_set("rest").alias("rests")).where(F.size("rests") > 1)
    near = np.array([0, *(sum(1 << b for b in c) for k in range(1, apart + 1) for c in combinations(range(16), k))], np.int64)

    def tied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, dst = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
            for free, shared, rests in zip(*(batch.column(i).to_pylist() for i in range(3))):
                values = np.array(sorted(rests), np.int64)
                a, b = _verified(values, near)
                if len(a):
                    base = np.uint64(shared & (1 << 64) - 1)
                    src.append(base | _placed(values[a], frees[free]))
                    dst.append(base | _placed(values[b], frees[free]))
            yield _edges(src, dst)

    return found.unionByName(lists.mapInArrow(tied, "src long, dst long"))


def _shared(held: tuple[int, ...], number: int):
    """A choice of positional bytes and a mark's values there."""
    mask = sum(0xFF << (8 * b) for b in held)
    signed = mask - (1 << 64) if mask >> 63 else mask
    return F.struct(F.lit(number).alias("choice"), F.col("mark").bitwiseAND(F.lit(signed).cast("long")).alias("shared"))


def _packed(free: tuple[int, ...]):
    """The two bytes of a mark at the free positions, as one number."""
    rest = F.lit(0)
    for i, b in enumerate(free):
        rest = rest + F.shiftleft(F.shiftrightunsigned("mark", 8 * b).bitwiseAND(F.lit(255)), 8 * i)
    return rest.cast("int")


def _edges(src: list[np.ndarray], dst: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (src, dst)], names=["src", "dst"])


def _tallied(batches: Iterator[pa.RecordBatch], apart: int) -> Iterator[pa.RecordBatch]:
    """Links within lists of marks by tallying each pair's shared positional bytes."""
    for batch in batches:
        src, dst = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for marks in batch.column(0):
            marks = np.sort(marks.values.to_numpy().view(np.uint64))
            bytes_ = marks.view(np.uint8).reshape(-1, 8)
            tally = np.zeros((len(marks), len(marks)), np.uint8)
            for b in range(8):
                tally += bytes_[:, None, b] == bytes_[None, :, b]
            i, j = np.nonzero(np.triu(tally >= 8 - apart, 1))
            near = np.bitwise_count(marks[i] ^ marks[j]) <= apart
            a, b = _tied(len(marks), j[near], i[near])
            src.append(marks[a])
            dst.append(marks[b])
        yield _edges(src, dst)


def _verified(values: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of linked pairs among sorted distinct values; components equal those of all pairs within reach.

    Every value is linked to all its neighbours in a vectorised sweep, of which a spanning
    forest stays.
    """
    label = np.arange(len(values))
    pairs = []
    for mask in near[1:]:
        at = np.searchsorted(values, values ^ mask)
        at[at == len(values)] = 0
        hit = np.flatnonzero((values[at] == values ^ mask) & (values > values ^ mask))
        if len(hit):
            pairs.append(np.stack((hit, at[hit])))
    if not pairs:
        return label[:0], label[:0]
    return _tied(len(values), *np.concatenate(pairs, axis=1))


def _tied(n: int, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """So many of the pairs (a, b) of n places as keep their components: a spanning forest.

    In each round every component takes its first pair that leaves it.
    """
    label, kept = np.arange(n), [np.zeros((2, 0), np.int64)]
    while True:
        out = label[a] != label[b]
        a, b = a[out], b[out]
        if not len(a):
            break
        x, y, at = label[a], label[b], np.arange(len(a))
        first = np.full(n, len(a))
        np.minimum.at(first, x, at)
        np.minimum.at(first, y, at)
        at = np.unique(first[first < len(a)])
        kept.append(np.stack((a[at], b[at])))
        label = _reached(n, x[at], y[at])[label]
    return tuple(np.concatenate(kept, axis=1))


def _reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place that each of n places reaches by pairs (a, b)."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _placed(values: np.ndarray, free: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(values), np.uint64)
    for i, b in enumerate(free):
        out |= ((values >> (8 * i)) & 255).astype(np.uint64) << np.uint64(8 * b)
    return out


def near_duplicates(docs: DataFrame, apart: int = BITS_APART, id_col: str = "doc_id", text_col: str = "text", marked: DataFrame | None = None) -> DataFrame:
    """One row a document: row_key, doc_id, mark, component_id (the smallest doc_id it reaches by links) and component.

    Documents link when their fingerprints differ in at most `apart` bits. Equal
    fingerprints are one node, so copies of any number cost one row; components are found
    over distinct fingerprints. component names a component by one of its fingerprints.
    Null ids belong to components but never give component_id unless all are null. Repeated
    rows are rows of their own. Other columns are not read; an empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "simhash")
    marked = marked if marked is not None else work.keep(fingerprints(docs, id_col=id_col, text_col=text_col), "marks")
    nodes = work.keep(marked.groupBy("mark").agg(F.min("doc_id").alias("first")), "nodes")
    edges = work.keep(links(nodes.select("mark"), apart), "links")
    found = connected_components(edges)
    grouped = nodes.join(found, nodes.mark == found.node, "left").select("mark", "first", F.coalesce("component", "mark").alias("component"))
    grouped = work.keep(grouped, "groups")
    least = grouped.groupBy("component").agg(F.min("first").alias("component_id"))
    names = grouped.join(least, "component").select("mark", "component_id", "component")
    return marked.join(names, "mark").select("row_key", "doc_id", "mark", "component_id", "component")

"""Near copies by exact Jaccard similarity of word shingles: SimHash first, then an index of shingles.

Sets whose SimHash fingerprints differ in few bits are found by the inverted index on
positional bytes with count filtering (simhash.py) and compared whole. Most alike sets
differ in more bits, and no number of shared bytes is certain for them, so an exact search
follows among all rows that these links keep apart. A similar pair shares a shingle among the first few of both sets, in any one order of all
shingles (prefix filter). The order here is rarest first, by estimates that all blocks of
texts exchange once: unique shingles, the bulk of any corpus, come first and make no
postings, and shared passages come last. What two sets share are shingles that are not
unique, so sets are compared whole by those alone.

Rows listed under one shingle are not paired with each other, see operators/links.py.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import blocks_of, exchange, gaps, opened, range_bits, ranges, sent
from textloom.llm.simhash import BITS_APART, links, majority, shingle_hashes
from textloom.llm.token_files import decode_segment, encode_segment
from textloom.operators.links import linked, parity_map
from textloom.session import Workspace

SHINGLE = 5
#: Alike from 4/5 on, in whole numbers.
SHARED, OF = 4, 5
#: Sketch rows; cells a row per entry; bits of an entry beyond those that number the shingles.
DEPTH = 2
CELLS = 8
SPARE_BITS = 8
#: Pairs whose rows' keys are sent to every executor at most.
BROADCAST_PAIRS = 200_000
#: Entries that one range handles, about.
RANGE_ENTRIES = 1 << 19
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_SETS = "row_key long, size int, own int, digest binary, prefix array<long>, common binary, map binary, mark long"


class _Shingles:
    """The sets of a block's texts, one after another, and their entries in the exchange."""

    def __init__(self, texts: list[bytes], bits: int):
        sets = [np.unique(np.array(shingle_hashes(t, SHINGLE), np.uint64)) for t in texts]
        self.sizes = [len(s) for s in sets]
        self.hashes = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        self.entries, self.entry, self.counts = np.unique(self.hashes >> np.uint64(64 - bits), return_inverse=True, return_counts=True)

    def each(self) -> Iterator[tuple[int, slice]]:
        for n, end in zip(self.sizes, accumulate(self.sizes)):
            yield n, slice(end - n, end)


def _estimates(table: pa.Table) -> pa.Table:
    """Add up one range's entries over all blocks; answer each block how many sets an entry is in, 255 at most.

    An entry's estimate is the least of its cells, each the sum of all that fall there: it
    is never below the true number, so an estimate of one is certain, and it is the same
    for all blocks.
    """
    unpack = zstandard.ZstdDecompressor()
    parts, counts = [], []
    for data in table.column("payload").to_pylist():
        n = int.from_bytes(data[:4], "little")
        parts.append(np.cumsum(decode_segment(data[4 : 4 + n]).astype(np.uint64), dtype=np.uint64))
        counts.append(np.frombuffer(unpack.decompress(data[4 + n :], max_output_size=1 << 32), np.uint8))
    entries, count = np.concatenate(parts), np.concatenate(counts).astype(np.float64)
    width = max(64, CELLS * len(entries))
    least = np.full(len(entries), 255.0)
    for row in range(DEPTH):
        x = entries * _ODD[row] + np.uint64(row)
        cells = ((x ^ (x >> np.uint64(29))) * _ODD[1 - row] >> np.uint64(7)) % np.uint64(width)
        cells = cells.astype(np.int64)
        least = np.minimum(least, np.bincount(cells, count, width)[cells])
    squeeze = zstandard.ZstdCompressor(level=1)
    found = np.split(least.astype(np.uint8), np.cumsum([len(p) for p in parts])[:-1])
    return pa.table([table.column("block"), table.column("range"), pa.array([squeeze.compress(f.tobytes()) for f in found], pa.binary())], names=["block", "range", "bits"])


def _answered(reply: list | None) -> np.ndarray:
    """The estimates of all ranges of a block, in the order its sorted entries were sent."""
    unpack = zstandard.ZstdDecompressor()
    return np.frombuffer(b"".join(unpack.decompress(r["bits"], max_output_size=1 << 32) for r in sorted(reply or [], key=lambda r: r["range"])), np.uint8)


def shingle_sets(docs: DataFrame, row_col: str, text_col: str = "text", work: Workspace | None = None) -> DataFrame:
    """The sets that may have a partner: row_key, size, own (unique shingles), digest, prefix, common, map and mark.

    mark is the SimHash fingerprint of the set, as a signed long, 0 for the empty set; map is the parity map of common, which holds the hashes of the set's shingles not known to be unique,
    ascending; prefix those among its first size - ceil(size * SHARED / OF) + 1 in the order
    of (estimate, hash). Sets without any of them have no partner and are left out; empty
    sets are kept, they equal each other.
    """
    work = work or Workspace(docs.sparkSession, "shingles")
    picked = docs.select(F.col(row_col).cast("long").alias("row_key"), F.col(text_col).cast("string").alias("text"))
    blocks = blocks_of(picked, SHINGLE, work, "textloom_shingles")
    number, rows = blocks.agg(F.sum("n_windows"), F.sum(F.size("doc_ids"))).first()
    number = max(1, (number or 0) + (rows or 0))
    bits, leading = min(60, number.bit_length() + SPARE_BITS), range_bits(number, RANGE_ENTRIES)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for key, texts, *_ in opened(batches):
            mine, parts = _Shingles(texts, bits), []
            counts = np.minimum(mine.counts, 255).astype(np.uint8)
            for r, s in ranges(mine.entries, bits, leading):
                packed = encode_segment(gaps(mine.entries[s], bits, leading))
                parts.append((r, len(packed).to_bytes(4, "little") + packed + squeeze.compress(counts[s].tobytes())))
            yield sent(key, parts)

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, texts, keys, reply in opened(batches):
            mine, out = _Shingles(texts, bits), [[] for _ in range(8)]
            estimate = _answered(reply)[mine.entry]
            sizes = np.array(mine.sizes, np.int64)
            marks = np.zeros(len(sizes), np.uint64)
            if len(mine.hashes):
                marks[sizes > 0] = majority(mine.hashes, sizes[sizes > 0])
            for key, mark, (n, cut) in zip(keys, marks.view(np.int64).tolist(), mine.each()):
                often, hashes = estimate[cut], mine.hashes[cut]
                shared = np.flatnonzero(often > 1)
                first = n - -(-n * SHARED // OF) + 1 - (n - len(shared))
                if n and first <= 0:
                    continue
                order = shared[np.argsort(often[shared], kind="stable")[: max(0, first)]]
                row = key, n, n - len(shared), xxhash.xxh3_128_digest(hashes.tobytes()), hashes[order].view(np.int64), hashes[shared].tobytes(), parity_map(hashes[shared]), mark
                for column, value in zip(out, row):
                    column.append(value)
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["row_key", "size", "own", "digest", "prefix", "common", "map", "mark"])

    replies = exchange(blocks, sketches, _estimates, work, "estimates")
    joined = blocks.join(replies.hint("shuffle_hash"), "block", "left")
    return joined.select("block", "doc_ids", "lengths", "payload", "reply").mapInArrow(sets, _SETS)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose shingle sets are alike, compared whole: what they share lies in both common parts."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for x, y, m, n in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), batch.column(5).to_pylist()):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                shared = len(np.intersect1d(x, y, assume_unique=True))
                kept.append(OF * shared >= SHARED * (m + n - shared))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    named = pairs.select(F.explode(F.array("a", "b")).alias("row_key")).distinct()
    few = pairs.count() <= BROADCAST_PAIRS  # pairs is a written table
    needed = sets.select("row_key", "size", "common").join(F.broadcast(named) if few else named, "row_key", "left_semi")
    met = pairs.join(needed.toDF("a", "m", "x"), "a").join(needed.toDF("b", "n", "y"), "b")
    return met.select("a", "b", "x", "y", "m", "n").mapInArrow(alike, "a long, b long")


def marked_pairs(nodes: DataFrame, work: Workspace, apart: int = BITS_APART) -> DataFrame:
    """Pairs a < b of rows whose fingerprints are equal, or tied by links of at most so many differing bits."""
    marks = work.keep(nodes.groupBy("mark").agg(F.min("row_key").alias("first")), "marks")
    same = nodes.join(marks, "mark").where("row_key <> first").select(F.col("first").alias("a"), F.col("row_key").alias("b"))
    tied = links(marks.select("mark"), apart).join(marks.toDF("src", "x"), "src").join(marks.toDF("dst", "y"), "dst")
    return same.unionByName(tied.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))).distinct()


def near_copies(docs: DataFrame, row_col: str, text_col: str = "text") -> DataFrame:
    """row_key and component (the smallest row key reached) of each row that has a near copy.

    Rows are linked from a similarity of SHARED/OF on; A-Z is lower-cased, a text shorter
    than a shingle is one shingle, texts without words (and nulls) are alike. Rows of
    equal sets are one node. row_col is unique, not null and the same in every reading of
    docs. Other columns are not read; an empty table gives no rows.
    """
    work, first = Workspace(docs.sparkSession, "near"), Workspace(docs.sparkSession, "shingles")
    rows = work.keep(shingle_sets(docs, row_col, text_col, first), "sets", compression="zstd")
    first.drop(first.root)
    named = rows.groupBy("digest").agg(F.min("row_key").alias("node"))
    members = work.keep(rows.select("row_key", "digest").join(named, "digest").select("row_key", "node"), "members")
    nodes = rows.join(named.select(F.col("node").alias("row_key")), "row_key", "left_semi")
    posted = nodes.select("row_key", "size", "own", "map", F.explode("prefix").alias("list"))
    known = work.keep(verified(work.keep(marked_pairs(nodes.select("row_key", "mark"), work), "marked"), rows), "known")
    _, components = linked(posted, lambda pairs: verified(pairs, rows), SHARED, OF, known=known)
    found = members.join(components, members.node == components.node, "left").select("row_key", members.node.alias("own"), F.coalesce("component", members.node).alias("component"))
    several = found.groupBy("component").agg((F.count("*") > 1).alias("several")).where("several").select("component")
    out = work.keep(found.join(several, "component").select("row_key", "component"), "out")
    for table in (rows, members):
        work.drop(table)
    return out

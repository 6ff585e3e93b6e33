"""Blocks of whole texts, and the exchange of compact parts between blocks and ranges of a hash space.

Texts are packed once into blocks of about BLOCK_BYTES and written in buckets by block, so
that each later pass joins small replies to a block where it lies. In an exchange every
block sends each range of the hash space its sorted part, a range merges the parts of all
blocks, and each block gets back one reply a range. Everything sent is linear in the input.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import row_keys, word_counts
from textloom.session import Workspace

BLOCK_BYTES = 2 << 20
#: Entries that one range handles, about.
RANGE_ENTRIES = 4 << 20
BLOCKS = "block long, doc_ids array<long>, lengths binary, n_windows long, payload binary"
SENT = "range int, block long, payload binary"
REPLY = "block long, range int, bits binary"


def blocks_of(picked: DataFrame, window: int, work: Workspace, name: str) -> DataFrame:
    """A bucketed table of the blocks of picked (an id and a text), with each block's number of windows of so many words."""
    spark = picked.sparkSession
    size = picked.agg(F.sum(F.octet_length(picked.columns[1]))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (16 * BLOCK_BYTES)))
    most = BLOCK_BYTES
    packed = picked.mapInArrow(lambda batches: _pack(batches, window, most), BLOCKS).repartition(buckets, "block")
    return work.keep_bucketed(packed, f"{name}_{uuid.uuid4().hex[:12]}", buckets, "block")


def _pack(batches: Iterator[pa.RecordBatch], window: int, most: int) -> Iterator[pa.RecordBatch]:
    taken, ids, texts, windows, size = 0, [], [], 0, 0
    squeeze = zstandard.ZstdCompressor(level=1)

    def closed() -> pa.RecordBatch:
        lengths = np.array([len(t) for t in texts], "<i8").tobytes()
        row = [row_keys(taken, 1), [ids], [lengths], [windows], [squeeze.compress(b"".join(texts))]]
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, kinds)], names=["block", "doc_ids", "lengths", "n_windows", "payload"])

    for batch in (whole.slice(at, 512) for whole in batches for at in range(0, whole.num_rows, 512)):
        counts = word_counts(batch.column(1)).tolist()
        for key, text, n in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.large_binary()).to_pylist(), counts):
            ids.append(key)
            texts.append(text or b"")
            windows += max(0, n - window + 1)
            size += len(texts[-1])
            if size >= most or len(ids) >= 1 << 16:
                yield closed()
                taken, ids, texts, windows, size = taken + 1, [], [], 0, 0
    if ids:
        yield closed()


def _texts(lengths: bytes, payload: bytes) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(payload, max_output_size=1 << 62) if payload else b""
    ends = np.cumsum(np.frombuffer(lengths, "<i8")).tolist()
    return [whole[a:b] for a, b in zip([0, *ends[:-1]], ends)]


def exchange(source: DataFrame, send: Callable, merge: Callable, work: Workspace, name: str) -> DataFrame:
    """Send each block's parts to their ranges, merge, and bring each block its ranges' replies."""
    columns = [c for c in ("block", "doc_ids", "lengths", "payload", "reply") if c in source.columns]
    parts = source.select(*columns).mapInArrow(send, SENT)
    answered = parts.groupBy("range").applyInArrow(merge, REPLY)
    by = answered.groupBy("block").agg(F.collect_list(F.struct("range", "bits")).alias("reply"))
    return work.keep(by, name, compression="zstd")


def opened(batches: Iterator[pa.RecordBatch]):
    """Key, texts, ids and the replies of each block."""
    for batch in batches:
        for i in range(batch.num_rows):
            key, ids, lengths, payload, *replies = (c[i].as_py() for c in batch.columns)
            yield key, _texts(lengths, payload), ids, *replies


def range_bits(entries: int, each: int | None = None) -> int:
    """How many leading bits number the ranges of so many entries, `each` in one."""
    return min(30, max(0, (max(1, entries) // (each or RANGE_ENTRIES)).bit_length()))


def ranges(top: np.ndarray, bits: int, leading: int) -> list[tuple[int, slice]]:
    """The non-empty ranges (by leading bits) of sorted values of so many bits, with the part of each."""
    which = (top >> np.uint64(bits - leading)).astype(np.int64) if leading else np.zeros(len(top), np.int64)
    found, first = np.unique(which, return_index=True)
    return [(int(r), slice(a, b)) for r, a, b in zip(found, first, [*first[1:], len(top)])]


def gaps(entries: np.ndarray, bits: int, leading: int) -> np.ndarray:
    """Differences of sorted entries within their range."""
    return np.diff(entries & np.uint64((1 << (bits - leading)) - 1), prepend=np.uint64(0))


def sent(key: int, parts: list[tuple[int, bytes]]) -> pa.RecordBatch:
    rows = [[r for r, _ in parts], [key] * len(parts), [p for _, p in parts]]
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, (pa.int32(), pa.int64(), pa.binary()))], names=["range", "block", "payload"])

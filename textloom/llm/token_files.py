"""Token-id files in patched frame-of-reference blocks.

Format of one segment (all little-endian): "PFR1", block length u2, percentile u2, number
of ids u8, number of blocks u4; then per block its minimum u4, its width in bits u1, its
number of exceptions u2, and the byte where it starts u8 (the index of block starts); then
the blocks. A block holds length x width bits, value j of each run of 32 in the bits j x
width onward of width 32-bit words, followed by its exceptions' places (u2 each) and their
values above the minimum (u4 each). The width is that of the block's percentile value
above its minimum, so a few large ids do not widen all.

A file set is a folder of Parquet parts, one row a segment: the row's `payload` is the
segment, the other columns say which documents it holds and where its ids begin, so
readers skip payloads they do not need. Documents never straddle segments.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textloom.llm.encoding import encoder

BLOCK = 256
PERCENTILE = 90
#: A segment is closed once it has this many ids.
SEGMENT_IDS = 1 << 20
_HEAD = struct.Struct("<4sHHQI")
_DIRECTORY = (("minimum", "<u4"), ("width", "u1"), ("exceptions", "<u2"), ("start", "<u8"))


def pack_words(rows: np.ndarray, width: int) -> np.ndarray:
    """Pack (n, 32) unsigned values below 2**width into (n, width) 32-bit words."""
    values = np.ascontiguousarray(rows.T)
    out = np.zeros((width, values.shape[1]), np.uint32)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        out[word] |= values[j] << np.uint32(shift)
        if shift + width > 32:
            out[word + 1] |= values[j] >> np.uint32(32 - shift)
    return np.ascontiguousarray(out.T)


def unpack_words(words: np.ndarray, width: int) -> np.ndarray:
    """The (n, 32) values that pack_words packed."""
    lanes = np.ascontiguousarray(words.T)
    out = np.empty((32, lanes.shape[1]), np.uint32)
    mask = np.uint32((1 << width) - 1)
    for j in range(32):
        word, shift = divmod(j * width, 32)
        out[j] = lanes[word] >> np.uint32(shift)
        if shift + width > 32:
            out[j] |= lanes[word + 1] << np.uint32(32 - shift)
        out[j] &= mask
    return np.ascontiguousarray(out.T)


def encode_segment(ids: np.ndarray, percentile: int = PERCENTILE) -> bytes:
    """Pack ids (below 2**32) as one segment; no ids give a segment without blocks."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    values = np.empty(blocks * BLOCK, np.uint32)
    values[:n] = ids
    if n:
        values[n:] = values[n - 1]
    values = values.reshape(blocks, BLOCK)
    low = values.min(axis=1) if blocks else np.zeros(0, np.uint32)
    above = values - low[:, None]
    rank = min(BLOCK - 1, BLOCK * percentile // 100)
    typical = np.partition(above, rank, axis=1)[:, rank] if blocks else low
    width = _bits(typical)
    odd = above > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1))[:, None]
    count = odd.sum(axis=1).astype(np.int64)
    size = width.astype(np.int64) * (BLOCK // 8) + 6 * count
    start = np.cumsum(size) - size
    body = np.zeros(int(size.sum()), np.uint8)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if w:
            kept = np.where(odd[mine], 0, above[mine]).astype(np.uint32).reshape(-1, 32)
            packed = pack_words(kept, int(w)).view(np.uint8).reshape(len(mine), -1)
            body[start[mine][:, None] + np.arange(packed.shape[1])] = packed
    row, place = np.nonzero(odd)
    if len(row):
        nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        at = (start + width.astype(np.int64) * (BLOCK // 8))[row]
        body[(at + 2 * nth)[:, None] + np.arange(2)] = place.astype("<u2").view(np.uint8).reshape(-1, 2)
        body[(at + 2 * count[row] + 4 * nth)[:, None] + np.arange(4)] = above[row, place].astype("<u4").view(np.uint8).reshape(-1, 4)
    head = _HEAD.pack(b"PFR1", BLOCK, percentile, n, blocks)
    return b"".join((head, *(x.astype(t).tobytes() for x, (_, t) in zip((low, width, count, start), _DIRECTORY)), body.tobytes()))


def decode_segment(data: bytes) -> np.ndarray:
    """All ids of a segment, as uint32."""
    n, blocks, low, width, count, start, body = _opened(data)
    out = np.zeros((blocks, BLOCK), np.uint32)
    for w in np.unique(width):
        mine = np.flatnonzero(width == w)
        if w:
            packed = body[start[mine][:, None] + np.arange(int(w) * (BLOCK // 8))]
            out[mine] = unpack_words(np.ascontiguousarray(packed).view("<u4").reshape(-1, int(w)), int(w)).reshape(len(mine), BLOCK)
    if count.any():
        row = np.repeat(np.arange(blocks), count)
        nth = np.arange(len(row)) - (np.cumsum(count) - count)[row]
        at = (start + width.astype(np.int64) * (BLOCK // 8))[row]
        place = np.ascontiguousarray(body[(at + 2 * nth)[:, None] + np.arange(2)]).view("<u2")[:, 0]
        out[row, place] = np.ascontiguousarray(body[(at + 2 * count[row] + 4 * nth)[:, None] + np.arange(4)]).view("<u4")[:, 0]
    return (out + low[:, None]).reshape(-1)[:n]


def decode_block(data: bytes, block: int) -> np.ndarray:
    """The ids of one block, read by its entry in the index of block starts."""
    n, _, low, width, count, start, body = _opened(data)
    at, w = int(start[block]), int(width[block])
    end = at + w * (BLOCK // 8)
    out = unpack_words(body[at:end].view("<u4").reshape(-1, w), w).reshape(-1) if w else np.zeros(BLOCK, np.uint32)
    k = int(count[block])
    out[body[end : end + 2 * k].view("<u2")] = body[end + 2 * k : end + 6 * k].view("<u4")
    return (out + low[block])[: n - block * BLOCK]


def _opened(data: bytes):
    magic, block, _, n, blocks = _HEAD.unpack_from(data)
    if magic != b"PFR1" or block != BLOCK:
        raise ValueError("not a segment of this format")
    at, found = _HEAD.size, []
    for _, kind in _DIRECTORY:
        found.append(np.frombuffer(data, kind, blocks, at))
        at += blocks * np.dtype(kind).itemsize
    low, width, count, start = found
    body = np.frombuffer(data, np.uint8, offset=at) if at < len(data) else np.zeros(0, np.uint8)
    return n, blocks, low, width, count.astype(np.int64), start.astype(np.int64), body


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


_FILES = "part int, segment int, start long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"
_READ = "doc_id long, start long, n_tokens long, ids binary"


def write_token_files(
    docs: DataFrame,
    path: str,
    vocabulary: str = "byte_bpe_50k.json",
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every text, append end_id to each document, and write a file set in ascending id_col order.

    One range shuffle of ids and texts gives the order; each task then writes its range in
    sequence. Null and empty texts are documents with the end id alone; null ids come
    first; rows with equal ids all stay, in any order among themselves. Other columns of
    docs, whatever their names, are not read. An empty table makes an empty file set.
    """

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        part, segment, begun, held, ids, pending = TaskContext.get().partitionId(), 0, 0, 0, [], []
        tail = np.array([end_id], np.uint32)

        def closed() -> pa.RecordBatch:
            lengths = [len(x) + 1 for x in pending]
            flat = np.concatenate([y for x in pending for y in (x, tail)]).astype(np.uint32)
            rows = [[part], [segment], [begun], [held], [ids], [lengths], [encode_segment(flat)]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(rows, _ARROW)], schema=_ARROW)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = encode(text)
                ids.append(key)
                pending.append(found)
                held += len(found) + 1
                if held >= SEGMENT_IDS:
                    yield closed()
                    segment, begun, held, ids, pending = segment + 1, begun + held, 0, [], []
        if pending:
            yield closed()

    ordered = docs.select(F.col(id_col).cast("long").alias("k"), F.col(text_col).alias("t")).repartitionByRange("k").sortWithinPartitions("k")
    ordered.mapInArrow(segments, _FILES).write.option("compression", "zstd").parquet(path)


_ARROW = pa.schema(
    [("part", pa.int32()), ("segment", pa.int32()), ("start", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("payload", pa.binary())]
)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a file set: doc_id, start (ids before it in the set), n_tokens, ids (uint32 little-endian).

    Starts need the ids of all earlier parts: one number a part, summed over the small
    columns alone and broadcast; there are as many parts as the writing job had tasks.
    """
    files = spark.read.schema(_FILES).parquet(path)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = files.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = decode_segment(r["payload"]).astype("<u4")
                lengths = np.array(r["lengths"], np.int64)
                ends = np.cumsum(lengths)
                cut = [ids[a:b].tobytes() for a, b in zip(ends - lengths, ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(ends - lengths + r["start"] + r["before"]), pa.array(lengths), pa.array(cut, pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"],
                )

    return files.join(F.broadcast(before), "part").select("start", "before", "doc_ids", "lengths", "payload").mapInArrow(rows, _READ)

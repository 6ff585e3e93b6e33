"""Substring dedup: a count-min prefilter, then exact groups of the windows it estimates repeated.

Documents are packed once into blocks, written in buckets by block, so that each later
pass joins small replies to a block where it lies. A pass computes a block's window
hashes, sends each range of the hash space its sorted part, and gets back one bit for
each entry sent. In the first pass the parts are sparse sketches (one entry a distinct
window, under the number of bits the corpus size asks for); a range merges those of all
blocks into one count-min sketch and replies which entries it estimates in two blocks or
more. An estimate is never too low, so no repeated window is lost. In the second pass
only those windows send long digests, and a range counts these exactly. A window that
recurs within its block is known there. Everything sent is linear in the input, a
window that a third of all documents share is one entry a block, and no range grows
beyond the entries it was made for.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.blocks import blocks_of, exchange, gaps, opened, range_bits, ranges, sent
from textloom.llm.token_files import decode_segment, encode_segment
from textloom.session import Workspace

WINDOW = 35
#: Sketch rows; cells a row per entry; bits of an entry beyond those that number the windows.
DEPTH = 2
CELLS = 4
SPARE_BITS = 5
_ODD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i below n at least."""
    found = _POWERS.get(base)
    if found is None or len(found) < n:
        size = 1 << max(16, (n - 1).bit_length())
        found = np.full(size, base, np.uint64)
        found[0] = 1
        found = np.cumprod(found, dtype=np.uint64)
        _POWERS[base] = found
    return found


class Block:
    """A block's words, its windows' places, and their hashes."""

    def __init__(self, texts: list[bytes], window: int):
        self.words = [t.split() for t in texts]
        self.counts = np.array([len(w) for w in self.words], np.int64)
        self.window = window
        n = int(self.counts.sum())
        ends = np.repeat(np.cumsum(self.counts), self.counts)
        self.places = np.flatnonzero(np.arange(n) + window <= ends)
        self._hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chain.from_iterable(self.words)), np.uint64, n)

    def digests(self, which: int, places: np.ndarray) -> np.ndarray:
        """64-bit hashes of the windows at places: polynomials over the word hashes, one base for each `which`."""
        base = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)[which]
        n = len(self._hashes)
        with np.errstate(over="ignore"):
            sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(self._hashes + _ODD[which]) * _powers(base, n)[:n], dtype=np.uint64)))
            return _mix((sums[places + self.window] - sums[places]) * _powers(pow(base, -1, 1 << 64), n)[places])


def _ordered(reply: list | None) -> np.ndarray:
    """The reply bits of all ranges of a block, in the order its sorted entries were sent."""
    bits = [np.unpackbits(np.frombuffer(r["bits"], np.uint8)[4:], count=int.from_bytes(r["bits"][:4], "little")) for r in sorted(reply or [], key=lambda r: r["range"])]
    return np.concatenate(bits).astype(bool) if bits else np.zeros(0, bool)


def _answer(flags: np.ndarray) -> bytes:
    return len(flags).to_bytes(4, "little") + np.packbits(flags).tobytes()


class _Plan:
    """What the passes share: sizes that follow from the number of windows."""

    def __init__(self, windows: int, window: int):
        self.window = window
        number = max(1, windows).bit_length()
        self.bits = min(60, number + SPARE_BITS)
        self.range_bits = range_bits(windows)

    def sketched(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct entries of a block, each window's entry, and how many windows each entry has."""
        entries = block.digests(0, block.places) >> np.uint64(64 - self.bits)
        return np.unique(entries, return_inverse=True, return_counts=True)

    def suspects(self, block: Block, reply: list | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Places of windows estimated repeated; their sorted distinct digests, each place's digest, and counts."""
        _, inverse, counts = self.sketched(block)
        places = block.places[(_ordered(reply) | (counts > 1))[inverse]]
        return places, *_distinct(block.digests(0, places), block.digests(1, places) >> np.uint64(32))


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct digests (a, b), the place of each input among them, and how often each occurs."""
    order = np.lexsort((b, a))
    x, y = a[order], b[order]
    new = np.ones(len(order), bool)
    new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    out = np.empty(int(new.sum()), [("a", "<u8"), ("b", "<u4")])
    out["a"], out["b"] = x[new], y[new]
    inverse = np.empty(len(order), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return out, inverse, np.diff(np.append(np.flatnonzero(new), len(order)))


def _merge_sketches(table: pa.Table) -> pa.Table:
    """Merge the sparse sketches of one range and answer each block which entries are estimated twice or more.

    A row of the sketch sums what all blocks add to its cells; an entry's estimate is the
    least of its cells. Entries that meet in a cell can only raise it.
    """
    parts = [np.cumsum(decode_segment(p).astype(np.uint64), dtype=np.uint64) for p in table.column("payload").to_pylist()]
    entries = np.concatenate(parts)
    width = max(64, CELLS * len(entries))
    repeated = np.ones(len(entries), bool)
    for row in range(DEPTH):
        cells = (_mix(entries * _ODD[row] + np.uint64(row)) % np.uint64(width)).astype(np.int64)
        repeated &= np.bincount(cells, minlength=width)[cells] > 1
    return _replies(table, np.split(repeated, np.cumsum([len(p) for p in parts])[:-1]))


def _count_digests(table: pa.Table) -> pa.Table:
    """Count the digests of one range exactly and answer each block which are in two blocks or more."""
    unpack = zstandard.ZstdDecompressor()
    parts = [_joined(unpack.decompress(p, max_output_size=1 << 62)) for p in table.column("payload").to_pylist()]
    _, inverse, counts = _distinct(np.concatenate([p["a"] for p in parts]), np.concatenate([p["b"] for p in parts]))
    flags = counts[inverse] > 1
    ends = np.cumsum([len(p) for p in parts])
    return _replies(table, np.split(flags, ends[:-1]))


def _split(values: np.ndarray) -> bytes:
    """Bytes of digests, transposed: the leading bytes of sorted digests compress well."""
    return np.ascontiguousarray(np.concatenate((values["a"].astype(">u8").view(np.uint8).reshape(-1, 8), values["b"].astype(">u4").view(np.uint8).reshape(-1, 4)), axis=1).T).tobytes()


def _joined(data: bytes) -> np.ndarray:
    rows = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(12, -1).T)
    out = np.empty(len(rows), [("a", "<u8"), ("b", "<u4")])
    out["a"] = np.ascontiguousarray(rows[:, :8]).view(">u8")[:, 0]
    out["b"] = np.ascontiguousarray(rows[:, 8:]).view(">u4")[:, 0]
    return out


def _replies(table: pa.Table, flags: list[np.ndarray]) -> pa.Table:
    return pa.table([table.column("block"), table.column("range"), pa.array([_answer(f) for f in flags], pa.binary())], names=["block", "range", "bits"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one space) of each document.

    Words are `[^\\x20\\x09-\\x0D]+`, unchanged; a word goes if a window of WINDOW words of
    its document that covers it starts anywhere else too, in the same document or another;
    windows are judged on the input. Null texts have no words; texts shorter than a window
    lose none. Equal or null ids stay rows of their own; repeated rows repeat each other's
    windows. Other columns are not read; an empty table gives no rows.
    """
    work = Workspace(docs.sparkSession, "substring")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    blocks = blocks_of(picked, WINDOW, work, "textloom_blocks")
    plan = _Plan(blocks.agg(F.sum("n_windows")).first()[0] or 0, WINDOW)

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, texts, *_ in opened(batches):
            entries, *_ = plan.sketched(Block(texts, plan.window))
            yield sent(key, [(r, encode_segment(gaps(entries[s], plan.bits, plan.range_bits))) for r, s in ranges(entries, plan.bits, plan.range_bits)])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for key, texts, _, reply in opened(batches):
            _, distinct, *_ = plan.suspects(Block(texts, plan.window), reply)
            yield sent(key, [(r, squeeze.compress(_split(distinct[s]))) for r, s in ranges(distinct["a"], 64, plan.range_bits)])

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, texts, ids, reply, final in opened(batches):
            block = Block(texts, plan.window)
            places, _, inverse, counts = plan.suspects(block, reply)
            repeated = places[(_ordered(final) | (counts > 1))[inverse]]
            yield _cleaned(block, ids, repeated)

    first = exchange(blocks, sketches, _merge_sketches, work, "estimates")
    joined = blocks.join(first.hint("shuffle_hash"), "block", "left")
    second = exchange(joined, digests, _count_digests, work, "repeats")
    everything = joined.join(second.withColumnRenamed("reply", "final").hint("shuffle_hash"), "block", "left")
    return everything.select("block", "doc_ids", "lengths", "payload", "reply", "final").mapInArrow(kept, "doc_id long, n_words long, n_removed long, kept string")


def _cleaned(block: Block, ids: list, repeated: np.ndarray) -> pa.RecordBatch:
    n = int(block.counts.sum())
    steps = np.zeros(n + 1, np.int32)
    np.add.at(steps, repeated, 1)
    np.add.at(steps, repeated + block.window, -1)
    gone = np.cumsum(steps[:n]) > 0
    ends = np.cumsum(block.counts)
    before = np.concatenate(([0], np.cumsum(gone)))
    removed = before[ends] - before[ends - block.counts]
    stays = (~gone).tolist()
    texts = [
        b" ".join(compress(words, stays[end - len(words) : end]) if r else words).decode()
        for words, end, r in zip(block.words, ends.tolist(), removed.tolist())
    ]
    columns = (pa.array(ids, pa.int64()), pa.array(block.counts), pa.array(removed.astype(np.int64)), pa.array(texts, pa.string()))
    return pa.RecordBatch.from_arrays(list(columns), names=["doc_id", "n_words", "n_removed", "kept"])

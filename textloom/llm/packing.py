"""Best-fit packing of token sequences by exact-complement hashing over the length histogram."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.common import KEY_STRIDE, row_keys
from textloom.llm.encoding import encoder
from textloom.operators.ranking import buckets_for, ranked
from textloom.session import Workspace

CAPACITY = 4096
_PIECES = "row_key long, doc_id long, piece int, start long, length long, ids binary"


def encode_pieces(
    docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Encode every text, append end_id, and cut what is longer than capacity into pieces.

    One row a piece: row_key (unique to its document's row), doc_id, piece, start, length
    and ids (uint32 little-endian). Null and empty texts are one piece with the end id;
    equal ids and repeated rows stay apart by row_key; null ids stay null. Other columns
    are not read; an empty table gives no rows.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, taken = encoder(vocabulary).ids, 0
        tail = np.array([end_id], "<u4")
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                out = [[], [], [], [], [], []]
                for key, doc, text in zip(row_keys(taken, some.num_rows).tolist(), some.column(0).to_pylist(), some.column(1).to_pylist()):
                    ids = np.concatenate((encode(text).astype("<u4"), tail))
                    for n, start in enumerate(range(0, len(ids), capacity)):
                        piece = ids[start : start + capacity]
                        for column, value in zip(out, (key, doc, n, start, len(piece), piece.tobytes())):
                            column.append(value)
                taken += some.num_rows
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["row_key", "doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(pieces, _PIECES)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, tuple[int, ...]]]:
    """Sequences for a histogram of lengths: (how many, the lengths in each), using every length exactly.

    Exact complements are consumed up to triples, up to pairs, or singles only, then the
    rest goes by best fit; of these plans the one with the fewest sequences is kept, the
    one with the longest complements in a tie. (Where lengths are few, early triples can
    use up short pieces that others need.) The result depends on the histogram alone and
    its size on capacity, not on the number of texts. An empty histogram gives no sequence.
    """
    have = np.zeros(capacity + 1, np.int64)
    for length, n in counts.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"length {length} is not within 1..{capacity}")
        have[length] += n
    tried = [_planned(have.tolist(), capacity, longest) for longest in (3, 2, 1)]
    return min(tried, key=lambda made: sum(times for times, _ in made))


def _planned(have: list[int], capacity: int, longest: int) -> list[tuple[int, tuple[int, ...]]]:
    """One plan whose exact complements have at most `longest` pieces.

    Whole-capacity lengths stand alone. Then, from the longest down, the gap beside a
    length is looked up in the index of sums of the lengths still available, and the
    combination is used as often as its lengths last; each such step uses a length up, so
    there are at most as many steps as lengths. What finds no exact complement goes by best
    fit decreasing, many equal sequences at a time.
    """
    made = [(have[capacity], (capacity,))] if have[capacity] else []
    have[capacity] = 0
    sums = Sums(have, capacity, longest)
    left: dict[int, int] = {}
    for length in range(capacity - 1, 0, -1):
        while have[length]:
            have[length] -= 1
            rest = sums.of(capacity - length)
            have[length] += 1
            if rest is None:
                left[length], have[length] = have[length], 0
                break
            each = (length, *rest)
            times = min(have[x] // each.count(x) for x in set(each))
            for x in each:
                have[x] -= times
            made.append((times, each))
    return made + _best_fit(left, capacity)


class Sums:
    """Hash index of the sums of one, two and three available lengths.

    A single sum is looked up in the counts themselves. A pair sum's entry is its larger
    length, the largest that counts allow; counts only fall, so an entry only moves on, and
    all look-ups together pass each pair of lengths once. A triple sum is its largest length
    and the entry of the rest. A count that a look-up has lent out for the moment does not
    move an entry.
    """

    def __init__(self, have: list[int], capacity: int, longest: int):
        self.have, self.longest = have, longest
        self.pairs = list(range(-1, capacity - 1))  # by sum: its largest candidate, sum - 1
        self.lengths = [x for x in range(capacity, 0, -1) if have[x]]

    def of(self, gap: int) -> tuple[int, ...] | None:
        """Up to `longest` available lengths that sum to gap, the fewest and largest first."""
        if self.longest and self.have[gap]:
            return (gap,)
        pair = self._pair(gap, gap - 1) if self.longest > 1 else None
        if pair or self.longest < 3:
            return pair
        self.lengths = [x for x in self.lengths if self.have[x]]
        for a in self.lengths:
            if 3 * a < gap:
                break
            if a > gap - 2:
                continue
            self.have[a] -= 1
            pair = self._pair(gap - a, a, a)
            self.have[a] += 1
            if pair:
                return (a, *pair)
        return None

    def _pair(self, total: int, most: int, lent: int = 0) -> tuple[int, int] | None:
        """Two available lengths of at most `most` that sum to total, the larger first."""
        have, low, x = self.have, (total + 1) // 2, self.pairs[total]
        while x >= low and not ((have[x] or x == lent) and (have[total - x] or total - x == lent)):
            x -= 1
        self.pairs[total] = x
        for x in range(min(x, most), low - 1, -1):
            if have[x] and have[total - x] and (2 * x != total or have[x] > 1):
                return x, total - x
        return None


def _best_fit(left: dict[int, int], capacity: int) -> list[tuple[int, tuple[int, ...]]]:
    """Best fit decreasing over equal items and equal open sequences at once."""
    open_: dict[int, list[tuple[int, tuple[int, ...]]]] = {}
    for length in sorted(left, reverse=True):
        n = left[length]
        while n:
            gap = min((g for g in open_ if g >= length), default=None)
            if gap is None:
                each = min(capacity // length, n)
                times = n // each
                open_.setdefault(capacity - each * length, []).append((times, (length,) * each))
                n -= times * each
                continue
            times, held = open_[gap].pop()
            if not open_[gap]:
                del open_[gap]
            used = min(times, n)
            if times > used:
                open_.setdefault(gap, []).append((times - used, held))
            open_.setdefault(gap - length, []).append((used, (*held, length)))
            n -= used
    return [x for _, held in sorted(open_.items()) for x in held]


def assign(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to written pieces (row_key, piece, length and any other columns).

    Only the histogram of lengths (capacity numbers at most) reaches the driver. Pieces of
    one length are numbered without gaps, in buckets so that a length that a third of all
    pieces share is no single task's; the number says which sequence of the plan a piece
    joins. pieces is read twice and must be a written table.
    """
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    keys, bases, places = [], [], []
    taken: dict[int, int] = {}
    base = 0
    for times, lengths in plan(counts, capacity):
        at = 0
        for length in lengths:
            first = taken.get(length, 0)
            keys.append(length * KEY_STRIDE + first)
            bases.append(base - first)
            places.append(at)
            taken[length] = first + times
            at += length
        base += times
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    index = [np.array(x, np.int64)[order] for x in (keys, bases, places)]
    columns = pieces.columns
    bucketed = pieces.withColumn("_bucket", F.pmod(F.xxhash64("row_key", "piece"), F.lit(buckets_for(sum(counts.values())))).cast("int"))
    numbered = ranked(bucketed, ["length"], "_bucket", ["row_key", "piece"], "_rank")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin, first, place = index
        for batch in batches:
            rank = batch.column("_rank").to_numpy()
            found = np.searchsorted(begin, batch.column("length").to_numpy() * KEY_STRIDE + rank, "right") - 1
            rows = [batch.column(c) for c in columns] + [pa.array(first[found] + rank), pa.array(place[found])]
            yield pa.RecordBatch.from_arrays(rows, names=[*columns, "sequence_id", "offset"])

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return numbered.select(*columns, "_rank").mapInArrow(placed, schema)


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents with their ids, sequence_id and offset; see encode_pieces and assign."""
    work = Workspace(docs.sparkSession, "packing")
    return assign(work.keep(encode_pieces(docs, vocabulary, end_id, capacity), "pieces", compression="zstd"), capacity)

"""Toxicity by nearest labelled examples: exact TF-IDF cosine over an inverted index.

The labelled examples are a bounded sample (EXAMPLES rows at most, chosen by a hash of
the id). Terms are all words of the examples. None is cut; a term's TF-IDF weight is
scaled by how surely its smoothed log-odds tell the labels apart, since unscaled a few
telling words drown in hundreds of ordinary ones. Document frequencies come from all
documents. A text's score is its nearest examples' distance-weighted vote, mapped to a
probability by an isotonic fit to votes that leave each example itself out.
"""

from __future__ import annotations

import gc
import math
import threading
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from textloom.llm.common import free_name, text_bytes
from textloom.session import Workspace

EXAMPLES = 20_000
NEIGHBOURS = 25
BLOCK = 64
#: Terms in most examples, whose weights are multiplied as a matrix; texts compared at once; centres that order the examples.
DENSE, TOGETHER, GATHERED = 768, 256, 160
#: Of them, those by which examples are told alike.
GATHERED_BY = 256
#: How many blocks are opened for a first k-th cosine, and for a better one.
FIRST = (24,)
#: The share of labels that smooth a term's odds, the squared deviation that scales its weight to about a half, and the least one counted.
SMOOTH, HALF, LEAST = 5.0, 30.0, 0.1
_OTHERS = r"[^\p{L}]+"
#: Rows and bytes of text that are cut into words at once, about.
ROWS, TEXT = 2048, 8 << 20
#: Examples whose rows are weighed at once; seconds that an idle worker keeps the model.
PART, IDLE = 1024, 1.0


def words_of(texts: pa.Array) -> pa.Array:
    """The terms of each text: its runs of letters in lower case (and empty strings at its ends); null has none."""
    return pc.split_pattern_regex(pc.utf8_lower(texts.cast(pa.large_string()).fill_null("")), _OTHERS)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most ROWS rows and, but for single longer texts, TEXT bytes of a text column."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + TEXT, "right"))
        upto = min(max(upto, at + 1), at + ROWS)
        yield batch.slice(at, upto - at)
        at = upto


def distinct(row: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct terms (below width), ascending, with their rows and how often each occurs."""
    key = np.sort(row * width + term)
    at = np.flatnonzero(np.diff(key, prepend=-1))
    return key[at] // width, key[at] % width, np.diff(at, append=len(key))


def held_out(id_col: str = "doc_id"):
    """Rows whose label is never learned from."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0


def examples(labels: DataFrame, most: int = EXAMPLES, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """doc_id and toxic of the labelled rows to learn from: `most` rows at most, by a hash of the id.

    Rows with a null id or label do not count; a repeated id counts once, with its largest label.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out("doc_id")).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


class Blocks:
    """Block-max inverted index over the examples, in single precision.

    Examples are put in an order that brings alike ones together and cut into blocks of
    BLOCK. The postings of the DENSE most frequent terms lie as a matrix, with each term's
    largest weight in each block; the other terms keep ordinary postings, which are short.
    """

    def __init__(self, starts: np.ndarray, term: np.ndarray, value: np.ndarray, terms: int):
        n = len(starts) - 1
        have = np.bincount(term, minlength=terms)
        most = np.argsort(-have, kind="stable")[:DENSE]
        self.column = np.full(terms, -1, np.int32)
        self.column[most] = np.arange(len(most))

        def common(cut: slice, upto: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            """Rows, columns and weights of the frequent terms, of the first `upto` of them, in some examples."""
            column = self.column[term[starts[cut.start] : starts[cut.stop]]]
            some = np.flatnonzero((column >= 0) & (column < upto))
            row = np.repeat(np.arange(cut.start, cut.stop), np.diff(starts[cut.start : cut.stop + 1]))
            return row[some], column[some], value[starts[cut.start] : starts[cut.stop]][some]

        parts = [slice(at, min(at + PART, n)) for at in range(0, n, PART)]
        held = np.zeros((n, min(GATHERED_BY, len(most))), np.float32)
        for cut in parts:
            row, column, weight = common(cut, held.shape[1])
            held[row, column] = weight
        self.centres, self.order = self._together(held)
        del held
        self.place = np.empty(n, np.int32)
        self.place[self.order] = np.arange(n)
        self.blocks = -(-n // BLOCK)
        self.dense = np.zeros((self.blocks, len(most), BLOCK), np.float32)
        for cut in parts:
            row, column, weight = common(cut, len(most))
            at = self.place[row]
            self.dense[at // BLOCK, column, at % BLOCK] = weight
        self.most = np.ascontiguousarray(self.dense.max(axis=2).T) if n else np.zeros((len(most), 0), np.float32)
        rare = np.concatenate([starts[cut.start] + np.flatnonzero(self.column[term[starts[cut.start] : starts[cut.stop]]] < 0) for cut in parts] or [[]]).astype(np.int32)
        rare = rare[np.argsort(term[rare], kind="stable")]
        self.first = np.concatenate(([0], np.cumsum(np.where(self.column < 0, have, 0))))
        self.ids, self.weights = self.place[np.searchsorted(starts, rare, "right") - 1], value[rare]

    @staticmethod
    def _together(held: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """GATHERED centres of the rows, and an order that keeps alike rows together: by the nearest centre, then by likeness to it."""
        n = len(held)
        if n <= BLOCK:
            return held[:1], np.arange(n)
        centres = held[np.linspace(0, n - 1, GATHERED).astype(int)]
        for _ in range(4):
            like = held @ centres.T
            nearest = like.argmax(axis=1)
            sums = np.zeros_like(centres)
            for c in range(len(centres)):
                sums[c] = held[nearest == c].sum(axis=0)
            length = np.linalg.norm(sums, axis=1, keepdims=True)
            centres = np.where(length > 0, sums / np.maximum(length, 1e-30), centres)
        like = held @ centres.T
        nearest = like.argmax(axis=1)
        return centres, np.lexsort((-like[np.arange(n), nearest], nearest))

    def candidates(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None) -> list[np.ndarray]:
        """For each vector the places of all examples that may be among its k nearest.

        Alike vectors, which open the same blocks, are taken together.
        """
        if not self.blocks:
            return [np.zeros(0, np.int64) for _ in vectors]
        asked = np.zeros((len(vectors), self.dense.shape[1]), np.float32)
        rare = []
        for i, (t, w) in enumerate(vectors):
            at = self.column[t]
            common = at >= 0
            asked[i, at[common]] = w[common]
            rare.append((t[~common], w[~common]))
        order = np.argsort((asked[:, : self.centres.shape[1]] @ self.centres.T).argmax(axis=1), kind="stable")
        out: list[np.ndarray] = [self.order] * len(vectors)
        for at in range(0, len(order), TOGETHER):
            some = order[at : at + TOGETHER]
            found = self._candidates(asked[some], [rare[i] for i in some], k, None if leave is None else self.place[[leave[i] for i in some]])
            for i, places in zip(some, found):
                out[i] = places
        return out

    def _candidates(self, asked: np.ndarray, rare: list[tuple[np.ndarray, np.ndarray]], k: int, leave: np.ndarray | None) -> list[np.ndarray]:
        """Candidates of vectors given by their weights of the frequent terms and their rare terms.

        The rare terms' shares of every cosine are added up from their postings. A block's
        bound is the largest of these plus, over the frequent terms, the vector's weight times
        the block's largest. A vector's best blocks by bound are opened first and give a k-th
        cosine; at last every block whose bound reaches it is. So no near example is missed.
        """
        m, size = len(asked), self.blocks * BLOCK
        made = np.zeros((m, self.blocks, BLOCK), np.float32)
        for i, (t, w) in enumerate(rare):
            first = self.first[t]
            each = self.first[t + 1] - first
            total = int(each.sum())
            if total:
                at = np.repeat(first - np.cumsum(each) + each, each) + np.arange(total)
                made[i] = np.bincount(self.ids[at], self.weights[at] * np.repeat(w, each), size).reshape(self.blocks, BLOCK)
        every = np.arange(m)
        without = None if leave is None else np.divmod(leave, BLOCK)
        bound = asked @ self.most + made.max(axis=2)
        best = np.argsort(-bound, axis=1, kind="stable")
        kth, opened = np.zeros(m, np.float32), np.zeros(bound.shape, bool)
        for share in (*FIRST, self.blocks):
            wanted = (bound >= kth[:, None] - 1e-5) & ~opened
            if share < self.blocks:
                some = np.zeros(bound.shape, bool)
                np.put_along_axis(some, best[:, :share], True, axis=1)
                wanted &= some
            for b in np.flatnonzero(wanted.any(axis=0)):
                rows = np.flatnonzero(wanted[:, b])
                made[rows, b] += asked[rows] @ self.dense[b]
            opened |= wanted
            if without is not None:
                made[every, *without] = 0
            if share < self.blocks and share * BLOCK > k:
                seen = made[every[:, None], best[:, :share]].reshape(m, -1)  # what is not opened counts too low
                kth = np.partition(seen, seen.shape[1] - k, axis=1)[:, seen.shape[1] - k]
        found = []
        for b in np.flatnonzero(opened.any(axis=0)):
            rows = np.flatnonzero(opened[:, b])
            values = made[rows, b]
            row, at = np.nonzero((values > 0) & (values >= kth[rows, None] - 1e-5))
            found.append((rows[row], at + b * BLOCK, values[row, at]))
        row, place, value = (np.concatenate(x) for x in zip(*found))
        by = np.argsort(row, kind="stable")
        place, value, cuts, out = place[by], value[by], np.searchsorted(row[by], np.arange(m + 1)), []
        for a, b in zip(cuts[:-1], cuts[1:]):
            mine = value[a:b]
            out.append(self.order[place[a:b] if b - a <= k else place[a:b][mine >= np.partition(mine, b - a - k)[b - a - k] - 1e-5]])
        return out


@dataclass
class Model:
    """All that scoring needs: the examples as rows of (term, times it occurs) from starts[i] to starts[i + 1]."""

    terms: pa.Array
    weight: np.ndarray
    starts: np.ndarray
    term: np.ndarray
    times: np.ndarray
    toxic: np.ndarray
    ids: np.ndarray
    bare: tuple[int, int]
    steps: tuple[np.ndarray, np.ndarray] | None = None
    _ready: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        """Compressed, since every machine keeps a copy on disk: terms as lengths and bytes, rows as steps between ascending terms."""
        state = {k: v for k, v in self.__dict__.items() if k not in ("_ready", "terms", "term", "times")}
        text, ends = text_bytes(self.terms)
        steps = np.empty(len(self.term), np.int32)
        steps[:1] = self.term[:1]
        np.subtract(self.term[1:], self.term[:-1], out=steps[1:])
        parts = (text, np.diff(ends).astype(np.int32), steps.view(np.uint8).reshape(-1, 4).T, self.times)
        return state | {"_packed": [zlib.compress(np.ascontiguousarray(x), 1) for x in parts]}

    def __setstate__(self, state):
        text, sizes, planes, times = map(zlib.decompress, state.pop("_packed"))
        ends = np.concatenate(([0], np.cumsum(np.frombuffer(sizes, np.int32), dtype=np.int64)))
        terms = pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(text)])
        self.__dict__ |= state | {"_ready": {"copy": True}, "terms": terms}
        steps = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.int32)[:, 0] if planes else np.zeros(0, np.int32)
        self.term, self.times = np.cumsum(steps, dtype=np.int32, out=steps), np.frombuffer(times, np.int32)

    def shared(self, spark: SparkSession):
        """The one broadcast of the examples, without the calibration `steps`, until released."""
        app, held = self._ready.get("shared", (None, None))
        if app != spark.sparkContext.applicationId:
            held = spark.sparkContext.broadcast(replace(self, steps=None, _ready={}))
            self._ready["shared"] = spark.sparkContext.applicationId, held
        return held

    def release(self) -> None:
        """Remove that broadcast from all machines, once nothing lazy still scores."""
        _, held = self._ready.pop("shared", (None, None))
        if held is not None:
            held.destroy()

    def counts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The terms of each text, ascending, how often each occurs, and where each text's terms start (one more at the end)."""
        words = words_of(texts)
        found = pc.index_in(words.flatten(), value_set=self.terms).fill_null(-1).to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
        row, term, times = distinct(row[found >= 0], found[found >= 0], max(1, len(self.terms)))
        return term, times, np.searchsorted(row, np.arange(len(texts) + 1))

    def vectors(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each text's terms and their weights, of length one; empty if it has none of them."""
        return self.weighed(*self.counts(texts))

    def weighed(self, term: np.ndarray, times: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        made = (1 + np.log(times)) * self.weight[term]
        square = np.concatenate(([0], np.cumsum(made * made)))
        length = np.sqrt(np.maximum(np.diff(square[starts]), 1e-300))
        made = (made / np.repeat(length, np.diff(starts))).astype(np.float32)
        return [(term[a:b], made[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]

    @property
    def value(self) -> np.ndarray:
        """The weights of the examples' rows, made a part at a time."""
        if "value" not in self._ready:
            out, rows = np.empty(len(self.term), np.float32), len(self.starts) - 1
            for at in range(0, rows, PART):
                starts = self.starts[at : min(at + PART, rows) + 1]
                cut = slice(starts[0], starts[-1])
                made = (1 + np.log(self.times[cut])) * self.weight[self.term[cut]]
                length = np.sqrt(np.add.reduceat(made * made, starts[:-1] - starts[0]))
                out[cut] = made / np.repeat(length, np.diff(starts))
            self._ready["value"] = out
        return self._ready["value"]

    @property
    def index(self) -> "Blocks":
        if "index" not in self._ready:
            value = self.value
            if "copy" in self._ready:  # an executor's, which needs the times no more
                self.times = None
            self._ready["index"] = Blocks(self.starts, self.term, value, len(self.terms))
        return self._ready["index"]

    def nearest(self, vectors: list[tuple[np.ndarray, np.ndarray]], k: int, leave: list[int] | None = None) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each vector the places and cosines of its k nearest examples, all ties at the k-th included.

        The block-max index leaves the examples that may be among the k; these are compared
        whole, in double precision. `leave` names an example to take out. Examples that share
        no term are not near.
        """
        whole, out = np.zeros(len(self.terms), np.float32), []
        for (t, w), places in zip(vectors, self.index.candidates(vectors, k, leave)):
            whole[t] = w
            size = self.starts[places + 1] - self.starts[places]
            at = np.repeat(self.starts[places] - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            cosines = np.bincount(np.repeat(np.arange(len(places)), size), np.multiply(whole[self.term[at]], self.value[at], dtype=np.float64), len(places))
            whole[t] = 0
            if len(places) > k:
                keep = cosines >= np.partition(cosines, len(places) - k)[len(places) - k] - 1e-12
                places, cosines = places[keep], cosines[keep]
            out.append((places, cosines))
        return out

    def bare_vote(self) -> float:
        """The vote on a text that shares no term with any example: that of the examples without terms."""
        prior = (int(self.toxic.sum()) + self.bare[1] + 1) / (len(self.toxic) + self.bare[0] + 2)
        return (self.bare[1] + prior) / (self.bare[0] + 1)

    def votes(self, vectors: list[tuple[np.ndarray, np.ndarray]], leave: list[int] | None = None) -> list[float | None]:
        """Distance-weighted share of toxic examples among the nearest of each, drawn slightly to the share of all; None without any near."""
        toxic, all_ = int(self.toxic.sum()) + self.bare[1], len(self.toxic) + self.bare[0]
        prior, out = (toxic + 1) / (all_ + 2), []
        for places, cosines in self.nearest(vectors, NEIGHBOURS, leave):
            weight = 1 / (1.05 - np.minimum(cosines, 1.0))
            out.append(float(((self.toxic[places] * weight).sum() + prior) / (weight.sum() + 1)) if len(places) else None)
        return out

    def scores(self, vectors: list[tuple[np.ndarray, np.ndarray]]) -> list[float]:
        """The calibrated vote on each; without any near example the share of toxic ones among such examples."""
        votes, bare = self.votes(vectors), self.bare_vote()
        mapped = votes if self.steps is None or not len(self.steps[0]) else np.interp([v or 0.0 for v in votes], *self.steps).tolist()
        return [bare if v is None else m for v, m in zip(votes, mapped)]

    def evidence(self, vectors: list[tuple[np.ndarray, np.ndarray]], most: int = 3) -> list[list[dict]]:
        """The nearest examples of each: id, cosine and label."""
        out = []
        for places, cosines in self.nearest(vectors, most):
            order = np.lexsort((self.ids[places], -cosines))[:most]
            out.append([{"doc_id": int(self.ids[places[i]]), "cosine": float(cosines[i]), "toxic": int(self.toxic[places[i]])} for i in order])
        return out


def telling(n: np.ndarray, t: np.ndarray, all_: int, bad: int) -> np.ndarray:
    """How surely a term in n examples, t of them toxic, tells the labels apart: 0 to 1, never 0.

    The smoothed log-odds over their deviation, squared, on a scale where HALF is about a half.
    """
    share = bad / all_
    a, b = t + SMOOTH * share, n - t + SMOOTH * (1 - share)
    odds = np.log(a / b) - math.log(share / (1 - share))
    square = odds**2 / (1 / a + 1 / b)
    return (LEAST + square) / (HALF + square)


def isotonic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-decreasing least-squares fit: the x and value of each level's ends."""
    order = np.argsort(x, kind="stable")
    levels: list[list[float]] = []
    for at, value, weight in zip(x[order], y[order], n[order]):
        levels.append([value, weight, at, at])
        while len(levels) > 1 and levels[-2][0] >= levels[-1][0]:
            b, a = levels.pop(), levels.pop()
            weight = a[1] + b[1]
            levels.append([(a[0] * a[1] + b[0] * b[1]) / weight, weight, a[2], b[3]])
    return np.array([e for v in levels for e in v[2:]]), np.array([v[0] for v in levels for _ in range(2)])


def centred(ends: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The middles of the levels of isotonic(), to be joined by straight lines, so that votes within a level get scores of their own."""
    middle, at = np.unique((ends[::2] + ends[1::2]) / 2, return_inverse=True)
    return middle, np.bincount(at, values[::2]) / np.bincount(at)


def fit(docs: DataFrame, labels: DataFrame, most: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn from the labelled examples among docs; document frequencies are those of all docs.

    Driver memory is bounded by `most` examples' terms. Without examples of both labels
    every score is the share of toxic ones (0.5 without any).
    """
    model, counted = fit_counted(docs, labels, most=most, id_col=id_col, text_col=text_col)
    Workspace(docs.sparkSession, "toxicity").drop(counted)
    return model


def _packed(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """Rows of 32-bit numbers as binary values."""
    return pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64) * 4), pa.py_buffer(values.astype("<i4"))]).cast(pa.binary())


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, at = text_bytes(column)
    return data.view("<i4"), at // 4


def _joined(column: pa.ChunkedArray) -> np.ndarray:
    """All numbers of a column of _packed() rows."""
    out, at = np.empty(int(pc.sum(pc.binary_length(column)).as_py() or 0) // 4, np.int32), 0
    for chunk in column.chunks:
        some = text_bytes(chunk)[0].view("<i4")
        out[at : at + len(some)] = some
        at += len(some)
    return out


def fit_counted(
    docs: DataFrame, labels: DataFrame, keep: str | None = None, most: int = EXAMPLES, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[Model, DataFrame]:
    """The model of fit(), and the terms of every text as it needs them: doc_id, row (the column `keep`), t and n.

    Texts are cut into words once; frequencies, examples and score_counted() all read this
    written table.
    """
    work = Workspace(docs.sparkSession, "toxicity")
    learned = work.keep(examples(labels, most), "examples")
    chosen = F.broadcast(learned)  # `most` rows of two numbers
    row = (F.col(f"`{keep}`") if keep else F.lit(None)).cast("long").alias("row")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), row, F.col(text_col).cast("string").alias("text"))
    known = texts.select("doc_id", "text").join(chosen, "doc_id").select("doc_id", "text", "toxic")

    def by_term(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 1):
                words = words_of(some.column(1))
                coded = words.flatten().dictionary_encode()
                width = max(1, len(coded.dictionary))
                row, term, _ = distinct(np.repeat(np.arange(some.num_rows), pc.list_value_length(words).to_numpy()), coded.indices.to_numpy().astype(np.int64), width)
                toxic = some.column(2).to_numpy()[row] == 1
                n, t = (np.bincount(x, minlength=width)[: len(coded.dictionary)] for x in (term, term[toxic]))
                yield pa.RecordBatch.from_arrays([coded.dictionary.cast(pa.string()), pa.array(n), pa.array(t)], names=["term", "n", "t"])

    total, bad = known.agg(F.count("*"), F.sum("toxic")).first()
    good, bad = (total or 0) - (bad or 0), bad or 0
    terms = pa.array([], pa.large_string())
    told = np.zeros(0)
    if good and bad:
        found = known.mapInArrow(by_term, "term string, n long, t long").where("term <> ''").groupBy("term").agg(F.sum("n").alias("n"), F.sum("t").alias("t")).toArrow()
        found = found.take(pc.sort_indices(found["term"]))
        terms = found["term"].cast(pa.large_string()).combine_chunks()
        told = telling(found["n"].to_numpy(), found["t"].to_numpy(), total, bad)
        del found

    none = np.zeros(0, np.int32)
    model = Model(terms, np.ones(len(terms)), np.zeros(1, np.int64), none, none, none, none, (0, 0))

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, 2):
                term, times, starts = model.counts(some.column(2))
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), _packed(term, starts), _packed(times, starts)], names=["doc_id", "row", "t", "n"])

    counted = work.keep(texts.mapInArrow(counts, "doc_id long, row long, t binary, n binary"), "counted", compression="zstd")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(model.terms) + 1, np.int64)
        for batch in batches:
            np.add.at(n, _unpacked(batch.column(0))[0], 1)
            n[-1] += batch.num_rows
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], names=["term", "n"])

    df = np.zeros(len(terms) + 1)
    if len(terms):
        made = counted.select("t").mapInArrow(frequencies, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
        df[made["term"].to_numpy()] = made["n"].to_numpy()
    model.weight = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1) * told
    held = counted.join(chosen, "doc_id").select("doc_id", "toxic", "t", "n").toArrow()
    order = pc.sort_indices(held, [("doc_id", "ascending"), ("toxic", "ascending")])
    for at, name in enumerate(held.column_names):  # one column twice at a time
        held = held.set_column(at, name, held[name].take(order))
    ids, toxic = held["doc_id"].to_numpy(), held["toxic"].to_numpy().astype(np.int32)
    size = pc.binary_length(held["t"]).to_numpy().astype(np.int64) // 4
    model.bare = int((size == 0).sum()), int(toxic[size == 0].sum())
    model.ids, model.toxic, model.starts = ids[size > 0], toxic[size > 0], np.concatenate(([0], np.cumsum(size[size > 0])))
    model.term = _joined(held["t"])
    held = held.drop_columns(["t"])
    model.times = _joined(held["n"])
    del held
    pa.default_memory_pool().release_unused()
    work.drop(learned)
    if good and bad:
        # each example's vote without itself, by the executors
        shared = model.shared(docs.sparkSession)

        def left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            with _Lent(shared) as mine:
                for batch in batches:
                    for at in range(0, batch.num_rows, ROWS):
                        places = batch.column(0).slice(at, ROWS).to_pylist()
                        cuts = [slice(mine.starts[i], mine.starts[i + 1]) for i in places]
                        found = mine.votes([(mine.term[c], mine.value[c]) for c in cuts], places)
                        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(found, pa.float64())], names=["place", "vote"])

        voted = docs.sparkSession.range(len(model.toxic)).mapInArrow(left_out, "place long, vote double").toArrow()
        x = np.full(len(model.toxic), np.nan)
        x[voted["place"].to_numpy()] = voted["vote"].to_numpy()
        near = ~np.isnan(x)
        model.steps = centred(*isotonic(x[near], model.toxic[near].astype(float), np.ones(int(near.sum()))))
    return model, counted


_TIMERS: dict[int, threading.Timer] = {}


class _Lent:
    """A broadcast model for the time of a task; a worker that gets no other task for IDLE seconds lets it go.

    Else the model would stay in every idle Python worker for as long as the job runs.
    """

    def __init__(self, shared):
        self.shared = shared

    def __enter__(self) -> Model:
        timer = _TIMERS.pop(id(self.shared), None)
        if timer:
            timer.cancel()
        return self.shared.value

    def __exit__(self, *_) -> None:
        timer = _TIMERS[id(self.shared)] = threading.Timer(IDLE, _let_go, (self.shared,))
        timer.daemon = True
        timer.start()


def _let_go(shared) -> None:
    shared.__dict__.pop("_value", None)
    gc.collect()
    pa.default_memory_pool().release_unused()


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score", evidence: str | None = None) -> DataFrame:
    """docs with the score of each text (0 to 1, higher: toxic likelier) and, if named, its evidence column.

    Only the text is an input. Null and empty texts score like examples without any term.
    Rows stay as they are and where they are; a column named `out` (in any case) is replaced.
    An empty table gives an empty one.
    """
    kept = [c for c in docs.columns if c.lower() not in (out.lower(), (evidence or out).lower())]
    columns = [F.col(f"`{c}`") for c in kept]
    schema = docs.select(*columns).schema.add(out, "double")
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("cosine", pa.float64()), ("toxic", pa.int32())]))
    if evidence:
        schema = schema.add(evidence, ArrayType(StructType().add("doc_id", "long").add("cosine", "double").add("toxic", "integer")))
    shared, steps = model.shared(docs.sparkSession), model.steps

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Lent(shared) as mine:
            mine.steps = steps
            for whole in batches:
                for batch in slices(whole, 0):
                    made = mine.vectors(batch.column(0))
                    columns = [*batch.columns[1:], pa.array(mine.scores(made), pa.float64())]
                    if evidence:
                        columns.append(pa.array(mine.evidence(made), kind))
                    yield pa.RecordBatch.from_arrays(columns, names=[*kept, out, *([evidence] if evidence else [])])

    return docs.select(F.col(text_col).cast("string").alias(free_name(docs, "_text")), *columns).mapInArrow(scored, schema)


def score_counted(counted: DataFrame, model: Model) -> DataFrame:
    """doc_id, row and score of each text of fit_counted()'s table: what score() gives, without cutting texts again."""
    shared, steps = model.shared(counted.sparkSession), model.steps

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with _Lent(shared) as mine:
            mine.steps = steps
            for whole in batches:
                for batch in (whole.slice(at, ROWS) for at in range(0, whole.num_rows, ROWS)):
                    (term, starts), (times, _) = _unpacked(batch.column(2)), _unpacked(batch.column(3))
                    found = mine.scores(mine.weighed(term, times, starts))
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], names=["doc_id", "row", "score"])

    return counted.select("doc_id", "row", "t", "n").mapInArrow(scored, "doc_id long, row long, score double")

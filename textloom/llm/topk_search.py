"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import row_keys
from textloom.session import Workspace

SCALE = 1024
K = 10
QUERY_BLOCK = 256
VECTOR_BLOCK = 1024
#: Bytes of a block at most, as 64-bit numbers; and of the vectors that one task holds beside each query block, about.
BLOCK_BYTES, GROUP_BYTES = 1 << 20, 64 << 20
BINS = 2048
_BLOCK = "block long, dim int, ids array<long>, numbers binary"


def blocks(vectors: DataFrame, size: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Vectors packed by `size` a row as integers floor(SCALE * x), the component x taken as a double.

    Vectors that are null or hold null or non-finite components, and rows without an id,
    take no part; nor do empty vectors, nor those with an integer so large that scores of such
    vectors may exceed 64 bits (its square times the vector's length beyond 2**61), which
    no score could tell. A block holds vectors of one length, BLOCK_BYTES of them at most but
    for single longer ones, as integers of the smallest of 16, 32 and 64 bits that holds all.
    """

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}
        made = 0

        def closed(dim: int) -> pa.RecordBatch:
            nonlocal made
            ids, rows = held.pop(dim)
            row = [row_keys(made, 1), [dim], [ids], [_narrow(np.array(rows)).tobytes()]]
            made += 1
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary()))], names=["block", "dim", "ids", "numbers"])

        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key is None or not vector or None in vector:
                    continue
                numbers = np.floor(SCALE * np.array(vector, np.float64))
                if not (np.abs(numbers) <= math.isqrt((1 << 61) // len(vector))).all():
                    continue
                ids, rows = held.setdefault(len(vector), ([], []))
                ids.append(key)
                rows.append(numbers.astype(np.int64))
                if len(ids) >= min(size, BLOCK_BYTES // (8 * len(vector))):
                    yield closed(len(vector))
        for dim in list(held):
            yield closed(dim)

    return vectors.select(F.col(id_col).cast("long"), F.col(vector_col).cast("array<double>")).mapInArrow(packed, _BLOCK)


def _narrow(numbers: np.ndarray) -> np.ndarray:
    low, high = numbers.min(), numbers.max()
    return numbers.astype(next(t for t in ("<i2", "<i4", "<i8") if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _matrix(numbers: bytes, dim: int, ids: np.ndarray) -> np.ndarray:
    return np.frombuffer(numbers, f"<i{len(numbers) // (dim * len(ids))}").reshape(-1, dim)


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact integer inner products; by way of doubles only where every partial sum is exact in them."""
    most = math.prod(max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (queries, vectors)) * queries.shape[1]
    if most < 1 << 53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    if most < 1 << 63:
        return queries.astype(np.int64) @ vectors.T.astype(np.int64)
    raise OverflowError("scores may exceed 64 bits")


_STATE = "q_block long, q int, low long, width long, above long, done boolean"


def search(vectors: DataFrame, is_query: str, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k highest-scoring vectors of each query: query_id, rank (from 1), vec_id, score.

    Queries are the rows for which the SQL condition holds, candidates all rows with
    another id. Ties go to the smaller vec_id; a query with fewer candidates gets them all.
    Vector blocks are dealt to groups of about GROUP_BYTES, which every query block visits:
    a task reads a group's vectors, then one query block after another, so every score is
    made once a round and no row holds more than one block. A round counts scores into
    a histogram over each query's interval, sums these over all blocks, and keeps the one
    bin that holds the k-th highest, until it is one score wide; then only scores at or
    above it are kept. A block's own k highest bound what it can add, so lower bins are not
    sent, and at the k-th value it sends its k smallest ids at most: enough for any tie.
    What a round moves is bounded by blocks and bins, however many vectors tie. Repeated ids
    are rows of their own, but no row is a candidate of its own id; an empty table, or one
    without queries, gives no rows; which vectors take no part is said at blocks().
    """
    spark = vectors.sparkSession
    work = Workspace(spark, "topk")
    given = vectors.select(id_col, vector_col, F.coalesce(F.expr(is_query), F.lit(False)).alias("_query"))
    table = work.keep(blocks(given, VECTOR_BLOCK, id_col, vector_col), "vectors")
    asked = work.keep(blocks(given.where("_query"), QUERY_BLOCK, id_col, vector_col), "queries")
    made, numbers = table.agg(F.count("*"), F.sum(F.size("ids") * F.col("dim").cast("long"))).first()
    groups = max(min(made, int(spark.conf.get("spark.sql.shuffle.partitions"))), -(-8 * (numbers or 0) // GROUP_BYTES), 1)
    table = table.withColumn("grp", F.pmod(F.xxhash64("block"), F.lit(groups)))
    bounds = table.select("dim", "ids", "numbers").mapInArrow(_longest, "dim int, norm double").groupBy("dim").agg(F.max("norm").alias("norm"))
    state = work.keep(asked.join(F.broadcast(bounds), "dim").select("block", "dim", "ids", "numbers", "norm").mapInArrow(_begin, _STATE), "state")

    def met(now: DataFrame) -> DataFrame:
        """By group and length, its vector blocks and after them each unsettled query block with its queries' intervals."""
        by = now.groupBy("q_block").agg(F.sort_array(F.collect_list(F.struct("q", "low", "width", "above", "done"))).alias("state"))
        each = asked.withColumnRenamed("block", "q_block").join(by.hint("merge"), "q_block")
        each = each.withColumn("grp", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
        rows = table.drop("block").unionByName(each, allowMissingColumns=True)
        return rows.repartition(groups, "grp").sortWithinPartitions("grp", "dim", F.col("q_block").asc_nulls_first()).select("grp", "dim", "q_block", "ids", "numbers", "state")

    while not state.where("not done").isEmpty():
        open_ = state.where("not done").select("q_block").distinct()
        bins = met(state.join(open_, "q_block")).mapInArrow(lambda it: _histograms(it, k), "q_block long, q int, bin long, n long").groupBy("q_block", "q", "bin").agg(F.sum("n").alias("n"))
        downward = Window.partitionBy("q_block", "q").orderBy(F.col("bin").desc())
        reached = bins.withColumn("sum", F.sum("n").over(downward)).join(state.hint("merge"), ["q_block", "q"])
        holds = reached.where((F.col("above") + F.col("sum") >= k) & (F.col("above") + F.col("sum") - F.col("n") < k))
        narrowed = holds.select("q_block", "q", (F.col("low") + F.col("bin") * F.col("width")).alias("l"), (F.col("above") + F.col("sum") - F.col("n")).alias("a"))
        step = F.greatest(F.lit(1), F.expr(f"width div {BINS}"))
        few = F.col("l").isNull() & ~F.col("done")  # fewer than k candidates: all of them
        after = state.join(narrowed.hint("merge"), ["q_block", "q"], "left").select(
            "q_block",
            "q",
            F.when(few, F.lit(-(1 << 62))).otherwise(F.coalesce("l", "low")).alias("low"),
            F.when(F.col("done"), F.col("width")).otherwise(step).alias("width"),
            F.coalesce("a", "above").alias("above"),
            (F.col("done") | few | (F.col("width") == 1)).alias("done"),
        )
        state = work.keep(after, "state")
    found = met(state).mapInArrow(lambda it: _candidates(it, k), "q_block long, q int, query_id long, vec_id long, score long")
    order = Window.partitionBy("q_block", "q").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for dim, ids, numbers in zip(*(c.to_pylist() for c in batch.columns)):
            norm = float(np.sqrt((_matrix(numbers, dim, ids).astype(np.float64) ** 2).sum(axis=1).max(initial=0.0)))
            yield pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([norm])], names=["dim", "norm"])


def _begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every query's first interval: no score is beyond the product of its length and the longest vector's."""
    for batch in batches:
        for block, dim, ids, numbers, norm in zip(*(c.to_pylist() for c in batch.columns)):
            far = np.ceil(np.sqrt((_matrix(numbers, dim, ids).astype(np.float64) ** 2).sum(axis=1)) * norm * (1 + 1e-9)) + 1
            if far.max(initial=0) >= 2.0**62:
                raise OverflowError("scores may exceed 64 bits")
            reach = far.astype(np.int64)
            n = len(ids)
            width = np.ones(n, np.int64)
            while (short := BINS * width.astype(np.float64) < 2 * far + 1).any():  # powers of BINS, so that bins nest exactly
                width[short] *= BINS
            columns = [pa.array([block] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(-reach), pa.array(width), pa.array([0] * n, pa.int64()), pa.array([False] * n)]
            yield pa.RecordBatch.from_arrays(columns, names=["q_block", "q", "low", "width", "above", "done"])


def _pairs(batches: Iterator[pa.RecordBatch]):
    """Of each query block with a group's vectors: its queries and their intervals, and block by block the scores, with a query's own rows masked."""
    at, held = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            grp, dim, q_block, ids, numbers, state = (c[i].as_py() if n != 3 else c[i].values.to_numpy() for n, c in enumerate(batch.columns))
            if at != (grp, dim):
                at, held = (grp, dim), []
            if q_block is None:
                held.append((ids.copy(), _matrix(numbers, dim, ids)))
                continue
            queries = _matrix(numbers, dim, ids)
            yield q_block, ids, state, ((v, scores(queries, matrix), ids[:, None] != v) for v, matrix in held)


def _histograms(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for q_block, _, state, each in _pairs(batches):
        low = np.array([s["low"] for s in state], np.int64)[:, None]
        width = np.array([s["width"] for s in state], np.int64)[:, None]
        done = np.array([s["done"] for s in state])
        places = [np.zeros(0, np.int64)]
        for _, made, other in each:
            bins = (made - low) // width
            inside = other & (bins >= 0) & (bins < BINS) & ~done[:, None]
            bins = np.where(inside, bins, -1)
            if bins.shape[1] > k:  # nothing below a block's own k-th highest can be the k-th of all
                inside &= bins >= np.partition(bins, bins.shape[1] - k, axis=1)[:, bins.shape[1] - k][:, None]
            row, column = np.nonzero(inside)
            places.append(row * np.int64(BINS) + bins[row, column])
        found, n = np.unique(np.concatenate(places), return_counts=True)
        columns = [pa.array(np.full(len(found), q_block)), pa.array((found // BINS).astype(np.int32)), pa.array(found % BINS), pa.array(n.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, names=["q_block", "q", "bin", "n"])


def _candidates(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for q_block, q_ids, state, each in _pairs(batches):
        low = np.array([s["low"] for s in state], np.int64)[:, None]
        best = [np.zeros((3, 0), np.int64)]
        for ids, made, other in each:
            row, column = np.nonzero(other & (made >= low))
            best.append(_first(np.stack((row, made[row, column], ids[column])), k))
        row, score, found = _first(np.concatenate(best, axis=1), k)
        columns = [pa.array(np.full(len(row), q_block)), pa.array(row.astype(np.int32)), pa.array(q_ids[row]), pa.array(found), pa.array(score)]
        yield pa.RecordBatch.from_arrays(columns, names=["q_block", "q", "query_id", "vec_id", "score"])


def _first(rows: np.ndarray, k: int) -> np.ndarray:
    """Of (query, score, id) the k of each query with the highest scores, ties by the smaller ids."""
    row, score, ids = rows = rows[:, np.lexsort((rows[2], -rows[1], rows[0]))]
    return rows[:, np.arange(len(row)) - np.searchsorted(row, row) < k]

"""What several operators share: row keys, Arrow batches in and out, word rules."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A row's key is its task's number times this, plus its place in the task.
KEY_STRIDE = 1 << 33


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def free_name(docs: DataFrame, name: str) -> str:
    """A column name that docs does not use, in any case."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Keys that are sent to every executor at most: those with more than this part of all rows.
HOT_PART = 1000


def meet(rows: DataFrame, table: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows joined to a written table of one row a key, whose column `size` says how many of the `total` rows have that key.

    Keys with more than total / HOT_PART rows, of which there are fewer than HOT_PART, are
    broadcast, so the rows of a hot key stay where they lie; the others meet by a shuffle.
    """
    hot = F.col(size) > max(1, total // HOT_PART)
    often = F.broadcast(table.where(hot))
    rest = rows.join(F.broadcast(table.where(hot).select(key)), key, "left_anti").join(table.where(~hot), key)
    return rows.join(often, key).unionByName(rest)


def row_keys(taken: int, n: int) -> np.ndarray:
    """Keys for the next n rows of this task, after `taken` earlier ones.

    They are unique in one run of a job; a consumer that needs them twice must read them
    from a written table, not compute them again.
    """
    first = TaskContext.get().partitionId() * KEY_STRIDE + taken
    return np.arange(first, first + n, dtype=np.int64)


def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.RecordBatch]]:
    """Each batch with its rows' keys: those of its first column, or new ones where that is null."""
    taken = 0
    for batch in batches:
        given = batch.column(0)
        yield given if not given.null_count else pa.array(row_keys(taken, batch.num_rows)), batch
        taken += batch.num_rows


def key_column(row_col: str | None) -> Column:
    """The first column that keyed() expects. A row_col must be unique and free of nulls."""
    return (F.col(row_col) if row_col else F.lit(None)).cast("long").alias("_key")


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a whole string column, and where each row's text begins (one more at the end); null is empty."""
    column = column.fill_null("") if column.null_count else column
    wide = column.type in (pa.large_string(), pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True


def word_counts(column: pa.Array) -> np.ndarray:
    """Number of words `[^\\x20\\x09-\\x0D]+` in each text of a string column; null has none."""
    data, at = text_bytes(column)
    if not len(data):
        return np.zeros(len(column), np.int64)
    starts = ~_BLANK[data]
    solid = starts.copy()
    starts[1:] &= ~solid[:-1]
    some = np.flatnonzero(at[:-1] < at[1:])
    starts[at[some]] = solid[at[some]]
    out = np.zeros(len(column), np.int64)
    if len(some):
        out[some] = np.add.reduceat(starts, at[some], dtype=np.int64)
    return out


def as_binary(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary())

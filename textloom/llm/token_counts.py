"""Token counts of fields and sections from the character spans of one whole-document encoding."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.encoding import encoder

_OUT = "doc_id long, field string, section int, start long, end long, n_tokens long, n_crossing long"


def attribute(spans: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which section each token belongs to, and whether it reaches over a border.

    spans: (n, 2) character starts and ends, ascending; borders: section starts and, last,
    the text's length. The rule: a token belongs to the section that has most of its
    characters, the earliest of them in a tie. Sections without characters get none.
    """
    solid = np.flatnonzero(borders[:-1] < borders[1:])
    starts = borders[solid]
    first = np.searchsorted(starts, spans[:, 0], "right") - 1
    last = np.searchsorted(starts, spans[:, 1] - 1, "right") - 1
    owner, crossing = first.copy(), last > first
    for i in np.flatnonzero(crossing):
        mine = np.arange(first[i], last[i] + 1)
        ends = np.append(starts, borders[-1])[mine + 1]
        share = np.minimum(ends, spans[i, 1]) - np.maximum(starts[mine], spans[i, 0])
        owner[i] = mine[int(np.argmax(share))]
    return solid[owner], crossing


def token_counts(docs: DataFrame, fields: Sequence[str] = ("text",), vocabulary: str = "byte_bpe_50k.json", id_col: str = "doc_id") -> DataFrame:
    """Tokens of every line of every field: doc_id, field, section, start, end, n_tokens, n_crossing.

    A document is its fields joined by line feeds, encoded once as a whole. Sections are a
    field's lines with their line feeds (the joining one belongs to the earlier field);
    start and end are character places in the whole document. Token spans are joined to
    section spans by interval, under the rule of attribute(); n_crossing counts those of a
    section's tokens that reach over its border, and all n_tokens sum to the document's.
    Null fields count as empty: one section without tokens but for the joining line feed.
    Rows with equal or null ids stay apart as rows. There is no shuffle.
    """
    names = list(fields)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_of = encoder(vocabulary).spans
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                texts = [c.to_pylist() for c in some.columns[1:]]
                out: list[list] = [[] for _ in range(7)]
                for key, *values in zip(some.column(0).to_pylist(), *texts):
                    borders, where = [0], []
                    for name, value in zip(names, values):
                        for n, line in enumerate((value or "").split("\n")):
                            where.append((name, n))
                            borders.append(borders[-1] + len(line) + 1)
                    borders[-1] -= 1
                    edge = np.array(borders, np.int64)
                    spans = spans_of("\n".join(v or "" for v in values))
                    owner, crossing = attribute(spans, edge) if len(spans) else (np.zeros(0, np.int64),) * 2
                    out[0] += [key] * len(where)
                    out[1] += [w[0] for w in where]
                    out[2] += [w[1] for w in where]
                    out[3] += borders[:-1]
                    out[4] += borders[1:]
                    out[5] += np.bincount(owner, minlength=len(where)).tolist()
                    out[6] += np.bincount(owner, crossing, len(where)).astype(np.int64).tolist()
                kinds = (pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=["doc_id", "field", "section", "start", "end", "n_tokens", "n_crossing"])

    return docs.select(F.col(id_col).cast("long"), *(F.col(f).cast("string") for f in names)).mapInArrow(counted, _OUT)

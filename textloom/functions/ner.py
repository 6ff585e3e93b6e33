"""Entity recognition around a pluggable model: windows, labels, merging, redaction rules.

A model is a function from a list of token windows to arrays of class scores. No weights
come with the library; the windowing, combination and span logic is the same for any.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

Model = Callable[[list[list[str]]], list[np.ndarray]]
WINDOW, CONTEXT = 512, 50
_TOKEN = regex.compile(r"\w+|[^\w\s]")
#: Tags that are never redacted, and what stands for the others.
IGNORED = ("AMBIGUOUS", "USERNAME")
MARKS = {"NAME": "<NAME>", "EMAIL": "<EMAIL>", "PASSWORD": "<PASSWORD>", "KEY": "<KEY>", "IP_ADDRESS": "<IP_ADDRESS>"}


def windows(tokens: Column | str, size: int, overlap: int = 0) -> Column:
    """Windows of `size` tokens, each beginning `size - overlap` after the one before: array<struct<start, tokens>>."""
    t, step = T.col(tokens), size - overlap
    last = F.greatest(F.ceil((F.size(t) - overlap) / step).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: F.struct((i * step).alias("start"), F.slice(t, i * step + 1, F.lit(size)).alias("tokens")))


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def combine(parts: Sequence[tuple[int, np.ndarray]], n: int) -> np.ndarray:
    """Class probabilities of n tokens from windows' scores; where windows overlap, tokens weigh more the farther from an edge."""
    if not parts:
        return np.zeros((n, 0))
    total, weights = np.zeros((n, parts[0][1].shape[1])), np.zeros((n, 1))
    for start, scores in parts:
        size = len(scores)
        w = (1 + np.minimum(np.arange(size), np.arange(size)[::-1]))[:, None].astype(float)
        total[start : start + size] += softmax(scores) * w
        weights[start : start + size] += w
    return total / np.maximum(weights, 1e-12)


def entities(labels: Sequence[str], spans: Sequence[tuple[int, int]], scores: Sequence[float]) -> list[dict]:
    """Entities of B-/I- labels: a B- or another tag begins one, equal I- labels continue it."""
    out: list[dict] = []
    open_ = None
    for label, (start, end), score in zip(labels, spans, scores):
        kind, _, tag = label.partition("-")
        if kind not in ("B", "I"):
            open_ = None
        elif kind == "I" and open_ and open_["tag"] == tag:
            open_["end"], open_["_s"] = end, [*open_["_s"], score]
        else:
            open_ = {"tag": tag, "start": start, "end": end, "_s": [score]}
            out.append(open_)
    return [{"tag": e["tag"], "start": e["start"], "end": e["end"], "score": float(np.mean(e["_s"]))} for e in out]


def label_tokens(spans: Sequence[tuple[int, int]], truth: Sequence[tuple[int, int, str]]) -> list[str]:
    """B-/I-/O labels of tokens by the annotated spans they overlap; the first overlapping token of a span begins it."""
    out = ["O"] * len(spans)
    for start, end, tag in sorted(truth):
        begun = False
        for i, (a, b) in enumerate(spans):
            if a < end and start < b and out[i] == "O":
                out[i], begun = f"{'I' if begun else 'B'}-{tag}", True
    return out


def trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    """A span without punctuation and blanks at its ends."""
    while start < end and not text[start].isalnum():
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    return start, end


def recognise(docs: DataFrame, model: Model, labels: Sequence[str], size: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and entities (array<struct<tag, value, start, end, context, score>>) of each text."""
    kind = f"{id_col} long, entities array<struct<tag:string,value:string,start:int,end:int,context:string,score:double>>"

    def found(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for text in frame[text_col].fillna(""):
                spans = [m.span() for m in _TOKEN.finditer(text)]
                step = size - size // 4
                starts = list(range(0, max(1, len(spans) - size // 4), step)) if spans else []
                batch = [[text[a:b] for a, b in spans[s : s + size]] for s in starts]
                p = combine(list(zip(starts, model(batch))), len(spans)) if batch else np.zeros((0, len(labels)))
                best = p.argmax(axis=1) if len(p) else []
                made = []
                for e in entities([labels[i] for i in best], spans, [p[j, i] for j, i in enumerate(best)]):
                    a, b = trimmed(text, e["start"], e["end"])
                    if a < b:
                        made.append(e | {"start": a, "end": b, "value": text[a:b], "context": text[max(0, a - CONTEXT) : b + CONTEXT]})
                rows.append(made)
            yield pd.DataFrame({id_col: frame[id_col], "entities": rows})

    return docs.select(id_col, text_col).mapInPandas(found, kind)


def redactable(entity: Column) -> Column:
    """Whether an entity is to go: a known tag, more than three characters; keys of more than eight, names in full."""
    value = entity["value"]
    long_ = (F.length(value) > 3) & ~entity["tag"].isin(*IGNORED)
    return long_ & ((entity["tag"] != "KEY") | (F.length(value) > 8)) & ((entity["tag"] != "NAME") | F.contains(F.trim(value), F.lit(" ")))


def redact(text: Column | str, found: Column | str) -> Column:
    """The text with its redactable entities replaced by their tags' marks."""
    t = T.col(text)
    marks = F.create_map(*(F.lit(x) for pair in MARKS.items() for x in pair))
    ordered = F.array_sort(F.filter(T.col(found), redactable), lambda a, b: a["start"] - b["start"])
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, e: Column) -> Column:
        mark = F.coalesce(F.try_element_at(marks, e["tag"]), F.lit("<PII>"))
        return F.struct(F.concat(acc["out"], F.substring(t, acc["at"] + 1, e["start"] - acc["at"]), mark).alias("out"), e["end"].alias("at"))

    return F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))


def f1_by_class(counts: DataFrame) -> DataFrame:
    """tag, precision, recall, f1 from tag, tp, fn, fp; 0 where nothing was found or to be found."""
    def over(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(a / F.greatest(b, F.lit(1)))

    p, r = over(F.col("tp"), F.col("tp") + F.col("fp")), over(F.col("tp"), F.col("tp") + F.col("fn"))
    return counts.select("tag", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r == 0, F.lit(0.0)).otherwise(2 * p * r / F.greatest(p + r, F.lit(1e-12))), 6).alias("f1"))

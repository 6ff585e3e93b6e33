"""MinHash-LSH near-duplicates: signatures, bands, star edges, components, survivors."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.components import connected_components
from textloom.operators.links import linked
from textloom.session import Workspace, spread

#: The Mersenne prime, the hash range and the seed that signatures must share.
PRIME, RANGE, SEED = (1 << 61) - 1, (1 << 32) - 1, 42
SQL_PRIME = (1 << 31) - 1
_BREAK = re.compile(T.PIECE_BREAK)
#: Hashes that are permuted at once.
_TOGETHER = 2048


@lru_cache
def band_shape(threshold: float = 0.7, permutations: int = 128, false_positive: float = 0.5, false_negative: float = 0.5) -> tuple[int, int]:
    """Bands and rows a band that minimise the weighted areas of error about the threshold."""
    best, shape = np.inf, (1, 1)
    below, above = np.linspace(0, threshold, 2001), np.linspace(threshold, 1, 2001)
    for b in range(1, permutations + 1):
        for r in range(1, permutations // b + 1):
            wrong = false_positive * np.trapezoid(1 - (1 - below**r) ** b, below) + false_negative * np.trapezoid((1 - above**r) ** b, above)
            if wrong < best - 1e-12:
                best, shape = wrong, (b, r)
    return shape


@lru_cache
def permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The multipliers and addends of n permutations, drawn in turn from one seeded generator."""
    draw = np.random.RandomState(SEED)
    pairs = [(draw.randint(1, PRIME, dtype=np.uint64), draw.randint(0, PRIME, dtype=np.uint64)) for _ in range(n)]
    return tuple(np.array(x, np.uint64) for x in zip(*pairs))


def signature(hashes: np.ndarray, n: int) -> np.ndarray:
    """Smallest permuted hash of each of n permutations; all at the range's end without hashes."""
    return signatures(hashes.astype(np.uint64), np.array([len(hashes)]), n)[0]


def signatures(flat: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    """The signature of each of several lists of hashes, which lie one after another.

    Products wrap at 64 bits; the remainder by the Mersenne prime is that of the low 61 bits
    plus the rest.
    """
    a, b = permutations(n)
    prime, out = np.uint64(PRIME), np.full((len(sizes), n), RANGE, np.uint64)
    starts, at = np.concatenate(([0], np.cumsum(sizes))), 0
    rows = np.repeat(np.arange(len(sizes)), sizes)
    for at in range(0, len(flat), _TOGETHER):
        x = flat[at : at + _TOGETHER, None] * a
        x += b
        x = (x & prime) + (x >> np.uint64(61))
        x -= (x >= prime) * prime
        x &= np.uint64(RANGE)
        mine = rows[at : at + _TOGETHER]
        first = np.flatnonzero(np.diff(mine, prepend=-1))
        out[mine[first]] = np.minimum(out[mine[first]], np.minimum.reduceat(x, first, axis=0))
    return out


def grams_of(text: str | None, ngram: int, least: int = 0) -> set[str]:
    """Distinct runs of ngram pieces of a text, joined by spaces; none if it has fewer pieces (or than `least`)."""
    pieces = _BREAK.split(text or "")
    if len(pieces) < max(ngram, least):
        return set()
    joined, ends, at = " ".join(pieces), [], -1
    for p in pieces:
        at += len(p) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends)]
    return {joined[starts[i] : e] for i, e in enumerate(ends[ngram - 1 :])}


def gram_rows(docs: DataFrame, ngram: int = 5, least: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, gram: the distinct grams of each document, one row each."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                found = [list(grams_of(t, ngram, least)) for t in some.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(found)), [len(f) for f in found])
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(owner)), pa.array([g for f in found for g in f], pa.string())], names=[id_col, "gram"])

    return spread(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string"))).mapInArrow(made, f"{id_col} long, gram string")


def tokens_of(text: str | None) -> set[str]:
    """Distinct pieces of a text without empty ones."""
    return {p for p in _BREAK.split(text or "") if p}


def signed(docs: DataFrame, ngram: int = 5, threshold: float = 0.7, n: int = 128, least: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size (distinct grams), keys (its signature's bands, big-endian bytes) and grams (64-bit hashes, ascending) of each document.

    With an ngram of 1 the grams are its distinct tokens.

    One pass of Arrow batches: grams are cut from one joined text, and the signatures of many
    documents are made at once.
    """
    b, r = band_shape(threshold, n)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                digests = [b"".join(hashlib.sha1(g.encode()).digest()[:8] for g in (grams_of(t, ngram, least) if ngram > 1 else tokens_of(t))) for t in some.column(1).to_pylist()]
                sizes = np.array([len(d) // 8 for d in digests])
                flat = np.frombuffer(b"".join(digests), "<u8")
                keys = signatures(flat & np.uint64(0xFFFFFFFF), sizes, n)[:, : b * r].astype(">u8")
                data = pa.array([k.tobytes() for k in keys.reshape(-1, r)], pa.binary())
                ends = np.cumsum(sizes)
                sets = [np.unique(flat[e - m : e]).tobytes() for e, m in zip(ends, sizes)]
                columns = [some.column(0), pa.array(sizes.astype(np.int32)), pa.ListArray.from_arrays(pa.array(np.arange(some.num_rows + 1) * b, pa.int32()), data), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "size", "keys", "grams"])

    picked = spread(docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("_text")))
    return picked.mapInArrow(made, f"{id_col} long, size int, keys array<binary>, grams binary")


def bands(docs: DataFrame, ngram: int = 5, threshold: float = 0.7, n: int = 128, least: int = 0, id_col: str = "doc_id", text_col: str = "text", keep_short: bool = True) -> DataFrame:
    """id, band, key: each document's signature cut into bands of big-endian bytes.

    With keep_short, texts of fewer than ngram pieces have no band and so stay apart;
    otherwise they share one signature.
    """
    found = signed(docs, ngram, threshold, n, least, id_col, text_col)
    return (found.where("size > 0") if keep_short else found).select(id_col, F.posexplode("keys").alias("band", "key"))


def verified_pairs(pairs: DataFrame, found: DataFrame, shared: int = 4, of: int = 5, id_col: str = "doc_id", others: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) whose sets of grams have shared/of of their union in common, with that similarity; b is of `others` if given."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, all_ = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), "<u8") for v in (x, y))
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                all_.append(len(x) + len(y) - both[-1])
            both, all_ = np.array(both, np.int64), np.array(all_, np.int64)
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both / np.maximum(all_, 1))], names=["a", "b", "similarity"])
            yield made.filter(pa.array((of * both >= shared * all_) & (all_ > 0)))

    left, right = (x.select(id_col, "grams") for x in (found, found if others is None else others))
    met = pairs.join(left.toDF("a", "x"), "a").join(right.toDF("b", "y"), "b").select("a", "b", "x", "y")
    return met.mapInArrow(alike, "a long, b long, similarity double")


def near_links(found: DataFrame, shared: int = 4, of: int = 5, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) among written signed() rows that share a bucket, and node, component of those linked.

    Documents with equal sets of grams are linked too. Ids are unique and not null.
    """
    long_ = found.where("size > 0").select(F.col(id_col).alias("row_key"), "size", F.lit(0).alias("own"), F.posexplode("keys").alias("band", "key"))
    postings = long_.select(F.struct("band", "key").alias("list"), "row_key", "size", "own", F.lit(None).cast("binary").alias("map"))
    return linked(postings, lambda pairs: verified_pairs(pairs, found, shared, of, id_col), shared, of)


def similar_pairs(found: DataFrame, shared: int = 4, of: int = 5, id_col: str = "doc_id") -> DataFrame:
    """All pairs (a < b) of written signed() rows whose sets of grams have shared/of of their union in common, exactly, with that similarity.

    Equal sets count once, under their smallest id, so copies make no pairs. A pair shares
    one of the first size - ceil(size * shared / of) + 1 grams of each side, rarest first:
    only those meet, and each pair is then compared whole.
    """
    work = Workspace(found.sparkSession, "similar")
    single = found.where("size > 0").groupBy("grams").agg(F.min(id_col).alias(id_col), F.min("size").alias("size"))
    single = work.keep(single, "single")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                some = batch.slice(at, 512)
                sets = [np.frombuffer(v, "<u8") for v in some.column(1).to_pylist()]
                owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                flat = np.concatenate(sets) if sets else np.zeros(0, "<u8")
                yield pa.RecordBatch.from_arrays([some.column(0).take(pa.array(owner)), pa.array(flat.view(np.int64))], names=[id_col, "gram"])

    grams = work.keep(single.select(id_col, "grams").mapInArrow(each, f"{id_col} long, gram long"), "grams")
    often = grams.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1")
    met = grams.join(often, "gram").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("n", "gram"))).alias("common"))
    # grams of one set alone come first in the order and never meet
    free = F.col("size") - F.ceil(F.col("size") * shared / of) + 1 - (F.col("size") - F.size("common"))
    listed = met.join(single.select(id_col, "size"), id_col).select(id_col, "size", F.explode(F.slice("common", F.lit(1), F.greatest(free, F.lit(0)).cast("int"))).alias("c"))
    listed = work.keep(listed.select(F.col("c.gram").alias("gram"), F.col(id_col).alias("id"), "size"), "listed")
    other = listed.toDF("gram", "b", "m")
    near = listed.toDF("gram", "a", "n").join(other, "gram").where("a < b").where(F.least("m", "n") * of >= F.greatest("m", "n") * shared)
    return verified_pairs(near.select("a", "b").distinct(), single, shared, of, id_col)


def sql_bands(docs: DataFrame, ngram: int = 5, n_bands: int = 4, rows: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Bands by built-in expressions only: (a h + b) mod a 31-bit prime, exact in 64-bit arithmetic."""
    grams = docs.select(id_col, F.explode(T.shingles(T.pieces(text_col), ngram)).alias("gram"))
    hashed = grams.select(id_col, F.pmod(T.hash32("gram"), F.lit(SQL_PRIME)).alias("h"))
    lanes = [F.min(F.pmod(F.lit(a).cast("long") * F.col("h") + F.lit(b), F.lit(SQL_PRIME))).alias(f"m{i}") for i, (a, b) in enumerate(sql_permutations(n_bands * rows))]
    signed = hashed.groupBy(id_col).agg(*lanes)
    keys = F.array(*(F.struct(F.lit(j).alias("band"), F.concat_ws("-", *(F.col(f"m{j * rows + i}").cast("string") for i in range(rows))).alias("key")) for j in range(n_bands)))
    return signed.select(id_col, F.explode(keys).alias("_k")).select(id_col, "_k.band", "_k.key")


def sql_permutations(n: int) -> list[tuple[int, int]]:
    """Multipliers and addends from a linear congruential rule."""
    out, x = [], SEED
    for _ in range(n):
        x = (x * 1103515245 + 12345) % SQL_PRIME
        a = x or 1
        x = (x * 1103515245 + 12345) % SQL_PRIME
        out.append((a, x))
    return out


def star_edges(banded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """src, dst: each member of a bucket tied to the bucket's smallest id, never to each other.

    The smallest id is a partial aggregation joined back, so no bucket is gathered.
    """
    least = banded.groupBy("band", "key").agg(F.min(id_col).alias("dst"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    tied = banded.join(least, ["band", "key"]).where(F.col(id_col) != F.col("dst"))
    return tied.select(F.col(id_col).alias("src"), "dst").distinct()


def near_components(banded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """node, component (smallest id) of every document that shares a bucket with another."""
    work = Workspace(banded.sparkSession, "minhash")
    return connected_components(work.keep(star_edges(work.keep(banded, "bands"), id_col), "edges"))


def survivors(docs: DataFrame, components: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """docs without the members of a component (node, component) that are not its smallest."""
    gone = components.where("node <> component").select(F.col("node").alias(id_col))
    return docs.join(gone, id_col, "left_anti")


def dedup_report(before: DataFrame, after: DataFrame) -> DataFrame:
    """n_before, n_after, duplicate_share."""
    b, a = before.agg(F.count("*").alias("n_before")), after.agg(F.count("*").alias("n_after"))
    return b.join(F.broadcast(a)).withColumn("duplicate_share", F.round(1 - F.col("n_after") / F.greatest(F.lit(1), F.col("n_before")), 6))

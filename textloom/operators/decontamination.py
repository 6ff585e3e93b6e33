"""Find and drop documents that contain, or nearly equal, benchmark texts."""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators import minhash
from textloom.session import Workspace

#: Benchmark characters searched in one pass; more are searched in as many passes as it takes.
PASS_CHARS = 50_000_000


def substring_hits(docs: DataFrame, needles: DataFrame, id_col: str = "doc_id", text_col: str = "text", needle_id: str = "item_id", needle_col: str = "text") -> DataFrame:
    """id, item: the first benchmark string (by its id) that each document contains, whatever the case.

    One Aho-Corasick automaton finds all strings in one scan of a text. Its size is bounded
    by PASS_CHARS: larger benchmarks are cut into passes and the first hit of all passes
    counts. Empty strings never match. Documents without a hit have no row.
    """
    known = needles.select(F.col(needle_id).cast("long").alias("i"), F.lower(needle_col).alias("s")).where("s is not null and s <> ''")
    total = known.agg(F.sum(F.length("s"))).first()[0] or 0
    passes = max(1, -(-total // PASS_CHARS))
    found = None
    for p in range(passes):
        strings = [(r.i, r.s) for r in known.where(F.pmod(F.xxhash64("i"), F.lit(passes)) == p).collect()]
        one = _search(docs.select(F.col(id_col).cast("long").alias(id_col), F.lower(text_col).alias("t")), strings, id_col)
        found = one if found is None else found.unionByName(one)
    return found if passes == 1 else found.groupBy(id_col).agg(F.min("item").alias("item"))


def _search(docs: DataFrame, strings: list[tuple[int, str]], id_col: str) -> DataFrame:
    machine = ahocorasick.Automaton()
    for i, s in sorted(strings, reverse=True):
        machine.add_word(s, i)
    machine.make_automaton()
    shared = docs.sparkSession.sparkContext.broadcast(machine)  # built once, bounded by PASS_CHARS

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = shared.value.iter
        for batch in batches:
            ids, items = [], []
            for key, text in zip(*(c.to_pylist() for c in batch.columns)):
                hits = [i for _, i in find(text)] if text and strings else []
                if hits:
                    ids.append(key)
                    items.append(min(hits))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(items, pa.int64())], names=[id_col, "item"])

    return docs.mapInArrow(scan, f"{id_col} long, item long")


def decontaminate(docs: DataFrame, needles: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """What stays, and what goes with its reason and matched item."""
    hits = Workspace(docs.sparkSession, "decontam").keep(substring_hits(docs, needles, id_col), "hits")
    gone = docs.join(hits, id_col).withColumn("reason", F.lit("benchmark_match"))
    return docs.join(hits, id_col, "left_anti"), gone


def incremental_hits(docs: DataFrame, needles: DataFrame, searched: DataFrame, earlier: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Hits of a grown benchmark: strings searched before are not searched again, earlier hits are reused.

    searched has the item_ids of before, earlier their hits (id, item); one hit a document stays.
    """
    new = substring_hits(docs.join(earlier, id_col, "left_anti"), needles.join(searched, "item_id", "left_anti"), id_col)
    kept = earlier.join(docs.select(id_col), id_col, "left_semi").select(id_col, "item")
    return kept.unionByName(new).groupBy(id_col).agg(F.min("item").alias("item"))


def token_sets(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and distinct pieces, without empty ones."""
    return docs.select(F.col(id_col).alias("id"), F.array_remove(F.array_distinct(T.pieces(text_col)), "").alias("tokens"))


def jaccard_matches(docs: DataFrame, needles: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text", needle_id: str = "item_id") -> DataFrame:
    """id, item, similarity of all pairs with token-set Jaccard of at least threshold, exactly.

    Prefix filtering: a pair that reaches the threshold shares one of the (1 - threshold)
    n + 1 rarest tokens of each side, so both sides list only those tokens, in one global
    order from rare to frequent, and pairs form on equal tokens; the similarity is then
    computed in full. The benchmark is the smaller side by far and gives the order.
    """
    left, right = token_sets(docs, id_col, text_col), token_sets(needles, needle_id, "text")
    common = right.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("df"))

    def prefixes(side: DataFrame) -> DataFrame:
        # tokens that no benchmark text has come first in the order and never meet, so they need no rows
        rows = side.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(common, "token")
        ordered = rows.groupBy("id").agg(F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "token"))).alias("all"))
        size = F.col("n") - F.ceil(F.col("n") * threshold) + 1 - (F.col("n") - F.size("all"))
        return ordered.select("id", F.explode(F.slice("all", F.lit(1), F.greatest(size, F.lit(0)).cast("int"))).alias("p")).select("id", "p.token")

    pairs = prefixes(left).join(prefixes(right).withColumnRenamed("id", "item"), "token").select("id", "item").distinct()
    full = pairs.join(left, "id").join(right.select(F.col("id").alias("item"), F.col("tokens").alias("others")), "item")
    scored = full.withColumn("similarity", T.jaccard(F.col("tokens"), F.col("others"))).where(F.col("similarity") >= threshold)
    return scored.select(F.col("id").alias(id_col), "item", "similarity")


def lsh_matches(docs: DataFrame, needles: DataFrame, threshold: float = 0.58, n: int = 128, id_col: str = "doc_id", text_col: str = "text", needle_id: str = "item_id") -> DataFrame:
    """id, item, similarity of documents and benchmark texts that share a band of their token sets' MinHash signatures and reach the threshold.

    Unlike jaccard_matches, pairs near the threshold may be missed as bands have it; what is
    found is compared whole. threshold is taken in hundredths.
    """
    work = Workspace(docs.sparkSession, "lsh")
    left = work.keep(minhash.signed(docs, 1, threshold, n, 0, id_col, text_col), "documents")
    right = work.keep(minhash.signed(needles.withColumnRenamed(needle_id, id_col) if needle_id != id_col else needles, 1, threshold, n, 0, id_col, "text"), "needles")
    a, b = (x.where("size > 0").select(F.col(id_col).alias(name), F.posexplode("keys").alias("band", "key")) for x, name in ((left, "a"), (right, "b")))
    pairs = a.join(b, ["band", "key"]).select("a", "b").distinct()
    found = minhash.verified_pairs(pairs, left, round(100 * threshold), 100, id_col, right)
    return found.select(F.col("a").alias(id_col), F.col("b").alias("item"), "similarity")

"""Connected components by alternating large-star and small-star steps over edge tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import Workspace

#: Distinct edges between whole numbers that one task labels at most; larger graphs take rounds.
ONE_TASK = 1 << 19


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """Label every vertex of an undirected edge table with the smallest vertex it reaches.

    Returns (node, component). Self-loops and repeated edges are harmless; edges with a
    null end are ignored; a vertex occurs only if an edge names it. Each round is one
    large-star and one small-star step, written to the shared folder to cut lineage; the
    number of edges never grows and O(log^2 n) rounds suffice. Only two numbers a round
    reach the driver. Hub vertices are safe: a vertex's smallest neighbour is found by a
    partial aggregation and joined back, never by gathering its neighbours. Graphs of at
    most ONE_TASK edges whose vertices are whole numbers are labelled in one task instead.
    """
    spark = edges.sparkSession
    work = Workspace(spark, "components")
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    loops = pairs.where("a = b").select("a").distinct()
    now = work.keep(_down(pairs), "edges")
    alone = loops.select(F.col("a").alias("node"), F.col("a").alias("component"))
    if {kind for _, kind in now.dtypes} == {"bigint"} and now.count() <= ONE_TASK:
        labels = now.coalesce(1).mapInArrow(_labelled, "node long, component long")
        return labels.unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))
    seen = None
    for _ in range(max_rounds):
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen or state[0] == 0:
            break
        seen = state
        after = work.keep(_small_star(_large_star(now)), "edges")
        work.drop(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    linked = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component"))
    return linked.unionByName(roots).unionByName(alone).groupBy("node").agg(F.min("component").alias("component"))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every vertex of all edges with the smallest vertex it reaches, by union and find."""
    ends = [np.stack([c.to_numpy() for c in batch.columns]) for batch in batches]
    if not ends:
        return
    nodes, place = np.unique(np.concatenate(ends, axis=1), return_inverse=True)
    parent = list(range(len(nodes)))
    for a, b in place.reshape(2, -1).T.tolist():
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        parent[max(a, b)] = min(a, b)
    for i, up in enumerate(parent):  # a parent is never larger, so it is done before
        parent[i] = parent[up]
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[parent])], names=["node", "component"])


def _down(pairs: DataFrame) -> DataFrame:
    """Each edge once, from its larger to its smaller end."""
    return pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each vertex's larger neighbours to the smallest vertex among it and its neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    return _down(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each vertex and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _down(moved.unionByName(least.select("a", F.col("m").alias("b"))))

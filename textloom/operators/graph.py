"""Dependency graphs of files: edges, components, order, and the texts that follow from it."""

from __future__ import annotations

from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.components import connected_components
from textloom.session import Workspace


def similarity(a, b):
    """Shared parts of two paths over the shorter one's number of parts."""
    left, right = T.path_parts(a), T.path_parts(b)
    return F.size(F.array_intersect(left, right)) / F.greatest(F.lit(1), F.least(F.size(left), F.size(right)))


def import_edges(imports: DataFrame, files: DataFrame) -> DataFrame:
    """repo, lang, src, dst: each import tied to the file it most likely means.

    imports: repo, lang, path, name; files: repo, lang, path. Candidates are the files
    whose last path part (with or without its suffix) is the imported name; of several the
    one with the most similar path counts, then the smallest path. Self-imports are none.
    """
    last = F.element_at(T.path_parts("path"), -1)
    names = F.array_distinct(F.array(last, F.regexp_replace(last, r"\.[^.]*$", "")))
    targets = files.select("repo", "lang", F.col("path").alias("dst"), F.explode(names).alias("name"))
    met = imports.select("repo", "lang", F.col("path").alias("src"), "name").distinct().join(targets, ["repo", "lang", "name"]).where("src <> dst")
    best = met.groupBy("repo", "lang", "src", "name").agg(F.min_by("dst", F.struct(-similarity("src", "dst"), F.col("dst"))).alias("dst"))
    return best.select("repo", "lang", "src", "dst").distinct()


def degrees(edges: DataFrame) -> DataFrame:
    """node, n_out, n_in of every vertex."""
    ends = edges.select(F.col("src").alias("node"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(F.col("dst").alias("node"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    return ends.groupBy("node").agg(F.sum("o").alias("n_out"), F.sum("i").alias("n_in"))


def file_components(edges: DataFrame) -> DataFrame:
    """node, component: files tied by imports in either direction."""
    return connected_components(edges)


def topological_levels(edges: DataFrame) -> DataFrame:
    """node, level: the longest way of imports below a node, cycles cut where nothing else is left.

    Nodes without imports have level 0; each round settles the nodes whose targets are all
    settled, one above the highest of them. Where every node left waits for another, those
    that are the smallest of all they reach, themselves among them, are settled above those
    of their targets that are, which cuts their cycles. So every round settles a node and the
    rounds end. Self-imports do not count.
    """
    work = Workspace(edges.sparkSession, "levels")
    open_ = work.keep(edges.where("src <> dst").select("src", "dst", F.lit(-1).cast("long").alias("below")).distinct(), "edges")
    ends = edges.select(F.col("src").alias("node")).unionByName(edges.select(F.col("dst").alias("node"))).distinct()
    settled = work.keep(ends.join(open_.select(F.col("src").alias("node")).distinct(), "node", "left_anti").withColumn("level", F.lit(0).cast("long")), "settled")
    done, fresh = [settled], settled
    while open_.count():
        # below: the highest level of an edge's target, null as long as it is not settled; -1 stands for that here
        after = open_.join(fresh.select(F.col("node").alias("dst"), "level"), "dst", "left")
        open_ = work.keep(after.select("src", "dst", F.greatest("below", F.coalesce("level", F.lit(-1))).alias("below")), "edges")
        free = open_.groupBy("src").agg(F.min("below").alias("least"), (F.max("below") + 1).alias("level"))
        fresh = work.keep(free.where("least >= 0").select(F.col("src").alias("node"), "level"), "settled")
        if not fresh.head(1):
            first = _least_of_own_reach(open_.where("below < 0").select("src", "dst"), work)
            fresh = work.keep(free.join(first, "src").select(F.col("src").alias("node"), "level"), "settled")
        done.append(fresh)
        open_ = work.keep(open_.join(fresh.select(F.col("node").alias("src")), "src", "left_anti"), "edges")
    found = done[0]
    for each in done[1:]:
        found = found.unionByName(each)
    return found


def _least_of_own_reach(edges: DataFrame, work: Workspace) -> DataFrame:
    """src: nodes that are the smallest of all nodes they reach and reach themselves; every cycle without a way out has one."""
    reached = work.keep(edges.groupBy("src").agg(F.min("dst").alias("least")), "reached")
    while True:
        further = edges.join(reached.select(F.col("src").alias("dst"), "least"), "dst").groupBy("src").agg(F.min("least").alias("far"))
        after = work.keep(reached.join(further, "src", "left").select("src", F.least("least", "far").alias("least"), (F.col("far") < F.col("least")).alias("moved")), "reached")
        if not after.where("moved").head(1):
            return after.where("src = least").select("src")
        reached = after.drop("moved")


def order_files(nodes: list[str], edges: list[tuple[str, str]]) -> list[str]:
    """Imports before importers; cycles are cut where the walk meets them again.

    Walks start at the files with the fewest imports, ties by name.
    """
    below: dict[str, list[str]] = defaultdict(list)
    for a, b in sorted(set(edges)):
        below[a].append(b)
    out: list[str] = []
    seen: set[str] = set()
    for start in sorted(nodes, key=lambda n: (len(below[n]), n)):
        stack = [(start, iter(below[start]))] if start not in seen else []
        seen.add(start)
        while stack:
            node, rest = stack[-1]
            for child in rest:
                if child not in seen:
                    seen.add(child)
                    stack.append((child, iter(below[child])))
                    break
            else:
                out.append(node)
                stack.pop()
    return out


def topological_order(edges: DataFrame, components: DataFrame) -> DataFrame:
    """component, node, place: the order of files in each component.

    The order within a component is sequential by nature, so a component is one group; its
    size is that of a repository's linked files.
    """
    rows = edges.join(components, edges.src == components.node).select("component", "src", "dst")

    def ordered(part: pd.DataFrame) -> pd.DataFrame:
        pairs = list(zip(part.src, part.dst))
        nodes = order_files(sorted({n for p in pairs for n in p}), pairs)
        return pd.DataFrame({"component": part.component.iloc[0], "node": nodes, "place": range(len(nodes))})

    kind = components.schema["component"].dataType.simpleString()
    return rows.groupBy("component").applyInPandas(ordered, f"component {kind}, node {kind}, place long")


def concatenated(files: DataFrame, order: DataFrame, most: int = 1_000_000) -> DataFrame:
    """component, part, text: the texts of each component in order, cut into parts of about `most` characters.

    files: node, text. A part closes before the file that would take it beyond the bound.
    """
    rows = order.join(files, "node").select("component", "place", "text", F.length("text").alias("n"))
    upto = Window.partitionBy("component").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    parts = rows.withColumn("part", F.floor(F.coalesce(F.sum("n").over(upto), F.lit(0)) / most))
    joined = parts.groupBy("component", "part").agg(F.array_sort(F.collect_list(F.struct("place", "text"))).alias("_t"))
    return joined.select("component", "part", F.array_join(F.transform("_t", lambda x: x["text"]), "\n").alias("text"))

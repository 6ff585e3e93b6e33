import math

import numpy as np
from pyspark.sql import functions as F

from textloom.llm import topk_search


def plain(rows, k, is_query):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v))]
    out = []
    for q, a in good:
        if is_query(q):
            found = sorted(((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(a) == len(b)))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(found)]
    return sorted(out)


def test_top_k_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(0, 0.3, 8).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 8) for i in range(80)]  # a vector that many rows share
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (404, [2000.0] * 8), (None, [1.0] * 8)]
    rows += [(500, [0.1, 0.2]), (501, [0.3, -0.2]), (510, [7.0]), (520, [])]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk_search.search(docs, "vec_id % 10 = 0").collect()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == plain(rows, 10, lambda q: q % 10 == 0)
    assert topk_search.search(docs.where("vec_id < 0"), "vec_id % 10 = 0").count() == 0
    huge = docs.where("vec_id < 20").unionByName(spark.createDataFrame([(600, [1e30] * 8), (610, [0.1] * 7 + [-1e300])], "vec_id long, embedding array<double>"))
    assert {r.query_id for r in topk_search.search(huge, "vec_id % 10 = 0").collect()} == {0, 10}
    clashing = docs.where("vec_id between 500 and 501").withColumn("q", F.lit(1)).withColumn("block", F.lit(2))
    assert [(r.query_id, r.vec_id) for r in topk_search.search(clashing, "vec_id = 500").collect()] == [(500, 501)]


def test_scores_are_exact_where_doubles_are_not():
    a = np.array([[(1 << 30) + 1, 3]], np.int64)
    assert topk_search.scores(a, a).tolist() == [[((1 << 30) + 1) ** 2 + 9]]


def test_blocks_and_what_the_driver_holds_are_bounded(spark, monkeypatch):
    """Of vectors of any length a row is at most a block, and the queries' intervals are never broadcast."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 0.3, 512).tolist()) for i in range(300)] + [(300, [-32.0] * 512), (301, [40.0] * 512), (302, [6e4] + [0.1] * 511)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(1)
    kept = topk_search.blocks(docs, 4096).collect()
    assert sorted(i for b in kept for i in b.ids) == list(range(303))
    assert max(len(b.numbers) for b in kept) <= topk_search.BLOCK_BYTES
    assert sum(len(b.numbers) for b in kept) < 303 * 512 * 8
    monkeypatch.setattr(topk_search, "BLOCK_BYTES", 512 * 8 * 7)
    monkeypatch.setattr(topk_search, "GROUP_BYTES", 512 * 8 * 20)
    found = topk_search.search(docs, "vec_id % 50 = 0 or vec_id = 301")
    assert "BroadcastExchange" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == plain(rows, 10, lambda q: q % 50 == 0 or q == 301)

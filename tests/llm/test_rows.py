import hashlib
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, mixing, sharding, simhash
from textloom.session import Workspace


def lowered(text):
    return (text or "").encode().lower()


@pytest.mark.parametrize("old", ["false", "true", "doc_id < 9", "doc_id % 2 = 0", "doc_id is null"])
def test_exact_dedup(spark, odd, none, old):
    docs = odd.collect()
    groups = {}
    for d in docs:
        groups.setdefault(lowered(d.text), []).append(d.doc_id)
    rows = exact_dedup.exact_dedup(odd, old=old).collect()
    assert len(rows) == len(docs)
    kept = {}
    expected = {hashlib.sha256(t).digest(): (max((i for i in ids if i is not None), default=None), len(ids), ids) for t, ids in groups.items()}
    for r in rows:
        keep, size, ids = expected[bytes(r.digest)]
        assert (r.keep_id, r.group_size) == (keep, size) and r.doc_id in ids
        assert not r.kept or r.doc_id == keep
        kept[bytes(r.digest)] = kept.get(bytes(r.digest), 0) + r.kept
    assert set(kept.values()) == {1}
    assert exact_dedup.exact_dedup(none, old=old).count() == 0


def test_perfect_hash_is_minimal_and_tells_strangers():
    keys = np.frombuffer(b"".join(hashlib.sha256(str(i).encode()).digest() for i in range(6000)), np.uint8).reshape(-1, 32)
    mine = exact_dedup.PerfectHash.build(keys[:5000])
    assert sorted(mine.slots(keys[:5000]).tolist()) == list(range(5000))
    assert mine.slots(keys).max() < 5000
    assert exact_dedup.PerfectHash.build(keys[:0]).slots(keys).tolist() == [-1] * 6000


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_sharding(odd, none, shards):
    docs = odd.unionByName(odd).collect()
    rows = sharding.shard(odd.unionByName(odd), shards).collect()
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted((str(d.doc_id), len((d.text or "").encode()) + 16, zlib.crc32((d.text or "").encode())) for d in docs)
    sizes = {}
    for r in rows:
        sizes.setdefault(r.shard, []).append(r.slot)
    counts = [len(sizes.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and set(sizes) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in sizes.values())
    assert sharding.shard(none, shards).count() == 0


def test_sharding_gathers_groups_under_quotas(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 1300, "hot").when(F.col("id") < 3000, F.concat(F.lit("g"), (F.col("id") % 170))).otherwise(F.col("id").cast("string")).alias("text"))
    out = sharding.shard(docs, 8).persist()
    counts = [r["count"] for r in out.groupBy("shard").count().collect()]
    assert len(counts) == 8 and set(counts) == {500}
    by = out.join(docs, "doc_id").groupBy("text").agg(F.countDistinct("shard").alias("n"))
    spread = {r.text: r.n for r in by.collect()}
    assert spread["hot"] <= 3
    assert not any(n > 1 for t, n in spread.items() if t[0] == "g")


def filled(sizes, weights, most):
    total, capped = sum(sizes), set()
    while True:
        free = sum(w for i, w in enumerate(weights) if i not in capped)
        unit = (total - sum(most * sizes[i] for i in capped)) / free if free else 0
        more = {i for i in range(len(sizes)) if i not in capped and unit * weights[i] > most * sizes[i]}
        if not more:
            return [float(most * s) if i in capped else unit * w for i, (s, w) in enumerate(zip(sizes, weights))]
        capped |= more


def test_mixing(spark, odd, none):
    many = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 97).cast("int")).alias("text"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 11 == 0, None).otherwise(F.concat(F.lit("é"), F.col("id") % 5)).alias("source"),
    )
    for docs in (odd.select("doc_id", "text", "source"), many):
        sized = Workspace(spark, "t").keep(mixing.sizes(docs), "s")
        rows = mixing.mix(sized, mixing.targets(sized)).collect()
        assert sorted((str(r.doc_id), r.size) for r in rows) == sorted((str(d.doc_id), len((d.text or "").encode().split())) for d in docs.collect())
        by = {}
        for r in rows:
            by.setdefault(r.source, []).append(r)
        order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
        expected = filled([sum(r.size for r in by[s]) for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 3)
        for s, target in zip(order, expected):
            assert {round(r.target, 6) for r in by[s]} == {round(target, 6)}
            assert {r.source_size for r in by[s]} == {sum(r.size for r in by[s])}
            taken = sum(r.copies * r.size for r in by[s])
            assert abs(taken - target) <= max(r.size for r in by[s]) / 2 + 1e-6
            assert all(0 <= r.copies <= 3 for r in by[s])
        again = {(str(r.doc_id), r.size): r.copies for r in mixing.mix(sized, mixing.targets(sized)).collect()}
        assert again == {(str(r.doc_id), r.size): r.copies for r in rows}
    sized = Workspace(spark, "t").keep(mixing.sizes(none), "s")
    assert mixing.mix(sized, mixing.targets(sized)).count() == 0


def test_class_odds_expect_the_wanted_words():
    classes = [(1, 900, 900), (4, 300, 3600), (7, 50, 5000), (11, 3, 4200)]
    for wanted in (0.0, 10.0, 3000.0, 9000.0, 13_000.0, 13_700.0, 20_000.0):
        odds = mixing.class_odds(classes, wanted, 0.5)
        share = [1.0 if o == mixing.SURE else o / (1 + o) for o in odds]
        assert share == sorted(share) and all(0 <= p <= 1 for p in share)
        assert abs(sum(p * w for p, (_, _, w) in zip(share, classes)) - min(wanted, 13_700)) < 1e-6 * 13_700


def test_mixing_against_a_plain_pareto_sample(spark):
    """Ranks, certain documents and the last one taken, recomputed from the written random numbers."""
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.pow(F.col("id") % 12, F.lit(2)) + 1).cast("int")).alias("text"), F.when(F.col("id") < 2500, "a").otherwise("b").alias("source"))
    sized = Workspace(spark, "t").keep(mixing.sizes(docs).withColumn("u", mixing.uniform(F.col("doc_id"), mixing.SEED)), "s")
    u = {r.doc_id: r.u for r in sized.collect()}
    by = {}
    for r in mixing.mix(sized, mixing.targets(sized)).collect():
        by.setdefault(r.source, []).append(r)
    for rows in by.values():
        whole = int(rows[0].target // rows[0].source_size)
        wanted = rows[0].target - whole * rows[0].source_size
        classes = {}
        for r in rows:
            n, w = classes.get(r.size.bit_length(), (0, 0))
            classes[r.size.bit_length()] = n + 1, w + r.size
        known = [(c, *classes[c]) for c in sorted(classes)]
        odds = dict(zip(sorted(classes), mixing.class_odds(known, wanted, mixing.TILT)))
        rank = {r.doc_id: -1 if odds[r.size.bit_length()] == mixing.SURE else u[r.doc_id] / (1 - u[r.doc_id]) / odds[r.size.bit_length()] if wanted else 0 for r in rows}
        at, taken = 0, {}
        for r in sorted(rows, key=lambda r: (rank[r.doc_id], r.doc_id)):
            taken[r.doc_id] = at + r.size / 2 <= wanted
            at += r.size
        assert {r.doc_id: r.copies for r in rows} == {i: whole + (t or rank[i] == -1) for i, t in taken.items()}
    assert len({r.copies for r in by["b"]}) == 1 or len({r.copies for r in by["a"]}) > 1


def test_mixing_deals_capped_and_other_sources_evenly(spark, monkeypatch):
    """No bucket of a rank holds far more rows than another, whatever a source's odds."""
    seen = []
    real = mixing.bucket_totals
    monkeypatch.setattr(mixing, "bucket_totals", lambda df, *rest: seen.append(df) or real(df, *rest))
    monkeypatch.setattr(mixing, "buckets_for", lambda *_: 40)
    docs = spark.range(12_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("w "), (F.col("id") % 300 + 1).cast("int")).alias("text"), F.when(F.col("id") % 9 == 0, "b").when(F.col("id") % 40 == 0, "c").otherwise("a").alias("source"))
    sized = Workspace(spark, "t").keep(mixing.sizes(docs), "s")
    mixing.mix(sized, mixing.targets(sized)).count()
    counts = {}
    for r in seen[0].groupBy("source", "_bucket").count().collect():
        counts.setdefault(r.source, []).append(r["count"])
    assert counts and all(max(c) <= 2 * np.median(c) for c in counts.values() if np.median(c) > 50)


def mark(text):
    words = lowered(text).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def reach(marks, apart):
    label = list(range(len(marks)))
    for _ in marks:
        for i, a in enumerate(marks):
            for j, b in enumerate(marks):
                if (a ^ b).bit_count() <= apart:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_simhash_against_brute_force(spark, odd, none):
    rng = np.random.default_rng(1)
    base = rng.integers(0, 3000, 120)
    texts = [d.text for d in odd.collect()]
    for i in range(60):
        words = base.copy()
        words[rng.integers(0, 120, i % 6)] = rng.integers(0, 3000, i % 6)
        texts.append(" ".join(map(str, words)))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(simhash.near_duplicates(docs).collect(), key=lambda r: r.doc_id)
    marks = [r.mark & (1 << 64) - 1 for r in rows]
    assert marks == [mark(t) for t in texts]
    assert [r.component_id for r in rows] == reach(marks, 2)
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.near_duplicates(odd).count() == odd.count()


@pytest.mark.parametrize("apart, most", [(0, 1024), (1, 1024), (2, 1024), (2, 3), (1, 2)])
def test_links_find_every_pair_within_reach(spark, apart, most):
    rng = np.random.default_rng(apart)
    marks = {0, (1 << 64) - 1}
    for seed in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(25):
            for b in rng.integers(0, 64, int(rng.integers(0, 5))).tolist():
                seed ^= 1 << b
            marks.add(seed)
    marks = sorted(marks)
    signed = [m - (1 << 64) if m >> 63 else m for m in marks]
    edges = simhash.links(spark.createDataFrame([(m,) for m in signed], "mark long"), apart, most).collect()
    assert all((e.src ^ e.dst).bit_count() <= 2 * 8 for e in edges)
    parent = {m: m for m in signed}

    def top(m):
        while parent[m] != m:
            m = parent[m]
        return m

    for e in edges:
        parent[top(e.src)] = top(e.dst)
    assert all(((e.src ^ e.dst) & (1 << 64) - 1).bit_count() <= apart for e in edges)
    tops, label = [top(m) for m in signed], reach(marks, apart)
    assert len(set(tops)) == len(set(label)) and len(set(zip(tops, label))) == len(set(label))

import numpy as np
import pytest
from pyspark.core.broadcast import Broadcast
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_rows import lowered, mark, reach
from textloom.llm import near_copies
from textloom.llm.simhash import shingle_hashes


def alike(texts):
    """By brute force: the first text that each one reaches by five-word shingle sets of Jaccard similarity 0.8 or more."""
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (lowered(t).split() for t in texts)]
    group = list(range(len(texts)))
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if a == b or 5 * len(a & b) >= 4 * len(a | b)]
    while any(group[i] != group[j] for i, j in links):
        for i, j in links:
            group[i] = group[j] = min(group[i], group[j])
    return group


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage writes, on the smallest tables."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = [docs]
    for name, stage in corpus_pipeline.STAGES:
        at = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, made[-1], "/root/testdata/sf0.001").write.parquet(at)
        made.append(spark.read.parquet(at))
    return [[r.asDict() for r in m.collect()] for m in made], [m.columns for m in made]


def test_stages_keep_columns_and_shrink_as_named(kept):
    (docs, clean, single, apart, mixed, packed), columns = kept
    assert all(c == columns[0] for c in columns[:5])
    assert {d["doc_id"] for d in clean} <= {d["doc_id"] for d in docs}
    best = {}
    for d in clean:
        best[lowered(d["text"])] = max(best.get(lowered(d["text"]), -1), d["doc_id"])
    assert sorted(d["doc_id"] for d in single) == sorted(best.values())
    single = sorted(single, key=lambda d: d["doc_id"])
    groups = alike([d["text"] for d in single])
    assert sorted(d["doc_id"] for d in apart) == sorted(single[g]["doc_id"] for g in set(groups))
    assert {d["doc_id"] for d in mixed} <= {d["doc_id"] for d in apart}
    assert sorted({(p["doc_id"]) for p in packed}) == sorted({d["doc_id"] for d in mixed})
    assert sum(p["piece"] == 0 for p in packed) == len(mixed)
    fill = {}
    for p in packed:
        fill[p["sequence_id"]] = fill.get(p["sequence_id"], 0) + p["length"]
    assert max(fill.values()) <= 4096


def test_stages_take_odd_and_empty_tables(spark, odd, none):
    docs = odd.withColumn("_score", F.lit(1)).withColumn("copies", F.lit(9))
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "/root/testdata/sf0.001").count() > 0
        assert stage(spark, none, "/root/testdata/sf0.001").count() == 0


def test_near_copies_against_brute_force(spark):
    """Planted: texts with up to eight words replaced, most of them beyond two bits of SimHash."""
    rng = np.random.default_rng(4)
    texts = ["", " ", "one two", "ONE  two", "one two three"]
    for base in rng.integers(0, 3000, (12, 150)):
        for changes in (0, 1, 2, 3, 5, 8):
            words = base.copy()
            words[rng.integers(0, 150, changes)] = rng.integers(3000, 6000, changes)
            texts.append(" ".join(map(str, words)))
    group = alike(texts)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(group))
    assert len(set(group)) < len(set(reach([mark(t) for t in texts], 2)))


def test_near_copies_in_a_large_group_and_beside_a_common_passage(spark):
    """Planted: 300 versions of a text with up to four words replaced, some versions of versions, and a passage that others share."""
    rng = np.random.default_rng(9)
    base, passage = rng.integers(0, 3000, 160), rng.integers(0, 3000, 40)
    texts = []
    for k in range(300):
        words = base.copy()
        words[rng.integers(0, 160, k % 5)] = rng.integers(3000, 9000, k % 5)
        if k % 7 == 0:
            words[rng.integers(0, 160, 4)] = rng.integers(3000, 9000, 4)
        texts.append(" ".join(map(str, words)))
    texts += [" ".join(map(str, np.concatenate((rng.integers(9000, 99_000, 120), passage)))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(alike(texts)))


def test_joins_beyond_the_broadcast_bound_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"some text {i // 3}", i) for i in range(60)], "doc_id long, text string, _row int")
    expected = sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect())
    monkeypatch.setattr(corpus_pipeline, "BROADCAST_ROWS", 0)
    assert expected == list(range(2, 60, 3)) == sorted(r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect())


def test_the_toxicity_stage_sends_its_model_once_and_leaves_none_behind(spark, monkeypatch):
    made, ended = [], []
    send, end = type(spark.sparkContext).broadcast, Broadcast.destroy
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: made.append(send(self, value)) or made[-1])
    monkeypatch.setattr(Broadcast, "destroy", lambda self, blocking=False: ended.append(self) or end(self, blocking))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    kept = corpus_pipeline.drop_toxic(spark, docs, "/root/testdata/sf0.001")
    assert len(made) == 1 and ended == made
    assert 0 < kept.count() < docs.count()


def test_near_copies_are_first_linked_by_simhash(spark, monkeypatch):
    """Fingerprints at most two bits apart give the first links; the index of shingles adds the rest."""
    rng = np.random.default_rng(6)
    texts = ["", "  "]
    for base in rng.integers(0, 3000, (10, 600)):
        for changes in (0, 1, 1, 40):
            words = base.copy()
            words[rng.integers(0, 600, changes)] = rng.integers(3000, 6000, changes)
            texts.append(" ".join(map(str, words)))
    found, whole = [], near_copies.linked
    monkeypatch.setattr(near_copies, "linked", lambda *a, known=None, **kw: found.extend(known.collect()) or whole(*a, known=known, **kw))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(alike(texts)))
    assert len(found) >= 5
    lists = near_copies.shingle_sets(docs, "doc_id").select("row_key", "mark").collect()
    for i, mark in ((r.row_key, r.mark) for r in lists):
        shingles = set(shingle_hashes(texts[i].encode(), 5))
        assert mark % 2**64 == sum((2 * sum(h >> b & 1 for h in shingles) > len(shingles)) << b for b in range(64))
    marks = {r.row_key: r.mark % 2**64 for r in lists}
    rows = sorted(marks)
    assert any((marks[i] ^ marks[j]).bit_count() in (1, 2) for i in rows for j in rows)

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textloom.llm import toxicity
from textloom.llm.queries import op4_toxicity


def test_held_out_accuracy(spark):
    rows = op4_toxicity(spark, "/root/testdata/sf0.1").join(spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").where("held_out").collect()
    right = Counter((r.toxic, r.predicted) for r in rows)
    assert right[0, 1] <= 0.01 * (right[0, 0] + right[0, 1])
    assert right[1, 1] >= 0.8 * (right[1, 0] + right[1, 1])
    brier = sum((r.score - r.toxic) ** 2 for r in rows) / len(rows)
    assert all(0 <= r.score <= 1 for r in rows) and brier < 0.03


def test_isotonic_is_monotone_and_keeps_the_mean():
    x, y = np.arange(8.0), np.array([0, 0, 1, 0, 0, 1, 1, 1.0])
    at, value = toxicity.isotonic(x, y, np.ones(8))
    assert (np.diff(value) >= 0).all() and np.isclose(np.interp(x, at, value).sum(), y.sum())


@pytest.mark.parametrize("labelled", [0, 1, 8])
def test_odd_rows(spark, odd, none, labelled):
    labels = spark.createDataFrame([(i, i % 2) for i in range(labelled)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd, labels)
    rows = toxicity.score(odd.withColumn("Score", F.lit("clash")).withColumn("_text", F.lit("clash")), model, evidence="why").collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.score(none, toxicity.fit(none, labels)).count() == 0


def test_smallest_label_set_rejects_its_toxic_documents(spark):
    """Planted: what labels call toxic, and texts of its telling words among words no example has."""
    where = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{where}/labels.parquet")
    filler = " ".join(f"qx{chr(97 + i % 26)}{chr(97 + i // 26)}zzj" for i in range(200))
    planted = spark.createDataFrame([(10**6, filler + " pathetic idiot moron worthless clown"), (10**6 + 1, filler)], "doc_id long, text string")
    model = toxicity.fit(docs, labels)
    scored = {r.doc_id: r.score for r in toxicity.score(docs.union(planted), model).collect()}
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert sum(known.values()) == 11 and all((scored[i] >= 0.5) == bool(t) for i, t in known.items())
    assert scored[10**6] >= 0.5 > scored[10**6 + 1]


@pytest.mark.parametrize("block, dense, first", [(64, 768, (6, 24)), (4, 40, (8,)), (2, 0, (13, 20)), (7, 5000, (4, 6))])
def test_model_nearest_equals_comparing_with_every_example(spark, monkeypatch, block, dense, first):
    for name, value in (("BLOCK", block), ("DENSE", dense), ("FIRST", first), ("GATHERED", 6)):
        monkeypatch.setattr(toxicity, name, value)
    where = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{where}/documents.parquet").select("doc_id", "text")
    model = toxicity.fit(docs, spark.read.parquet(f"{where}/labels.parquet"))
    vectors = model.vectors(pa.array([r.text for r in docs.limit(40).collect()] + [None]))
    rows = np.zeros((len(model.toxic), len(model.terms)))
    for i in range(len(rows)):
        cut = slice(model.starts[i], model.starts[i + 1])
        rows[i, model.term[cut]] = model.value[cut]
    for (t, w), (places, cosines) in zip(vectors, model.nearest(vectors, 25)):
        all_ = rows[:, t] @ w.astype(float)
        kth = np.sort(all_)[-25]
        assert set(places.tolist()) == set(np.flatnonzero((all_ > 0) & (all_ >= kth - 1e-9)).tolist())
        assert np.allclose(cosines, all_[places])


def test_left_out_example_is_not_its_own_neighbour(spark):
    where = "/root/testdata/sf0.001"
    model = toxicity.fit(spark.read.parquet(f"{where}/documents.parquet"), spark.read.parquet(f"{where}/labels.parquet"))
    own = [(model.term[a:b], model.value[a:b]) for a, b in zip(model.starts[:-1], model.starts[1:])]
    rows = np.zeros((len(own), len(model.terms)))
    for i, (t, w) in enumerate(own):
        rows[i, t] = w
    cosines = rows @ rows.T
    np.fill_diagonal(cosines, 0)
    for i, (places, found) in enumerate(model.nearest(own, 5, list(range(len(own))))):
        kth = np.sort(cosines[i])[-5]
        assert set(places.tolist()) == set(np.flatnonzero((cosines[i] > 0) & (cosines[i] >= kth - 1e-9)).tolist())
        assert np.allclose(found, cosines[i][places])

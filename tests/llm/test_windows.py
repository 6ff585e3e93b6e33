from collections import Counter

import numpy as np
import pytest

from textloom.llm import blocks, substring_dedup


def plain(texts, window):
    words = [(t or "").encode().split() for t in texts]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def made(rng, n):
    passage = [f"p{i}" for i in range(60)]
    texts = []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(0, 4000, int(rng.integers(0, 200)))]
        if i % 3 == 0:
            at = int(rng.integers(0, len(words) + 1))
            words[at:at] = passage[: int(rng.integers(30, 61))]
        if i % 11 == 0:
            words += words[:50]
        texts.append(" \n".join(words))
    return texts + ["same " * 40, "Same " * 40, "solo " * 35, None, "", texts[1], texts[1]]


@pytest.mark.parametrize("block_bytes", [3000, 1 << 20])
def test_repeated_windows_against_brute_force(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(blocks, "BLOCK_BYTES", block_bytes)
    texts = made(np.random.default_rng(4), 90)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(substring_dedup.remove_repeats(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_removed, r.kept) for r in rows] == plain(texts, 35)


def test_many_ranges_and_sketch_collisions_lose_nothing(spark, monkeypatch):
    monkeypatch.setattr(blocks, "RANGE_ENTRIES", 200)
    monkeypatch.setattr(substring_dedup, "SPARE_BITS", 0)
    monkeypatch.setattr(blocks, "BLOCK_BYTES", 2000)
    texts = made(np.random.default_rng(5), 60)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = sorted(substring_dedup.remove_repeats(docs).collect(), key=lambda r: r.doc_id)
    assert [(r.n_words, r.n_removed, r.kept) for r in rows] == plain(texts, 35)


def test_odd_rows(odd, none):
    rows = substring_dedup.remove_repeats(odd).collect()
    docs = odd.collect()
    expected = zip(docs, plain([d.text for d in docs], 35))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept) for r in rows) == sorted((str(d.doc_id), *e) for d, e in expected)
    assert substring_dedup.remove_repeats(none).count() == 0

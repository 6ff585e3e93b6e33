"""Every registered opN query over the smallest tables: against its SQL, or against plain Python."""

import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.test_rows import filled, lowered, mark, reach
from tests.oracle import connect, difference
from textloom.llm.queries import ORACLE_SQL, QUERIES

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def rows(spark, name):
    return QUERIES[name](spark, SMALL).collect()


def plain(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: found.encode(t or "", add_special_tokens=False)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SMALL), ORACLE_SQL[name], connect(SMALL)) is None


def test_op2(spark, docs):
    found = rows(spark, "op2_balanced_sharding")
    data = {i: (d.text or "").encode() for i, d in docs.items()}
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in found) == sorted((i, len(b) + 16, zlib.crc32(b)) for i, b in data.items())
    slots = {}
    for r in found:
        slots.setdefault(r.shard, []).append(r.slot)
        assert (r.law, r.grown_shard) == ("rows", None)
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(s) for s in slots.values()]
    assert max(sizes) - min(sizes) <= 1
    shards, copies = {}, Counter(data.values())
    for r in found:
        shards.setdefault(data[r.doc_id], set()).add(r.shard)
    assert all(len(s) == 1 for b, s in shards.items() if 1 < copies[b] <= min(sizes))


def test_op3(spark, docs):
    whole, pieces, sequences = plain("word_bpe_49k.json"), {}, {}
    for r in rows(spark, "op3_best_fit_packing"):
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(docs)
    for i, held in pieces.items():
        ids = np.array([*whole(docs[i].text).ids, 1], "<u4")
        held.sort(key=lambda r: r.piece)
        assert [(r.piece, r.start, r.length, r.ids_crc32) for r in held] == [(n, at, len(ids[at : at + 4096]), zlib.crc32(ids[at : at + 4096].tobytes())) for n, at in enumerate(range(0, len(ids), 4096))]
    total = 0
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
        total += at
    gaps = []  # best fit decreasing, piece by piece
    for x in sorted((r.length for held in pieces.values() for r in held), reverse=True):
        best = min((g for g in gaps if g >= x), default=None)
        gaps.append((best or 4096) - x)
        if best is not None:
            gaps.remove(best)
    assert -(-total // 4096) <= len(sequences) <= len(gaps)


def test_op4(spark, docs):
    found = rows(spark, "op4_toxicity")
    assert sorted(r.doc_id for r in found) == sorted(docs)
    for r in found:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)


def test_op5(spark, docs):
    whole, counts = plain("byte_bpe_50k.json"), Counter()
    for r in rows(spark, "op5_token_counts"):
        counts[r.doc_id] += r.n_tokens
    assert all(counts[i] == len(whole(d.text).ids) for i, d in docs.items())


def test_op8(spark, docs):
    found = {r.doc_id: r for r in rows(spark, "op8_source_mixing")}
    sizes = {i: len((d.text or "").encode().split()) for i, d in docs.items()}
    order = sorted({d.source for d in docs.values()}, key=lambda s: (s is None, (s or "").encode()))
    held = {s: sum(sizes[i] for i, d in docs.items() if d.source == s) for s in order}
    goal = dict(zip(order, filled([held[s] for s in order], [(5, 2, 1)[k % 3] for k in range(len(order))], 3)))
    taken, longest = Counter(), Counter()
    for i, d in docs.items():
        r = found[i]
        assert (r.size, r.source_size) == (sizes[i], held[d.source]) and abs(r.target - goal[d.source]) < 1e-6 * max(1, r.target)
        assert r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size
        taken[d.source] += r.taken
        longest[d.source] = max(longest[d.source], r.size)
    assert all(abs(taken[s] - goal[s]) <= longest[s] / 2 + 1e-6 for s in order)
    assert {r.doc_id: r.taken for r in rows(spark, "op8_source_mixing")} == {i: r.taken for i, r in found.items()}


def test_op9(spark, docs):
    found = sorted(rows(spark, "op9_simhash_near_dedup"), key=lambda r: r.doc_id)
    ids = [r.doc_id for r in found]
    marks = [mark(docs[i].text) for i in ids]
    assert [r.fingerprint for r in found] == [f"{m:016x}" for m in marks]
    assert [r.component_id for r in found] == [ids[g] for g in reach(marks, 2)]


def test_op10(spark, docs):
    whole, start, expected = plain("byte_bpe_50k.json"), 0, []
    for i in sorted(docs):
        ids = np.array([*whole(docs[i].text).ids, 0], "<u4")
        expected.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in rows(spark, "op10_token_files")) == expected


def test_lowered_is_ascii_only():
    assert lowered("AÉ") == "aÉ".encode()

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from textloom.llm import packing, token_counts, token_files
from textloom.llm.encoding import encoder
from textloom.session import Workspace


def plain(name):
    found = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: found.encode(t or "", add_special_tokens=False)


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    pick, mine, whole = random.Random(5), encoder(name), plain(name)
    letters = ["a", "B", "é", "Σ", "ς", "İ", " ", "  ", "\n", "\n\n", "\t", "'s", "'", "12", "!", "\xa0", "\x1c", "\0", "<|endoftext|>", "<|startoftext|>", "<|", "漢", "😀", "\r\n"]
    for _ in range(1500):
        text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 9)))
        assert mine.ids(text).tolist() == whole(text).ids, repr(text)
        if not mine.words:
            assert list(map(tuple, mine.spans(text).tolist())) == whole(text).offsets, repr(text)


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 3000])
def test_segment_round_trip(n):
    rng = np.random.default_rng(n)
    for high in (1, 300, 50_257, 2**32 - 1):
        ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32) >> rng.integers(0, 9, n).astype(np.uint32)
        data = token_files.encode_segment(ids)
        assert token_files.decode_segment(data).tolist() == ids.tolist()
        for k in range(-(-n // token_files.BLOCK)):
            assert token_files.decode_block(data, k).tolist() == ids[k * 256 : k * 256 + 256].tolist()


def test_token_files_against_plain_encoding(spark, odd, none):
    path = Workspace(spark, "test").path("files")
    token_files.write_token_files(odd, path)
    rows = token_files.read_token_files(spark, path).collect()
    whole, start = plain("byte_bpe_50k.json"), 0
    expected = []
    for r in sorted(odd.collect(), key=lambda r: -1 if r.doc_id is None else r.doc_id):
        ids = np.array([*whole(r.text).ids, 0], "<u4")
        expected.append((r.doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(((r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in rows), key=lambda x: x[1]) == expected
    token_files.write_token_files(none, path := Workspace(spark, "test").path("files"))
    assert token_files.read_token_files(spark, path).count() == 0


def test_packing(spark, odd, none):
    rows = packing.pack(odd.unionByName(odd), capacity=64).collect()
    whole = plain("word_bpe_49k.json")
    documents, sequences = {}, {}
    for r in rows:
        assert np.frombuffer(r.ids, "<u4").size == r.length <= 64
        documents.setdefault(r.row_key, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    texts = []
    for pieces in documents.values():
        pieces.sort(key=lambda r: r.piece)
        assert [r.start for r in pieces] == [64 * i for i in range(len(pieces))]
        assert all(r.length == 64 for r in pieces[:-1])
        texts.append((str(pieces[0].doc_id), np.frombuffer(b"".join(r.ids for r in pieces), "<u4").tolist()))
    assert sorted(texts) == sorted((str(r.doc_id), [*whole(r.text).ids, 1]) for r in odd.collect() * 2)
    for members in sequences.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 64
    assert packing.pack(none).count() == 0


def test_plan_uses_every_length_and_packs_tightly():
    rng = np.random.default_rng(3)
    for n, most in ((0, 10), (7, 64), (500, 64), (20_000, 4096)):
        lengths = rng.integers(1, most + 1, n)
        counts = dict(zip(*(x.tolist() for x in np.unique(lengths, return_counts=True))))
        used: dict[int, int] = {}
        made = packing.plan(counts, most)
        for times, each in made:
            assert sum(each) <= most
            for x in each:
                used[x] = used.get(x, 0) + times
        assert used == counts
        gaps: list[int] = []  # best fit decreasing, item by item
        for x in sorted(lengths.tolist(), reverse=True) if n < 1000 else ():
            best = min((g for g in gaps if g >= x), default=None)
            gaps.append((best or most) - x)
            if best is not None:
                gaps.remove(best)
        assert n >= 1000 or sum(t for t, _ in made) <= len(gaps)
    ordinary = np.minimum(rng.lognormal(6.5, 1.2, 50_000).astype(int) + 1, 4096)
    made = packing.plan(dict(zip(*(x.tolist() for x in np.unique(ordinary, return_counts=True)))))
    assert sum(t for t, _ in made) <= -(-int(ordinary.sum()) // 4096) + 2


def test_token_counts_against_direct_attribution(spark, odd, none):
    rows = token_counts.token_counts(odd.where("doc_id <> 4"), fields=("text", "lang")).collect()
    whole, by = plain("byte_bpe_50k.json"), {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
    for d in odd.where("doc_id <> 4").collect():
        text = f"{d.text or ''}\n{d.lang or ''}"
        sections = sorted(by[d.doc_id], key=lambda r: r.start)
        assert "".join(text[r.start : r.end] for r in sections) == text
        counts, crossing = [0] * len(sections), [0] * len(sections)
        for a, b in whole(text).offsets:
            shares = [max(0, min(b, r.end) - max(a, r.start)) for r in sections]
            counts[shares.index(max(shares))] += 1
            crossing[shares.index(max(shares))] += sum(s > 0 for s in shares) > 1
        assert [r.n_tokens for r in sections] == counts
        assert [r.n_crossing for r in sections] == crossing
    assert token_counts.token_counts(none).count() == 0

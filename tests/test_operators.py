import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from textloom.functions import code, ner, pii, sequences
from textloom.functions import text as T
from textloom.operators import components, discussions, evaluation, fim, graph, interactions, lines, minhash, ranking, testcases, vocabulary
from textloom.sources import files, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_known_values(spark):
    assert one(spark, T.hash32(F.lit("hello"))) == 499578026
    assert minhash.band_shape(0.7, 256) == (25, 10) and minhash.band_shape(0.7, 128) == (14, 9)
    assert minhash.band_shape(0.8, 128) == (9, 13) and minhash.band_shape(0.58, 128) == (21, 6)
    letters = F.array(*map(F.lit, "abcd"))
    assert len(one(spark, T.shingles(letters, 2))) == 3 and len(one(spark, T.shingles(letters, 3))) == 2 and one(spark, T.shingles(letters, 5)) == []
    sets = [F.array_remove(F.array_distinct(T.pieces(F.lit(s))), "") for s in ("a = 1", "a = 2")]
    assert one(spark, T.jaccard(*sets)) == pytest.approx(1 / 3) and one(spark, T.jaccard(sets[0], sets[0])) == 1.0


def test_windows_join_to_the_text(spark):
    pick = random.Random(1)
    for _ in range(50):
        text = "".join(pick.choice("ab \n") for _ in range(pick.randint(0, 300)))
        assert "".join(lines._greedy_windows(text, 40, 10)) == text
    assert "".join(one(spark, T.fixed_windows(F.lit("abcdefg"), 3))) == "abcdefg" and one(spark, T.fixed_windows(F.lit(""), 3)) == []


def test_clean_text_rules():
    assert lines.clean_text("****** ----- \n\n\n\nx", False) == "* - \nx"
    assert lines.clean_text("v = 0xFF;", False) == "v = <|HEX-255|>;"
    assert lines.clean_text("aaaaaaa", False) == "<|MULTI-7-a|>" and lines.clean_text("x          y", False) == "x          y"
    assert lines.clean_text("same line\nSAME LINE\nother", False) == "same line\nother"
    assert lines.clean_text("[1, 2, 3]", True) == "<|MULTIARRAY|>" and lines.clean_text("[1, 2, 3]", False) == "[1, 2, 3]"
    assert lines.clean_text(r"\x0a\x0b\x0c", False) == "<|MULTIHEX|>"


def test_ranks_have_no_gaps(spark):
    rows = spark.range(5000).select(F.col("id"), (F.col("id") % 3).alias("s"), F.pmod(F.xxhash64("id"), F.lit(7)).cast("int").alias("b"))
    found = ranking.ranked(rows, ["s"], "b", ["id"]).collect()
    for s in range(3):
        assert sorted(r["rank"] for r in found if r.s == s) == list(range(sum(r.s == s for r in found)))


def test_components_against_union_find(spark):
    rng = np.random.default_rng(0)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(i, i + 1) for i in range(200, 240)] + [(300, i) for i in range(301, 340)] + [(7, 7), (999, 999)]
    parent: dict[int, int] = {}

    def top(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = sorted((top(a), top(b)))
        parent[b] = a
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame([*pairs, (None, 3)], "src long, dst long")).collect()}
    assert got == {n: min(m for m in parent if top(m) == top(n)) for n in parent}


def test_pii_spans_and_redaction(spark):
    text = 'mail ann@corp.org or 10.1.2.3, 93.184.216.34\ntoken = "9f8e7d6c5b4a39281706f5e4d3c2b1a098765432" v 1.2.3.4'
    spans = pii.all_spans(text)
    assert [(t, v) for t, v, *_ in spans] == [("EMAIL", "ann@corp.org"), ("IP_ADDRESS", "10.1.2.3"), ("IP_ADDRESS", "93.184.216.34"), ("KEY", "9f8e7d6c5b4a39281706f5e4d3c2b1a098765432")]
    row = pii.scan_and_redact(spark.createDataFrame([(1, text), (2, "clean"), (3, None), (4, "a@b.co,c@d.co")], "doc_id long, text string")).orderBy("doc_id").collect()
    assert "10.1.2.3" in row[0].new_text and not {"ann@corp.org", "93.184.216.34"} & set(row[0].new_text.split()) and "9f8e7d" not in row[0].new_text
    assert row[1].new_text == "clean" and not row[1].modified and row[2].number_secrets == 0
    assert row[3].number_secrets == 2 and row[3].modified


def test_fim_samples_join_to_the_source():
    text = "\n".join(f"value_{i} = compute_something({i}) + {i}" for i in range(60))
    head, middle, tail = fim.line_sample(text, "k")
    assert text.startswith(head + middle + tail)
    source = "\n".join(f"def f{i}(x):\n    y = x + {i}\n    return call(y, {i})\n" + "# pad\n" * 200 for i in range(6))
    for p, m, s in fim.tree_samples(source, "k"):
        assert p + m + s in source


def test_fim_parts_rejoin_to_the_whole_text(spark):
    text = "\n".join(f"value_{i} = compute_something({i}) + {i}" for i in range(700)) + "\n" + "wide " * 2000 + "\nlast line of the text\n"
    parts = fim.line_parts(text, "k")
    assert "".join(p if isinstance(p, str) else "".join(p) for p in parts) == text
    assert sum(isinstance(p, tuple) for p in parts) > 5 and fim.line_parts("", "k") == []
    rows = fim.samples(spark.createDataFrame([(1, text, "c"), (2, "", "c"), (3, None, "c")], "doc_id long, text string, lang string"), plain_share=0).collect()
    assert sum(r.kind == "fim" for r in rows if r.doc_id == 1) > 5 and {r.doc_id for r in rows} == {1, 2, 3}
    joined = ""
    for r in sorted((r for r in rows if r.doc_id == 1), key=lambda r: r.part):
        if r.kind == "fim":
            head, rest = r.sample[len(fim.BEGIN) :].split(fim.HOLE)
            tail, middle = rest.removesuffix(fim.STOP).split(fim.END)
            joined += head + middle + tail
        else:
            joined += r.sample
    assert joined == text


def test_order_puts_imports_first():
    nodes, edges = list("abcdef"), [("a", "b"), ("b", "c"), ("a", "d"), ("e", "f"), ("f", "e")]
    order = graph.order_files(nodes, edges)
    assert sorted(order) == nodes
    assert all(order.index(b) < order.index(a) for a, b in edges if {a, b} != {"e", "f"})


def test_code_functions_and_testcases(spark):
    lib = "import os\nfrom a.b import c\n\ndef helper(x):\n    y = x + 1\n    return y\n\ndef tested(x):\n    z = helper(x)\n    return z\n\ndef _private():\n    a = 1\n    return a\n"
    test = "from lib import tested\n\ndef test_it():\n    r = tested(1)\n    assert r == 2\n"
    assert code.python_imports(lib) == ["os", "a.b"] and [f["name"] for f in code.python_functions(lib)] == ["helper", "tested"]
    rows = spark.createDataFrame([("r", "python", "src/lib.py", lib), ("r", "python", "tests/test_lib.py", test)], "repo string, lang string, path string, content string")
    case = testcases.prompts(testcases.testcases(testcases.functions_of(rows))).first()
    assert (case.test_name, case.tested_name, case.depends[0]["name"]) == ("test_it", "tested", "helper") and "helper" in case.prompt_context
    assert one(spark, code.with_sibling_sources(F.array(F.lit("a.h"), F.lit("b.hpp"), F.lit("c")))) == ["a.h", "a.c", "b.hpp", "b.cpp", "c"]
    book = '{"cells": [{"cell_type": "code", "source": ["x = 1\\n", "y"]}, {"cell_type": "markdown", "source": ["t"]}, {"cell_type": "code", "source": "z"}]}'
    assert one(spark, code.notebook_script(F.lit(book))) in ("x = 1\ny\n\nz", "x = 1\ny")


def test_answers():
    prefix, suffix = "first line\nthe quick brown fox jumps over it\n", "after this\n"
    assert interactions.extract_answer(prefix, suffix, prefix + "answer here\n" + suffix) == ("answer here\n", "search")
    assert interactions.extract_answer("ab\n", suffix, "x")[1] == "short_context"


def test_commits_and_discussions(spark):
    old = "\n".join(f"line {i} of the file" for i in range(40))
    new = old.replace("line 5 of", "line five of").replace("line 9 of", "line nine of")
    rows = spark.createDataFrame([(1, "Fix the off by one error here", old, new, "me/a,you/b"), (2, "v1.2.3", old, new, "you/b"), (3, "Update readme now", old, new, "x/y")], "id long, subject string, old_contents string, new_contents string, repos string")
    kept = discussions.commit_sample(discussions.commit_filter(rows), "id").collect()
    assert [r.id for r in kept] == [1] and kept[0].change.inserted == 2 and kept[0].content.startswith("<commit_before>")
    left = discussions.without_opted_out(rows, spark.createDataFrame([("YOU",)], "owner string"), "id").collect()
    assert {(r.id, r.repos) for r in left} == {(1, "me/a"), (3, "x/y")}


def test_ner_windows_and_entities(spark):
    assert [r.start for r in one(spark, ner.windows(F.array(*map(F.lit, range(10))), 4, 1))] == [0, 3, 6]
    truth = [(4, 12, "NAME")]
    spans = [(0, 3), (4, 7), (8, 12), (13, 15)]
    labels = ner.label_tokens(spans, truth)
    assert labels == ["O", "B-NAME", "I-NAME", "O"] and ner.entities(labels, spans, [1.0] * 4) == [{"tag": "NAME", "start": 4, "end": 12, "score": 1.0}]
    assert np.allclose(ner.combine([(0, np.zeros((3, 2))), (2, np.zeros((2, 2)))], 4), 0.5)
    model = lambda batch: [np.array([[0.0, 9.0] if t == "Ann" else [9.0, 0.0] for t in w]) for w in batch]
    docs = spark.createDataFrame([(1, "hello Ann !"), (2, None)], "doc_id long, text string")
    assert {r.doc_id: [e["value"] for e in r.entities] for r in ner.recognise(docs, model, ["O", "B-NAME"]).collect()} == {1: ["Ann"], 2: []}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "src/dep/repo/.git").mkdir(parents=True)
    (tmp_path / "src/dep/repo/a.py").write_text("x = 1\n")
    (tmp_path / "src/dep/repo/.git/config").write_text("hidden")
    (tmp_path / "src/dep/repo/b.bin").write_bytes(b"\xff\xfe")
    found = files.repositories(files.text_files(spark, str(tmp_path / "src"))).collect()
    assert [(r.path, r.extension, r.department, r.repo, r.n_lines) for r in found] == [("dep/repo/a.py", "py", "dep", "repo", 2)]
    (tmp_path / "log.txt").write_text("stars: 10 -> 4\nnoise\nINFO size: 4 -> 3\n")
    assert {(r["filter"], r.before, r.after) for r in files.log_statistics(spark, str(tmp_path / "log.txt")).collect()} == {("stars", 10, 4), ("size", 4, 3)}
    (tmp_path / "rules.csv").write_text("extension,language,Include,Alphanum_threshold,Long_line_threshold,Alpha filter\npy,Python,1,0.3,500,\nxx,C#,0,none,,0.2\n")
    rules = {r.extension: r for r in files.rule_table(spark, str(tmp_path / "rules.csv")).collect()}
    assert (rules["py"].line_mean, rules["py"].alnum, rules["xx"].lang, rules["xx"].alnum, rules["xx"].alpha) == (100.0, 0.3, "c-sharp", None, 0.2)
    rows = spark.range(100).withColumn("n", F.lit(10))
    grouped = sinks.sized_groups(rows, "n", "id", 250).collect()
    assert {r.id: r.file_no for r in grouped} == {i: 10 * i // 250 for i in range(100)}
    sinks.save(rows, str(tmp_path / "out"), "json", rows_per_file=30)
    assert spark.read.json(str(tmp_path / "out")).count() == 100
    assert sinks.save_shards(rows.withColumn("t", F.lit("x")), str(tmp_path / "shards"), "t", "id") == 1


def test_stream_drops_what_was_seen(spark, tmp_path):
    from textloom.streaming import incremental

    base = " ".join(f"word{i}" for i in range(80))
    for n, rows in enumerate([[(1, base), (2, base + " x")], [(3, base), (4, "other " * 3 + " ".join(f"new{i}" for i in range(60)))]]):
        spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("doc_id long, text string").parquet(str(tmp_path / "in"))
        incremental.dedup_stream(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert {r.doc_id for r in spark.read.parquet(str(tmp_path / "out/docs")).collect()} == {1, 4}


def test_keep_first_and_bands(spark):
    rows = spark.createDataFrame([("a", 2), ("a", 1), (None, 5), (None, 4)], "k string, o int")
    assert {(r.k, r.o) for r in vocabulary.keep_first(rows, ["k"], ["o"]).collect()} == {("a", 1), (None, 4)}
    words = spark.createDataFrame([("a",), ("ab",), ("abcdefg",), ("x" * 40,)], "w string").select(vocabulary.word_band("w").alias("b")).collect()
    assert [r.b for r in words] == [None, 6, 11, 1000]


def test_sequences():
    assert sequences.is_subsequence([1, 3], [1, 2, 3]) and not sequences.is_subsequence([3, 1], [1, 2, 3])
    assert sequences.repeated_subsequence("abcdexabcde") == ("abcde", 2) and sequences.repeated_subsequence("abcdefghijkl") is None
    source = "a = 'x\\'\\n'\nb = \"\"\"one\ntwo\"\"\"\nc"
    assert sequences.code_lines(source) == source.split("\n")[:1] + ['b = """one\ntwo"""', "c"] and "\n".join(sequences.code_lines(source)) == source


def test_evaluation_set(spark):
    rows = spark.range(400).select(F.col("id"), (F.col("id") % 30).cast("string").alias("filename"), F.lit("p").alias("prompt"), (F.col("id") % 90).cast("string").alias("answer"))
    found = evaluation.evaluation_set(rows, files=10, rows_most=100, keep=20).collect()
    assert 0 < len(found) <= 20 and len({r.filename for r in found}) <= 10 and len({r.answer for r in found}) == len(found)
    scores = evaluation.prompt_scores(rows.withColumn("same", F.col("answer")), "answer", ["same", "prompt"]).collect()
    assert {r.variant: r["mean"] for r in scores} == {"same": 100.0, "prompt": 0.0}


def test_components_in_one_task_equal_those_of_rounds(spark, monkeypatch):
    rng = np.random.default_rng(8)
    edges = [(int(a), int(b)) for a, b in rng.integers(-300, 300, (250, 2))] + [(900 + i, 901 + i) for i in range(60)] + [(5000, 5000)]
    table = spark.createDataFrame([*edges, (None, 1)], "src long, dst long").repartition(3)
    label = {x: x for e in edges for x in e}
    while any(label[a] != label[b] for a, b in edges):
        for a, b in edges:
            label[a] = label[b] = min(label[a], label[b])
    asked = []
    monkeypatch.setattr(components, "_large_star", lambda e, whole=components._large_star: asked.append(1) or whole(e))
    assert {r.node: r.component for r in components.connected_components(table).collect()} == label and not asked
    assert components.connected_components(table.where("src > 9999")).count() == 0
    monkeypatch.setattr(components, "ONE_TASK", 0)
    assert {r.node: r.component for r in components.connected_components(table).collect()} == label and asked

"""Registered queries without a DuckDB twin, against plain Python on the smallest tables."""

import hashlib
import io
import random
import re
import tarfile
import zipfile
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
from textloom.functions import parsers, sequences
from textloom.operators import discussions, filters, fim, graph, lines, minhash
from textloom.operators import rows as R
from textloom.plans import queries
from textloom.sources import files, sinks

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def rows(spark, name):
    return entry.queries()[name](spark, SMALL).collect()


def grams(text):
    pieces = re.split("[^A-Za-z_0-9]", text)
    return {" ".join(pieces[i : i + 5]) for i in range(len(pieces) - 4)}


def test_every_query_is_compared_somewhere():
    here = {"duplicate_line_collapse", "regex_clean", "window_split_lines", "minhash_bands_exact", "near_dup_edges", "near_dup_components", "near_dup_survivors"}
    here |= {"pii_full", "pii_redact", "dep_topo_level", "dep_topo_order", "fim_samples", "bot_filter", "repeated_runs", "decontam_lsh", "char_run_counts"}
    assert {n for n in queries.QUERIES if n not in queries.ORACLE_SQL} <= here


def test_duplicate_line_collapse(spark, texts):
    for r in rows(spark, "duplicate_line_collapse"):
        kept = []
        for line in texts[r.doc_id].split("\n"):
            if not (kept and len(line) >= 5 and line.lower() == kept[-1].lower()):
                kept.append(line)
        assert r.text == "\n".join(kept)


def test_window_split_lines(spark, texts):
    parts = {}
    for r in rows(spark, "window_split_lines"):
        parts.setdefault(r.doc_id, []).append((r.part, r.piece))
    for i, text in texts.items():
        pieces = [p for _, p in sorted(parts.get(i, []))]
        assert "".join(pieces) == text and all(len(p) >= 2000 for p in pieces[:-1])


def test_regex_clean_rows(spark, texts):
    found = rows(spark, "regex_clean")
    assert len(found) == len(texts) and all(r.text == lines.clean_text(texts[r.doc_id], False) for r in found)
    assert not any(re.search(r"[*]{3}|-{3}|\n{3}|(.)\1{5}", re.sub(r"<\|MULTI[^|]*\|>|[ \t]{6,}", "", r.text)) for r in found)


@pytest.mark.parametrize(
    "text, cleaned",
    [
        ("[1]", "<|MULTIARRAY|>"), ("[1 2 3]", "<|MULTIARRAY|>"), ("[1, 2, 3, ]", "<|MULTIARRAY|>"), ("[-1]", "[-1]"), ("id 1234567890", "id <|MULTINUM|>"),
        ("1.234567f, 2.345678f", "<|MULTIFLOAT|>"), ("1.234567", "<|FLOAT|>"), ("1.5f 2.5f", "1.5f 2.5f"), ("0,\n" * 6, "<MULTIZERO>"),
        ("'" + "AB" * 2 + "CDEFGHIJKLMNOPQRSTUV'", "<|MULTI-upperstring-26|>"), ('"abcdefghij klmnopqrst"', "<|MULTI-lowerstring-23|>"), ("'12345 67890'", "<|MULTI-number-13|>"),
        ("0x1F", "<|HEX-31|>"), ("aaaaaa", "<|MULTI-6-a|>"), ("abababababab", "<|MULTI-6-ab|>"), ("\t\t\t\t\t\t", "\t\t\t\t\t\t"), ("a line\nA LINE\nb", "a line\nb"),
    ],
)
def test_rules_of_test_files(text, cleaned):
    assert lines.clean_text(text, True) == cleaned


def test_minhash_signatures(spark, texts):
    """By the formula, in whole numbers, for some documents."""
    draw = np.random.RandomState(42)
    pairs = [(int(draw.randint(1, (1 << 61) - 1, dtype=np.uint64)), int(draw.randint(0, (1 << 61) - 1, dtype=np.uint64))) for _ in range(128)]
    bands, size = minhash.band_shape()
    found = {}
    for r in rows(spark, "minhash_bands_exact"):
        found[r.doc_id, r.band] = r.key
    assert {i for i, _ in found} == {i for i, t in texts.items() if grams(t)}
    for i in [i for i, t in texts.items() if grams(t)][:12]:
        hashes = [int.from_bytes(hashlib.sha1(g.encode()).digest()[:4], "little") for g in grams(texts[i])]
        signature = [min(((h * a + b) % (1 << 64)) % ((1 << 61) - 1) & ((1 << 32) - 1) for h in hashes) for a, b in pairs]
        for band in range(bands):
            assert found[i, band] == "".join(f"{x:016X}" for x in signature[band * size : band * size + size])


def test_near_duplicates(spark, texts):
    sets = {i: grams(t) for i, t in texts.items()}
    alike = {(i, j) for i in sets for j in sets if i > j and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    group = {i: i for i in sets}
    while any(group[i] != group[j] for i, j in alike):
        for i, j in alike:
            group[i] = group[j] = min(group[i], group[j])
    assert alike
    assert {(r.src, r.dst) for r in rows(spark, "near_dup_edges")} <= alike
    assert {r.node: r.component for r in rows(spark, "near_dup_components")} == {i: group[i] for pair in alike for i in pair}
    assert sorted(r.doc_id for r in rows(spark, "near_dup_survivors")) == sorted(set(group.values()))


def test_pii_spans_and_redaction(spark, texts):
    by = {}
    for r in rows(spark, "pii_full"):
        assert texts[r.doc_id][r.start : r.end] == r.value
        by.setdefault(r.doc_id, set()).add((r.tag, r.value))
    simple = re.compile(r"(?<![\w.+%@-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}(?![\w@-])")
    assert all(("EMAIL", m) in by.get(i, ()) for i, t in texts.items() for m in simple.findall(t))
    for r in rows(spark, "pii_redact"):
        assert all(v not in r.new_text for tag, v in by.get(r.doc_id, ()) if tag == "EMAIL")
        assert (r.number_secrets > 0) == (r.doc_id in by)


def levels_of(edges):
    """Longest ways below each node of a graph without cycles."""
    below = {}
    for a, b in edges:
        below.setdefault(a, set()).add(b)
        below.setdefault(b, set())
    found = {}

    def level(n):
        if n not in found:
            found[n] = max((level(m) + 1 for m in below[n]), default=0)
        return found[n]

    return {n: level(n) for n in below}


def test_topological_order_and_levels(spark):
    edges = {(r.src, r.dst) for r in queries._deps(spark, SMALL).collect()}
    place = {r.node: (r.component, r.place) for r in rows(spark, "dep_topo_order")}
    assert set(place) == {n for e in edges for n in e}
    assert all(place[a][0] == place[b][0] and place[a][1] > place[b][1] for a, b in edges)
    assert {r.node: r.level for r in rows(spark, "dep_topo_level")} == levels_of(edges)


def test_levels_end_on_cycles(spark):
    edges = [(0, 1), (1, 2), (2, 1), (3, 1), (4, 3), (5, 6), (6, 7), (7, 5), (7, 8), (9, 9)]
    found = {r.node: r.level for r in graph.topological_levels(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert found == {0: 1, 1: 0, 2: 1, 3: 1, 4: 2, 8: 0, 5: 0, 7: 1, 6: 2, 9: 0}


def test_fim_samples(spark, texts):
    found = {}
    for r in rows(spark, "fim_samples"):
        found.setdefault(r.doc_id, []).append(r)
    assert set(found) <= set(texts) and all(texts[i] == "" or i in found for i in texts)


def test_bot_filter(spark):
    by = {}
    for r in spark.read.parquet(f"{SMALL}/conversations.parquet").collect():
        by.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    expected = {}
    for i, events in by.items():
        kept, last = [], 0
        for n, (_, role, text) in enumerate(sorted(events)):
            if role != "system":
                kept.append(text)
                continue
            if 0 < last < n - 1 and kept and ("build-bot" in kept[-1] or kept[-1].startswith("/")):
                kept.pop()
            last = n
        if kept:
            expected[i] = len(kept)
    assert {r.conv_id: r.n_events for r in rows(spark, "bot_filter")} == expected


def repeated(text):
    for size in range(5, len(text) // 2 + 1):
        for i in range(len(text) - size + 1):
            rest = iter(text[:i] + text[i + size :])
            if all(c in rest for c in text[i : i + size]):
                return text[i : i + size], text.count(text[i : i + size])
    return None


def test_repeated_runs(spark, texts):
    pick = random.Random(3)
    for _ in range(300):
        text = "".join(pick.choice("abcdefg") for _ in range(pick.randint(0, 24)))
        assert sequences.repeated_subsequence(text) == repeated(text), text
    for r in rows(spark, "repeated_runs"):
        assert (r.part, r.n) == (sequences.repeated_subsequence(texts[r.doc_id]) or (None, None))


@pytest.mark.parametrize(
    "text, left",
    [
        (None, ""), ("  plain  ", "plain"), ("keep\nFrom: a\nReply to this email directly, or view it on GitHub DROPME\ntail", "keep"),
        ("mine\nSigned-off-by: A <a@b.c>\nbelow", "mine\nbelow"), ("top\n> quoted\nbottom", "bottom"), ("a\n____________________\nb", "a\n\nb"),
        ("x\n1/2/2020 10:30 AM A wrote\ny\nReply to this email directly:\nlink\nz", "x\nz"), ("one\nReply to this email directly\ntwo", "two"),
    ],
)
def test_replies(spark, text, left):
    row = spark.createDataFrame([(text,)], "t string").select(discussions.without_reply("t").alias("x")).first()
    assert row.x == left


def test_rules_do_not_clash_with_columns(spark):
    docs = spark.createDataFrame([("en", "word " * 30, 7)], "lang string, text string, include int")
    rules = spark.createDataFrame([("en", 1, 900, 900, 0.1, 0.1)], "lang string, include int, line_max int, line_mean int, alnum double, alpha double")
    assert filters.basic_by_rule(docs, rules, ["lang"]).columns == docs.columns and filters.basic_by_rule(docs, rules, ["lang"]).count() == 1


def test_decontam_lsh(spark, texts):
    """What is found is right, and of all alike pairs hardly one is missed."""
    items = {r.item_id: r.text for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    def tokens(t):
        return {p for p in re.split("[^A-Za-z_0-9]", t or "") if p}

    def share(a, b):
        return len(a & b) / max(1, len(a | b))

    alike = {(i, j): share(tokens(t), tokens(s)) for i, t in texts.items() for j, s in items.items()}
    alike = {k: v for k, v in alike.items() if v >= 0.58}
    found = {(r.doc_id, r["item"]): r.similarity for r in rows(spark, "decontam_lsh")}
    assert all(abs(alike[k] - v) < 1e-9 for k, v in found.items()) and len(found) >= 0.8 * len(alike)


def test_char_run_counts(spark, texts):
    expected = set()
    for i, text in texts.items():
        n, at = Counter(), 0
        while at < len(text):
            end = at
            while end < len(text) and text[end] == text[at]:
                end += 1
            if end - at > 2 and end < len(text):
                n[text[at] * (end - at - 1)] += 1
            at = end
        expected |= {(i, s, c) for s, c in n.items() if c > 5}
    assert {(r.doc_id, r.span, r.n) for r in rows(spark, "char_run_counts")} == expected


def test_filters_by_name():
    named = {"size": lambda d: d, "basic": lambda d: d, "basic_by_rule": lambda d: d}
    assert R.chosen(named, "basic*, size") == ["size", "basic", "basic_by_rule"] and R.chosen(named, ["basic"]) == ["basic"]
    with pytest.raises(ValueError, match="stars"):
        R.chosen(named, "stars,size")


def test_index_and_samples(spark):
    docs = spark.range(500).selectExpr("id", "id % 3 = 0 modified")
    assert sorted(r["index"] for r in R.with_index(docs, "id").collect()) == list(range(500))
    assert [r.id for r in R.shuffled(docs, "id").collect()] == [r.id for r in R.shuffled(docs.repartition(7), "id").collect()]
    some = [r.id for r in R.changed_sample(docs, 20, "id").collect()]
    assert len(set(some)) == 20 and all(i % 3 == 0 for i in some)


def test_copies_and_parts(spark, tmp_path):
    rows_ = spark.createDataFrame([(i, f"src/{'test_' if i % 4 == 0 else ''}{i}.py") for i in range(40)], "id long, path string")
    R.save_copies(rows_, f"{tmp_path}/c", [5, 100], ["id"])
    assert [r.id for r in spark.read.json(f"{tmp_path}/c/first_5").orderBy("id").collect()] == [0, 1, 2, 3, 4] and spark.read.json(f"{tmp_path}/c/first_100").count() == 40
    R.save_with_part(rows_, f"{tmp_path}/p", "path", "test_")
    assert spark.read.json(f"{tmp_path}/p/part").count() == 10 and spark.read.json(f"{tmp_path}/p/all").count() == 40


def test_parsers_are_pluggable():
    source = "# é漢字\nclass A:\n    def f(self, x):\n        return g(x) + 'é'\n"
    nodes = parsers.python_nodes(source)
    data = source.encode()
    assert [n.names for n in nodes if n.names] == [("A",), ("f",)] and data[nodes[0].start : nodes[0].end].decode() == source
    assert any(data[n.start : n.end].decode() == "g(x) + 'é'" for n in nodes)
    for prefix, middle, suffix in fim.tree_samples(source, "k"):
        assert prefix + middle + suffix in source
    assert fim.tree_samples("one\ntwo words here\n", "k", lang="lines") == []
    parsers.register("Lines", lambda s: [parsers.Node("block", "line", 4, 18)])
    assert fim.tree_samples("one\ntwo words here\n", "k", lang="lines") == [("one\n", "two words here", "\n")]


def test_repository_facts(spark):
    rows_ = [("[core]\n\tx = 1\n[remote]\n\turl = https://me:pw@host.org/a/b.git\n", "ref: refs/heads/main\n", "0123456789abcdef\n"), ("none", "0123456", "")]
    found = spark.createDataFrame(rows_, "c string, h string, r string").select(files.origin_of("c"), files.branch_of("h"), files.revision_of("r")).collect()
    assert [tuple(r) for r in found] == [("https://host.org/a/b.git", "main", "0123456"), ("", "", "")]
    placed = files.projects(spark.createDataFrame([("p/a.py",), ("top.py",)], "path string"), "/data/dep/repos/").collect()
    assert [(r.project, r.department) for r in placed] == [("p", "dep")]


def test_archives_sheets_and_shards(spark, tmp_path):
    (tmp_path / "tars").mkdir()
    with tarfile.open(tmp_path / "tars" / "repo.tar.gz", "w:gz") as tar:
        for name, data in (("r/a.py", b"x = 1"), ("r/b/c.txt", b"")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            tar.addfile(info, io.BytesIO(data))
    assert {(r.path, bytes(r.content)) for r in files.archive_files(spark, str(tmp_path / "tars")).collect()} == {("r/a.py", b"x = 1"), ("r/b/c.txt", b"")}
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    with zipfile.ZipFile(tmp_path / "notes.xlsx", "w") as book:
        book.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}"><si><t>name</t></si><si><t>point</t></si><si><t>steps</t></si><si><t>test_a</t></si></sst>')
        head = "".join(f'<c r="{c}1" t="s"><v>{i}</v></c>' for i, c in enumerate("ABC"))
        book.writestr("xl/worksheets/sheet1.xml", f'<worksheet xmlns="{main}"><sheetData><row>{head}</row><row><c r="A2" t="s"><v>3</v></c><c r="C2" t="inlineStr"><is><t>go</t></is></c></row></sheetData></worksheet>')
    assert [tuple(r) for r in files.test_notes(spark, str(tmp_path / "notes.xlsx"), "name", "point", "steps").collect()] == [("test_a", "", "go")]
    rows_ = spark.range(100).selectExpr("id", "repeat('x', 10) text")
    assert sinks.save_shards(rows_, str(tmp_path / "shards"), "text", "id", 300) == 4
    assert sorted(p.name for p in (tmp_path / "shards").glob("*.parquet")) == [f"train-{i:05d}-of-00004.parquet" for i in range(4)]
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 100

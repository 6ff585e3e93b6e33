"""Line-wise cleaning: repeated neighbours, blank runs, greedy windows."""

from __future__ import annotations

import re

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.session import spread

#: Fixed value: how alike neighbours may be.
ALIKE = 0.7


def neighbour_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alike: float = ALIKE) -> DataFrame:
    """id and text without lines that nearly repeat the worded line before them.

    Lines without words go. A line goes if it shares more than `alike` of both lines'
    distinct words with the worded line before (kept or not), or has more than `alike` of
    its characters equal at equal places; short bracket lines always stay. Each text is
    worked on where it lies, so rows are not shuffled and ids need not be unique; a null
    text is empty.
    """

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: apart_lines(t or "", alike))

    rows = spread(docs.select(id_col, F.col(text_col).alias("_text")))
    return rows.select(id_col, cleaned("_text").alias(text_col))


_GAPS, _HUMP = re.compile(r"[\t \n_]+"), re.compile(r"(?=[A-Z][a-z])")
_BRACKETS, _TELLING = re.compile(r"[{}<>]"), regex.compile(r"[\p{Han}A-Za-z0-9]")


def apart_lines(text: str, alike: float) -> str:
    """The lines of a text that do not nearly repeat the worded line before them."""
    kept, before, known = [], "", set()
    for line in text.split("\n"):
        words = {part for word in _GAPS.split(line) for part in _HUMP.split(word) if part}
        if not words:
            continue
        shared = len(words & known)
        repeats = bool(known) and shared / len(words) > alike and shared / len(known) > alike
        if not repeats:
            repeats = sum(map(str.__eq__, before, line)) / max(len(before), len(line)) > alike
        if not repeats or _BRACKETS.search(line) and len(_TELLING.findall(line)) < 5:
            kept.append(line)
        before, known = line, words
    return "\n".join(kept)


def collapse_repeated_lines(text: Column | str, least: int = 5) -> Column:
    """Runs of equal neighbouring lines of `least` characters or more become one, whatever their case."""
    return F.regexp_replace(T.col(text), rf"(?im)^(.{{{least},}})(?:\n\1$)+", "$1")


def _greedy_windows(text: str, size: int, short: int) -> list[str]:
    out: list[str] = []
    held: list[str] = []
    length = 0
    for line in text.split("\n"):
        if held and length >= size and len(line) >= short:
            out.append("\n".join(held) + "\n")
            held, length = [], 0
        held.append(line)
        length += len(line) + 1
    return [*out, "\n".join(held)] if text else []


def line_windows(text: Column | str, size: int, short: int = 10) -> Column:
    """Consecutive windows of whole lines that join to the text: a window closes once it has
    `size` characters and a line of at least `short` characters follows."""

    @F.pandas_udf("array<string>")
    def split(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else _greedy_windows(t, size, short))

    return split(T.col(text))


#: Wide gaps before a word, after words, closings or colons, and after ends of statements.
_AFTER_WORDS = r"([a-zA-Z\)\:\"]{2,})([\t]{2,}|[ ]{8,})(?=[a-zA-Z]{2,})"
_AFTER_ENDS = r"(\{|\};|\);|;)([\t]{2,}|[ ]{8,})(?=[a-zA-Z]{2,})"


def break_statements(text: Column | str, python: bool = False) -> Column:
    """A line break after the end of a statement (for Python also after words, closings and colons) where a wide gap and a word follow."""
    out = F.regexp_replace(T.col(text), _AFTER_WORDS, "$1\n$2") if python else T.col(text)
    return F.regexp_replace(out, _AFTER_ENDS, "$1\n$2")


#: The cleaning rules in their order, then those of test files, then that of repeated lines.
_ASTERISKS = re.compile(r"[\*]{3,}")
_HYPHENS = re.compile(r"[\-]{3,}")
_BLANK_LINES = re.compile(r"[\n]{3,}")
_HEX = re.compile(r"(?:\b|\t|\n)(0[xX][0-9a-fA-F]+)[U]*(?:L|l|)(?:\b|\t|\n)")
_ONE_CHAR = re.compile(r"((.)\2{5,})")
_TWO_CHARS = re.compile(r"((..)\2{5,})")
_THREE_CHARS = re.compile(r"((...)\2{5,})")
_ESCAPES = re.compile(r"(\\x[0-9A-Fa-f]{2})+")
_ARRAY = re.compile(r"\[(\d+,?\s?)+\]")
_NUMBER = re.compile(r"(?<!HEX-)[0-9]{10,}")
_FLOATS = re.compile(r"(\b\d+\.[0-9]{5,}f\b[\s,]*){2,}")
_FLOAT = re.compile(r"[0-9]+\.[0-9f]{5,}")
_ZEROS = re.compile(r"(([0,\n]{1,3})\2{5,})")
_UPPER = re.compile(r"(\"|')[A-Z ]{20,}(\"|')")
_LOWER = re.compile(r"(\"|')[a-z ]{20,}(\"|')")
_DIGITS = re.compile(r"(\"|')[0-9 ]{10,}(\"|')")
_SAME_LINE = re.compile(r"^(.{5,})(\n\1)+$", re.M | re.I)
TEST_PATH = "test|Test|TEST"


def _run_mark(found: re.Match) -> str:
    """A run of one unit as its count and the unit; runs of blanks stay."""
    run, unit = found.group(1), found.group(2)
    return unit * run.count(unit) if not unit.strip(" \t") else f"<|MULTI-{run.count(unit)}-{unit}|>"


def _length_mark(kind: str):
    return lambda found: f"<|MULTI-{kind}-{len(found.group())}|>"


_RULES = (
    (_ASTERISKS, "*"), (_HYPHENS, "-"), (_BLANK_LINES, "\n"), (_HEX, lambda found: f"<|HEX-{int(found.group(1), 16)}|>"),
    (_ONE_CHAR, _run_mark), (_TWO_CHARS, _run_mark), (_THREE_CHARS, _run_mark), (_ESCAPES, "<|MULTIHEX|>"),
)
_TEST_RULES = (
    (_ARRAY, "<|MULTIARRAY|>"), (_NUMBER, "<|MULTINUM|>"), (_FLOATS, "<|MULTIFLOAT|>"), (_FLOAT, "<|FLOAT|>"), (_ZEROS, "<MULTIZERO>"),
    (_UPPER, _length_mark("upperstring")), (_LOWER, _length_mark("lowerstring")), (_DIGITS, _length_mark("number")),
)


def clean_text(text: str, is_test: bool) -> str:
    """One text through all rules, in order; each works on what the one before left."""
    for pattern, to in (*_RULES, *(_TEST_RULES if is_test else ()), (_SAME_LINE, r"\1")):
        text = pattern.sub(to, text)
    return text


def regex_clean(docs: DataFrame, text_col: str = "text", path_col: str | None = None) -> DataFrame:
    """docs with cleaned texts; files whose path names a test also pass the rules for test data.

    Counts and hexadecimal values in the replacements need callbacks, hence a pandas UDF.
    """

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series, tests: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else clean_text(t, bool(s)) for t, s in zip(texts, tests)], dtype=object)

    docs = spread(docs)
    is_test = F.rlike(F.coalesce(F.col(path_col), F.lit("")), F.lit(TEST_PATH)) if path_col else F.lit(False)
    return docs.withColumn(text_col, cleaned(F.col(text_col), is_test))

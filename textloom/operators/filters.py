"""Row filters on text statistics: each takes documents and keeps rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

#: Bounds of the basic filter, of file size and of comment share; tokens' least characters by language.
MAX_LINE, MEAN_LINE, LEAST_ALNUM = 1000, 100, 0.25
LEAST_SIZE, MOST_SIZE = 100, 5000
LEAST_COMMENT, MOST_COMMENT = 0.01, 0.8
LEAST_STARS = 5
FERTILITY = {"python": 2.5, "java": 2.9, "javascript": 2.6}


def line_stats(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with n_lines, max_line, avg_line, digit_ratio, alnum_fraction and size."""
    return docs.withColumns(
        {
            "n_lines": T.n_lines(text_col),
            "max_line": T.max_line_length(text_col),
            "avg_line": T.avg_line_length(text_col),
            "digit_ratio": T.digit_ratio(text_col),
            "alnum_fraction": T.alnum_fraction(text_col),
            "size": F.length(text_col).cast("long"),
        }
    )


def basic(docs: DataFrame, text_col: str = "text", max_line: int = MAX_LINE, mean_line: int = MEAN_LINE, alnum: float = LEAST_ALNUM) -> DataFrame:
    """Rows whose longest and mean line are within bounds and that hold enough letters and digits."""
    return docs.where((T.max_line_length(text_col) <= max_line) & (T.avg_line_length(text_col) <= mean_line) & (T.alnum_fraction(text_col) >= alnum))


def basic_by_rule(docs: DataFrame, rules: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """Rows that pass the rule of their keys: include = 1 and the bounds that the rule gives.

    rules has the keys, include, line_max, line_mean, alnum and alpha; a null bound does not
    apply; rows without a rule go. rules is one row a key.
    """
    taken, name = {c.lower() for c in docs.columns}, "_rule"
    while name in taken:
        name += "_"
    bounds = rules.select(*keys, F.struct("include", "line_max", "line_mean", "alnum", "alpha").alias(name))
    rule = F.col(name)
    passes = (
        (rule["include"] == 1)
        & _within(T.max_line_length(text_col), rule["line_max"])
        & _within(T.avg_line_length(text_col), rule["line_mean"])
        & (rule["alnum"].isNull() | (T.alnum_fraction(text_col) >= rule["alnum"]))
        & (rule["alpha"].isNull() | (T.alpha_fraction(text_col) >= rule["alpha"]))
    )
    return docs.join(bounds, keys).where(passes).select(*docs.columns)


def _within(value: Column, bound: Column) -> Column:
    return bound.isNull() | (value <= bound)


def by_size(docs: DataFrame, text_col: str = "text", least: int = LEAST_SIZE, most: int = MOST_SIZE) -> DataFrame:
    return docs.where(F.length(text_col).between(least, most))


def by_stars(docs: DataFrame, stars_col: str = "stars", more_than: int = LEAST_STARS) -> DataFrame:
    """Rows with more stars; null counts as none."""
    return docs.where(F.coalesce(stars_col, F.lit(0)) > more_than)


def by_comment_share(docs: DataFrame, share_col: str = "nl_ratio", least: float = LEAST_COMMENT, most: float = MOST_COMMENT) -> DataFrame:
    return docs.where((F.col(share_col) > least) & (F.col(share_col) < most))


def by_fertility(docs: DataFrame, ratio_col: str, lang_col: str = "lang", least: dict[str, float] | None = None) -> DataFrame:
    """Rows with at least their language's characters a token; languages without a bound go."""
    bounds = F.create_map(*(F.lit(x) for pair in (least or FERTILITY).items() for x in pair))
    return docs.where(F.col(ratio_col) >= F.try_element_at(bounds, F.lower(lang_col)))


def repo_rules(docs: DataFrame, text_col: str = "text", max_line: int = 1000, least_mean: int = 5, digits: float = 0.25, most_lines: int = 50_000) -> DataFrame:
    """Files of a repository worth training on, cut after most_lines lines.

    Out go files with a line over max_line, a whole mean line below least_mean, more than
    that share of digits, or nothing but blanks.
    """
    kept = docs.where(
        (T.max_line_length(text_col) <= max_line)
        & (F.floor(T.avg_line_length(text_col)) >= least_mean)
        & (T.digit_ratio(text_col) <= digits)
        & (F.trim(F.regexp_replace(text_col, r"\s+", " ")) != "")
    )
    short = F.array_join(F.slice(T.lines(text_col), 1, most_lines), "\n")
    return kept.withColumn(text_col, F.when(T.n_lines(text_col) > most_lines, short).otherwise(F.col(text_col)))


def not_xml(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows that do not open as XML within their first hundred characters."""
    return docs.where(~F.contains(F.substring(text_col, 1, 100), F.lit("<?xml version=")))


def visible_text(html: Column | str) -> Column:
    """HTML without scripts, styles, comments and tags, blanks joined."""
    bare = F.regexp_replace(T.col(html), r"(?is)<(script|style)\b[^>]*>.*?</(script|style)\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def visible_enough(pages: DataFrame, html_col: str = "html", share: float = 0.2, least: int = 100) -> DataFrame:
    """Pages with more than `least` visible characters and that share of the source."""
    size = F.length(visible_text(html_col))
    return pages.where((size > least) & (size > share * F.length(html_col)))


def test_path(path: Column | str) -> Column:
    """Whether a path is one of tests."""
    return F.contains(F.lower(T.col(path)), F.lit("test"))


#: How names of tests begin and end.
TEST_PREFIX = "^(TestCase_|TESTCASE_|testcase_|test)(_|)"
TEST_SUFFIX = "(_|)[0-9]+$"


def test_function(signature: Column | str) -> Column:
    """Whether a function's signature reads like a test's: its beginning, or a number at its end."""
    s = T.col(signature)
    return F.rlike(s, F.lit(TEST_PREFIX)) | F.rlike(s, F.lit(TEST_SUFFIX))


def asserting(calls: Column | str) -> Column:
    """Whether what a function calls, as text, says assert."""
    return F.contains(F.lower(T.col(calls)), F.lit("assert"))


def tested_name(signature: Column | str) -> Column:
    """The name that a test's signature points at, without a test's beginning and numbered end; null where nothing was taken off."""
    s = T.col(signature)
    bare = F.regexp_replace(F.regexp_replace(s, TEST_SUFFIX, ""), TEST_PREFIX, "")
    return F.when(F.length(bare) < F.length(s), bare)


def bracket_line(line: Column) -> Column:
    """Short lines of brackets, which are never taken as repeats: under five letters, digits or ideographs."""
    return (F.length(F.regexp_replace(line, r"[^\p{IsHan}A-Za-z0-9]", "")) < 5) & F.rlike(line, F.lit(r"[{}<>]"))


def filtered_volume(before: DataFrame, after: DataFrame, text_col: str = "text") -> DataFrame:
    """Rows and characters before and after a filter: step, n_rows, volume."""

    def of(df: DataFrame, step: str) -> DataFrame:
        return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum(F.length(text_col)), F.lit(0)).alias("volume")).select(F.lit(step).alias("step"), "n_rows", "volume")

    return of(before, "before").unionByName(of(after, "after"))

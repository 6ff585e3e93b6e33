"""Token ratios, ordered subsequences and quote-aware line splits."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

def chars_per_token(text: Column | str, pattern: str = r"[A-Za-z0-9_]+|[^A-Za-z0-9_\s]") -> Column:
    """Characters a token ("fertility") under a pattern of tokens; null without tokens."""
    t = T.col(text)
    n = F.regexp_count(t, F.lit(pattern))
    return F.when(n > 0, F.length(t) / n)


def is_subsequence(short: Sequence, long: Sequence) -> bool:
    """Whether the elements of short occur in long in their order."""
    at = 0
    for x in long:
        if at == len(short):
            break
        at += x == short[at]
    return at == len(short)


def _found_in_order(part: str, text: str) -> bool:
    """is_subsequence for texts, from one find to the next."""
    at = 0
    for c in part:
        at = text.find(c, at) + 1
        if not at:
            return False
    return True


def repeated_subsequence(text: str, least: int = 5) -> tuple[str, int] | None:
    """The first part of `least` characters that the rest of the text holds as a subsequence, and how often the part itself occurs.

    A longer part that recurs starts with one of `least` characters that does, so no other
    length need be tried. Texts shorter than twice that have none.
    """
    if len(text) < 2 * least:
        return None
    for i in range(len(text) - least + 1):
        part = text[i : i + least]
        if _found_in_order(part, text[:i] + text[i + least :]):
            return part, text.count(part)
    return None


def repeats(text: Column | str, least: int = 5) -> Column:
    """struct<part, n> of repeated_subsequence; null without one."""

    @F.pandas_udf("struct<part:string,n:long>")
    def found(texts: pd.Series) -> pd.DataFrame:
        each = [repeated_subsequence(t, least) if t else None for t in texts]
        return pd.DataFrame({"part": [e and e[0] for e in each], "n": pd.array([e and e[1] for e in each], "Int64")})

    whole = found(T.col(text))
    return F.when(whole["part"].isNotNull(), whole)


def code_lines(source: str) -> list[str]:
    """Lines of source code, line feeds within quotes (single, double, triple) not counted as ends."""
    out, start, quote, i = [], 0, "", 0
    while i < len(source):
        three = source[i : i + 3]
        if quote:
            if source[i] == "\\":
                i += 1
            elif source.startswith(quote, i):
                i += len(quote) - 1
                quote = ""
            elif source[i] == "\n" and len(quote) == 1:
                quote = ""
                continue
        elif three in ('"""', "'''"):
            quote = three
            i += 2
        elif source[i] in "\"'":
            quote = source[i]
        elif source[i] == "\n":
            out.append(source[start:i])
            start = i + 1
        i += 1
    return [*out, source[start:]]


def split_code(source: Column | str) -> Column:
    @F.pandas_udf("array<string>")
    def split(sources: pd.Series) -> pd.Series:
        return sources.map(lambda s: None if s is None else code_lines(s))

    return split(T.col(source))

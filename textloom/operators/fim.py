"""Fill-in-the-middle samples from lines and from syntax trees."""

from __future__ import annotations

import random

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.parsers import parser_of
from textloom.operators.lines import _greedy_windows

#: The tokens of the sample format, and the marker of completion prompts.
BEGIN, HOLE, END, STOP, FILL = "<｜fim▁begin｜>", "<｜fim▁hole｜>", "<｜fim▁end｜>", "<｜end▁of▁sentence｜>", "<FILL_ME>"
WINDOWS, LEAST_LINES = (2000, 3000, 4000), 15
PRINT_LIKE = ("print", "log", "cout", "write", "say", "echo", "put", "inspect", "console", "output", "cat", "http")
APART = 1000
#: The share of single files and of stacks of files that stay plain.
PLAIN_SHARE, STACK_PLAIN_SHARE = 0.1, 0.5


def fim(prefix: Column, suffix: Column, middle: Column | None = None) -> Column:
    """Prefix, suffix, then middle and stop; a prompt without the middle."""
    head = F.concat(F.lit(BEGIN), prefix, F.lit(HOLE), suffix, F.lit(END))
    return head if middle is None else F.concat(head, middle, F.lit(STOP))


def fill_prompt(prompt: Column | str) -> Column:
    """A prompt with one FILL marker as a sample prompt; without a marker unchanged, with more null."""
    parts = F.split(T.col(prompt), FILL, -1)
    return F.when(F.size(parts) == 1, T.col(prompt)).when(F.size(parts) == 2, fim(parts[0], parts[1]))


#: Comment marks of the languages that prompts name.
COMMENT_MARKS = {"golang": "//", "python": "#", "javascript": "//", "typescript": "//", "java": "//", "c": "//", "cpp": "//", "c++": "//", "cc": "//", "cxx": "//", "hpp": "//", "cppm": "//"}


def completion_prompt(prefix: Column | str, suffix: Column | str, lang: Column | str, most_prefix: int = 3500, most_suffix: int = 1000) -> Column:
    """A comment line that names a known language, the prefix, then the marker and the suffix if there is one.

    Only without a suffix the prompt is cut to its last most_prefix characters.
    """
    name, s = T.col(lang), F.coalesce(T.col(suffix), F.lit(""))
    marks = F.create_map(*(F.lit(x) for pair in COMMENT_MARKS.items() for x in pair))
    line = F.coalesce(F.concat(F.try_element_at(marks, name), F.lit(" this is "), name, F.lit(" code\n\n")), F.lit(""))
    prompt = F.concat(line, F.coalesce(T.col(prefix), F.lit("")))
    return F.when(s == "", F.right(prompt, F.lit(most_prefix))).otherwise(F.concat(prompt, F.lit(FILL), F.left(s, F.lit(most_suffix))))


def middle_line(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, prefix, middle, suffix about the middle line of each text with more than LEAST_LINES lines; they join to the text."""
    rows = docs.where(T.n_lines(text_col) > LEAST_LINES).withColumn("_l", T.lines(text_col)).withColumn("_k", F.floor(F.size("_l") / 2).cast("int"))
    before = F.concat(F.array_join(F.slice("_l", F.lit(1), F.col("_k")), "\n"), F.lit("\n"))
    after = F.array_join(F.slice("_l", F.col("_k") + 2, F.greatest(F.size("_l") - F.col("_k") - 1, F.lit(0))), "\n")
    suffix = F.when(F.col("_k") + 1 < F.size("_l"), F.concat(F.lit("\n"), after)).otherwise(F.lit(""))
    return rows.select(id_col, before.alias("prefix"), F.element_at("_l", F.col("_k") + 1).alias("middle"), suffix.alias("suffix"))


def _window_sample(window: str, pick: random.Random) -> tuple[str, str, str] | None:
    """Prefix, middle and suffix about one line of a window; None for at most LEAST_LINES lines."""
    end = "\n" if window.endswith("\n") else ""
    lines = window.removesuffix("\n").split("\n")
    n = len(lines)
    if n <= LEAST_LINES:
        return None
    longest = max(len(x.strip()) for x in lines)
    skip, least = pick.choice((n // 5, n // 2)), min(30, longest // 2)
    good = (i for i in range(skip, n) if len(lines[i].strip()) >= least and not any(p in lines[i] for p in PRINT_LIKE))
    at = next(good, n)
    if at >= n - 5:
        at = max(range(5, n - 1), key=lambda i: (len(lines[i]) if not lines[i].startswith("<|PathStart|>") else -1, -i))
    head, tail = "".join(x + "\n" for x in lines[:at]), "".join("\n" + x for x in lines[at + 1 :])
    return head, lines[at], tail + end


def line_parts(text: str, key: str) -> list[str | tuple[str, str, str]]:
    """The whole text in windows of whole lines, each as prefix, middle and suffix, or plain if it has few lines.

    The key chooses the windows' size and the lines. The parts join to the text.
    """
    pick = random.Random(key)
    return [_window_sample(w, pick) or w for w in _greedy_windows(text, pick.choice(WINDOWS), 10)]


def line_sample(text: str, key: str) -> tuple[str, str, str] | None:
    """The sample of the first window; None if that is plain."""
    first = next(iter(line_parts(text, key)), None)
    return first if isinstance(first, tuple) else None


def tree_samples(source: str, key: str, least: int = 5, most: int = 1000, lang: str = "python") -> list[tuple[str, str, str]]:
    """Samples about syntax nodes of a file, far apart from each other, in source order; none without a parser or tree.

    Statement nodes are tried first (window 2000 bytes before, 400 after), then inline ones
    (1000, 200), in a random order that the key fixes. A prefix begins no earlier than the
    sample before it ended. All places and bounds are in bytes; a window's outer ends give way
    to whole characters.
    """
    parser = parser_of(lang)
    nodes = parser(source) if parser else None
    if not nodes:
        return []
    data, pick, kept = source.encode(), random.Random(key), []
    for kind, before, after in (("block", 2000, 400), ("inline", 1000, 200)):
        spans = sorted({(n.start, n.end) for n in nodes if n.kind == kind})
        pick.shuffle(spans)
        for a, b in spans:
            if least <= b - a <= most and all(a - kb >= APART or ka - b >= APART for ka, kb, *_ in kept):
                kept.append((a, b, before, after))
    out, free = [], 0
    for a, b, before, after in sorted(kept):
        end = min(len(data), b + after)
        line = data.find(b"\n", end, end + 100)
        end = line if line >= 0 else end
        out.append(tuple(x.decode(errors="ignore") for x in (data[max(free, a - before) : a], data[a:b], data[b:end])))
        free = max(free, min(end + 1, len(data)))
    return out


def samples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", plain_share: float = PLAIN_SHARE, seed: int = 0) -> DataFrame:
    """id, part, kind (fim or plain) and sample of each part of each text.

    A share of the texts, by a hash of the id, stays plain (0.1 for single files, 0.5 for
    stacks of files); files of a language with a parser give their syntax samples as one
    part, others a part for each window of lines, plain if it has few; what gives none stays
    plain.
    """

    @F.pandas_udf("array<struct<kind:string,sample:string>>")
    def made(ids: pd.Series, texts: pd.Series, langs: pd.Series) -> pd.Series:
        out = []
        for key, text, lang in zip(ids.astype(str), texts, langs):
            text = text or ""
            found = tree_samples(text, f"{seed}-{key}", lang=lang)
            if found:
                out.append([("fim", "".join(map(_written, found)))])
            else:
                out.append([("fim", _written(x)) if isinstance(x, tuple) else ("plain", x) for x in line_parts(text, f"{seed}-{key}")] or [("plain", text)])
        return pd.Series([[{"kind": k, "sample": s} for k, s in parts] for parts in out])

    plain = F.array(F.struct(F.lit("plain").alias("kind"), F.col(text_col).alias("sample")))
    chosen = F.when(T.uniform(id_col, str(seed)) < plain_share, plain).otherwise(made(F.col(id_col), F.col(text_col), F.col(lang_col)))
    return docs.select(id_col, F.posexplode(chosen).alias("part", "_s")).select(id_col, "part", "_s.kind", "_s.sample")


def _written(sample: tuple[str, str, str]) -> str:
    prefix, middle, suffix = sample
    return f"{BEGIN}{prefix}{HOLE}{suffix}{END}{middle}{STOP}"

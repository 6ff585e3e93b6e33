"""Completion logs to training rows: prompts, answers, filters, sampling, calibration."""

from __future__ import annotations

import difflib
import math
import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

MOST_CHARS, LEAST_CHARS = 500, 4


def department(l1: Column, l2: Column, default: str = "unknown") -> Column:
    return F.when(l1.isNull() | l2.isNull() | (l1 == "") | (l2 == ""), F.lit(default)).otherwise(F.concat_ws("_", l1, l2))


def chat_turns(turns: DataFrame, id_col: str = "conv_id", order_col: str = "turn") -> DataFrame:
    """id and its messages (array<struct<role, content>>) in order."""
    by = turns.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(order_col, F.col("role").alias("role"), F.col("text").alias("content")))).alias("_m"))
    return by.select(id_col, F.transform("_m", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content"))).alias("messages"))


def preference_rows(rows: DataFrame, id_col: str) -> DataFrame:
    """prompt, prompt_id, chosen and rejected as two-message conversations; rows whose answers agree or are missing go."""
    def talk(answer: str) -> Column:
        return F.array(F.struct(F.col("prompt").alias("content"), F.lit("user").alias("role")), F.struct(F.col(answer).alias("content"), F.lit("assistant").alias("role")))

    good = rows.where((F.col("answer") != F.col("wrong_answer")) & (F.col("answer") != "") & (F.col("wrong_answer") != ""))
    return good.select("prompt", F.col(id_col).alias("prompt_id"), talk("answer").alias("chosen"), talk("wrong_answer").alias("rejected"))


def useful_size(text: Column | str) -> Column:
    """Letters, digits and ideographs."""
    return F.length(F.regexp_replace(T.col(text), r"[^\p{IsHan}A-Za-z0-9]", ""))


def rejection(answer: Column | str) -> Column:
    """The first rule an answer fails, null if none: empty, blank, short, long, useless, print."""
    a = T.col(answer)
    return (
        F.when(a.isNull() | (a == ""), "empty")
        .when(F.rlike(a, F.lit(r"^\s+$")), "blank")
        .when(F.length(a) < LEAST_CHARS, "short")
        .when(F.length(a) > MOST_CHARS, "long")
        .when(useful_size(a) < LEAST_CHARS, "useless")
        .when((F.length(a) < 30) & F.rlike(a, F.lit(r"^\s*(print|console\.log|echo|log)\b")), "print")
    )


def funnel(rows: DataFrame, answer: str = "answer") -> DataFrame:
    """rule, n: how many rows each rule turned away, and how many passed."""
    return rows.groupBy(F.coalesce(rejection(answer), F.lit("passed")).alias("rule")).agg(F.count("*").alias("n"))


def repeats_context(answer: Column, prefix: Column, suffix: Column, most: int = 5) -> Column:
    """Whether a short answer repeats the line next to it."""
    def useful(t: Column) -> Column:
        return F.filter(F.transform(T.lines(t), F.trim), lambda x: x != "")

    a = useful(answer)
    near = F.concat(F.slice(useful(prefix), -1, 1), F.slice(useful(suffix), 1, 1))
    return (F.size(a) < most) & F.arrays_overlap(a, near)


def downsample(rows: DataFrame, by: str, most: int, key: str) -> DataFrame:
    """Values that occur c > most times keep each row with chance most / c, by a hash of the key.

    Counts join back by value, so a value of a third of all rows is not one task's.
    """
    counts = rows.groupBy(by).agg(F.count("*").alias("_c"))
    joined = rows.join(counts, rows[by].eqNullSafe(counts[by])).drop(counts[by])
    return joined.where(T.uniform(key, by) < F.least(F.lit(1.0), F.lit(float(most)) / F.col("_c"))).drop("_c")


def weighted_sample(rows: DataFrame, k: int, weight: Column, key: str) -> DataFrame:
    """k rows without replacement, with chances by weight: the largest ln(u) / w, u from a hash of the key."""
    u = F.greatest(T.uniform(key, "sample"), F.lit(1e-12))
    return rows.withColumn("_o", F.log(u) / weight).orderBy(F.col("_o").desc(), key).limit(k).drop("_o")


def sft_rows(rows: DataFrame) -> DataFrame:
    """prompt and answer as a conversation row with its category and metadata."""
    talk = F.array(F.struct(F.col("prompt").alias("human"), F.col("answer").alias("assistant")))
    return rows.select(F.col("id").alias("conversation_id"), F.lit("completion").alias("category"), talk.alias("conversation"), F.length("answer").alias("groundtruth_length"))


def extract_answer(prefix: str, suffix: str, later: str, least: int = 20) -> tuple[str | None, str]:
    """What a later version of a file holds between the context lines, and how it was found.

    The last prefix lines that hold `least` useful characters and the first suffix line
    frame the answer; after the first find, the search starts again five characters on, up
    to three times, and the last find counts.
    """
    def size(text: str) -> int:
        return len(re.sub(r"[^0-9A-Za-z一-鿿]", "", text))

    lines = prefix.split("\n")
    head: list[str] = []
    while lines and size("\n".join(head)) < least:
        head.insert(0, lines.pop())
    tail = next((x for x in suffix.split("\n") if x.strip()), "")
    if size("\n".join(head)) < least:
        return None, "short_context"
    pattern = re.compile(re.escape("\n".join(head)) + r"(.*?)" + (re.escape(tail) if tail else r"\Z"), re.S)
    found, how, at = None, "none", 0
    for name in ("search", "2nd_search", "3rd_search"):
        m = pattern.search(later, at)
        if not m:
            break
        found, how, at = m.group(1), name, m.start() + 5
    return found, how


def answers(rows: DataFrame) -> DataFrame:
    """rows (prefix, suffix, later) with answer and deal_method; the pattern differs by row, hence a pandas UDF."""

    @F.pandas_udf("struct<answer:string,deal_method:string>")
    def found(prefixes: pd.Series, suffixes: pd.Series, laters: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract_answer(p or "", s or "", x or "") for p, s, x in zip(prefixes, suffixes, laters)], columns=["answer", "deal_method"])

    return rows.withColumn("_a", found("prefix", "suffix", "later")).select(*rows.columns, "_a.answer", "_a.deal_method")


def threshold_sweep(scored: DataFrame, thresholds: list[float], score: str = "score", truth: str = "truth") -> DataFrame:
    """For each threshold the confusion counts of score > t, and the shares that follow; guarded denominators give 0.

    One pass: scores fall between thresholds, and counts add up from above.
    """
    cells = []
    for t in thresholds:
        over, good = F.col(score) > t, F.col(truth) == 1
        counts = {"tp": over & good, "fp": over & ~good, "fn": ~over & good, "tn": ~over & ~good}
        cells.append(F.struct(F.lit(t).alias("threshold"), *(F.count_if(c).alias(n) for n, c in counts.items())))
    swept = scored.agg(F.array(*cells).alias("_s")).select(F.explode("_s").alias("s")).select("s.*")

    def share(a: Column, b: Column) -> Column:
        return F.when(b == 0, F.lit(0.0)).otherwise(F.round(a / F.greatest(b, F.lit(1)), 6))

    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return swept.withColumns({"new_accept": share(tp, tp + fp), "kept_pos": share(tp, fn + tp), "del_pos": share(fn, fn + tp), "del_neg": share(tn, tn + fp)})


def prefix_means(logps: Column, most: int = 9) -> Column:
    """Mean probability of the first k tokens, for k = 1..most."""
    p = F.transform(logps, F.exp)
    return F.transform(F.sequence(F.lit(1), F.lit(most)), lambda k: F.aggregate(F.slice(p, F.lit(1), k), F.lit(0.0), lambda a, x: a + x) / F.greatest(F.lit(1), F.least(k, F.size(p))))


def edit_similarity(a: Column | str, b: Column | str) -> Column:
    """Matching-blocks ratio, 0 to 100."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else 100 * difflib.SequenceMatcher(None, p, q, autojunk=False).ratio() for p, q in zip(x, y)], dtype="float64")

    return ratio(T.col(a), T.col(b))


def softmax(values: list[float]) -> list[float]:
    top = max(values, default=0.0)
    made = [math.exp(v - top) for v in values]
    return [m / sum(made) for m in made]

"""Completion logs to training rows: extract answers, filter, down-sample."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import fim, interactions, vocabulary


def training_rows(log: DataFrame, excluded: DataFrame | None = None, most_answers: int = 3, most_files: int = 5) -> DataFrame:
    """Rows of the log (id, language, filename, created_at, prefix, suffix, later) with prompt and answer.

    The first row of an id counts; rows of excluded ids go (excluded: id); answers must
    pass every rule and not repeat their context; frequent answers and files are thinned.
    """
    first = vocabulary.keep_first(log, ["id"], ["created_at", "filename"])
    known = first if excluded is None else first.join(excluded.select("id"), "id", "left_anti")
    found = interactions.answers(known)
    good = found.where(interactions.rejection("answer").isNull() & ~interactions.repeats_context(F.col("answer"), F.col("prefix"), F.col("suffix")))
    thin = interactions.downsample(interactions.downsample(good, "answer", most_answers, "id"), "filename", most_files, "id")
    return thin.withColumn("prompt", fim.completion_prompt("prefix", "suffix", "language"))

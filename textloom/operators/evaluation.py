"""Evaluation sets and reports over repositories and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators import interactions, vocabulary


def evaluation_set(rows: DataFrame, files: int = 200, rows_most: int = 1500, keep: int = 1000) -> DataFrame:
    """Rows (id, filename, prompt, answer) of a weighted sample of files, thinned and without repeats.

    Files weigh their number of rows, 20 at least; of their rows, rows_most are drawn; equal
    prompts with equal answers count once; the first `keep` by id stay.
    """
    by = rows.groupBy("filename").agg(F.count("*").alias("n"))
    chosen = interactions.weighted_sample(by, files, F.greatest("n", F.lit(20)), "filename")
    drawn = interactions.weighted_sample(rows.join(F.broadcast(chosen.select("filename")), "filename", "left_semi"), rows_most, F.lit(1.0), "id")
    return vocabulary.keep_first(drawn, ["prompt", "answer"], ["id"]).orderBy("id").limit(keep)


def function_files(functions: DataFrame) -> DataFrame:
    """repo, lang, name, path and n_files: every file that defines a function, one row each, with their number.

    One row a file, not one list a function, since a common name may be in any number of files.
    """
    each = functions.select("repo", "lang", "name", "path").distinct()
    return each.join(each.groupBy("repo", "lang", "name").agg(F.count("*").alias("n_files")), ["repo", "lang", "name"])


def import_counts(imports: DataFrame) -> DataFrame:
    """n_imports, n_files: how many files import how many names."""
    by = imports.groupBy("repo", "path").agg(F.countDistinct("name").alias("n_imports"))
    return by.groupBy("n_imports").agg(F.count("*").alias("n_files"))


def in_repository(rows: DataFrame, repos: DataFrame) -> DataFrame:
    """department, user, n_in, n_out: rows whose file path holds the name of a known repository, and the others."""
    parts = rows.select("id", "department", "user", F.explode(F.split(F.lower("filename"), r"[/\\]", -1)).alias("name"))
    known = parts.join(repos.select("name").distinct(), "name", "left_semi").select("id").distinct().withColumn("_in", F.lit(1))
    marked = rows.select("id", "department", "user").join(known, "id", "left")
    return marked.groupBy("department", "user").agg(F.count("_in").alias("n_in"), (F.count("*") - F.count("_in")).alias("n_out"))


def prompt_scores(rows: DataFrame, truth: str, variants: list[str]) -> DataFrame:
    """variant, mean: the mean edit similarity of each variant's output to the truth."""
    means = rows.agg(*(F.round(F.avg(interactions.edit_similarity(truth, v)), 4).alias(v) for v in variants))
    return means.select(F.explode(F.array(*(F.struct(F.lit(v).alias("variant"), F.col(v).alias("mean")) for v in variants))).alias("r")).select("r.*")

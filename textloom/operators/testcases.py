"""Test-case training data: tests, what they test, and what that depends on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import code
from textloom.operators.filters import test_path


def functions_of(files: DataFrame) -> DataFrame:
    """repo, lang, path, name, signature, body, calls of the functions of files (repo, lang, path, content)."""
    return files.select("repo", "lang", "path", F.explode(code.functions("content")).alias("f")).select("repo", "lang", "path", "f.*")


def testcases(functions: DataFrame) -> DataFrame:
    """One row a test: repo, test_path, test_name, test_body, tested_path, tested_name, tested_body, depends.

    A test lies on a test path and calls something that asserts. The first of its callees
    that is defined in its repository outside tests is the tested function; depends holds
    that function's own callees defined there. Of several definitions the smallest path counts.
    """
    defined = functions.where(~test_path("path")).groupBy("repo", "lang", "name").agg(F.min_by(F.struct("path", "body", "calls"), "path").alias("d"))
    is_test = test_path("path") & F.exists("calls", lambda c: F.contains(F.lower(c), F.lit("assert")))
    tests = functions.where(is_test).select("repo", "lang", F.col("path").alias("test_path"), F.col("name").alias("test_name"), F.col("body").alias("test_body"), F.posexplode("calls").alias("pos", "callee"))
    met = tests.join(defined.withColumnRenamed("name", "callee"), ["repo", "lang", "callee"])
    keys = ["repo", "lang", "test_path", "test_name", "test_body"]
    tested = met.groupBy(*keys).agg(F.min_by(F.struct(F.col("callee").alias("name"), "d"), "pos").alias("t"))
    tested = tested.select(*keys, F.col("t.d.path").alias("tested_path"), F.col("t.name").alias("tested_name"), F.col("t.d.body").alias("tested_body"), F.col("t.d.calls").alias("_calls"))
    second = tested.select(*keys, F.posexplode("_calls").alias("pos", "callee")).join(defined.withColumnRenamed("name", "callee"), ["repo", "lang", "callee"])
    depends = second.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("pos", F.col("callee").alias("name"), F.col("d.path").alias("path"), F.col("d.body").alias("body")))).alias("depends"))
    return tested.drop("_calls").join(depends, keys, "left")


def prompts(cases: DataFrame, notes: DataFrame | None = None) -> DataFrame:
    """cases with three prompts: the function alone, with its context, with context and note (each falling back to the one before)."""
    alone = F.concat(F.lit("Write a test for this function:\n"), F.col("tested_body"))
    context = F.concat(alone, F.lit("\nIt depends on:\n"), F.array_join(F.transform("depends", lambda d: d["body"]), "\n"))
    made = cases.withColumn("prompt", alone).withColumn("prompt_context", F.coalesce(context, F.col("prompt")))
    if notes is None:
        return made.withColumn("prompt_note", F.col("prompt_context"))
    joined = made.join(notes.select(F.col("name").alias("test_name"), "point", "steps"), "test_name", "left")
    note = F.concat(F.col("prompt_context"), F.lit("\nTest point: "), F.col("point"), F.lit("\nSteps: "), F.col("steps"))
    return joined.withColumn("prompt_note", F.coalesce(note, F.col("prompt_context"))).drop("point", "steps")

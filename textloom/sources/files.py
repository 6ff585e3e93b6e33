"""Sources: repositories and files, tables, rule files, logs."""

from __future__ import annotations

import io
import tarfile
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from textloom.functions import text as T

#: Columns of the table that holds one row a repository file.
REPO_FILES = (
    "language string, project_path string, path string, imported_files string, src_encoding string, repo_name string, github_id string, content string, "
    "bool_testcase boolean, parent_2_function_definition_dict string, parent_2_sub_include_func_text_dict string"
)


def hidden(path: Column | str) -> Column:
    """Whether a path has a part that begins with a dot or underscore."""
    return F.exists(T.path_parts(path), lambda p: F.rlike(p, F.lit(r"^[._]")))


def text_files(spark: SparkSession, root: str) -> DataFrame:
    """path (below root), content, size, extension and n_lines of every decodable text file under root.

    Hidden files and folders, files with null bytes and files that are not UTF-8 are left
    out. Contents are read by the executors.
    """
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    base = root.rstrip("/").removeprefix("file:").lstrip("/")
    below = F.regexp_replace("path", r"^[a-z]+:/*" + "".join(c if c.isalnum() or c in "/_-" else "\\" + c for c in base) + "/+", "")
    good = raw.withColumn("path", below).where(~hidden("path") & F.is_valid_utf8(F.col("content").cast("string")) & ~F.contains(F.col("content"), F.lit(b"\0")))
    read = good.select("path", F.col("content").cast("string").alias("content"), F.col("length").alias("size"))
    return read.withColumns({"extension": extension("path"), "n_lines": T.n_lines("content")})


def extension(path: Column | str) -> Column:
    """What follows the last dot of the file name; empty without one."""
    name = F.element_at(T.path_parts(path), -1)
    return F.when(F.contains(name, F.lit(".")), F.element_at(F.split(name, r"\.", -1), -1)).otherwise(F.lit(""))


def repositories(files: DataFrame) -> DataFrame:
    """files with department and repo: the first two parts of their paths."""
    parts = T.path_parts("path")
    return files.withColumns({"department": F.try_element_at(parts, F.lit(1)), "repo": F.try_element_at(parts, F.lit(2))}).where(F.size(parts) > 2)


def projects(files: DataFrame, root: str) -> DataFrame:
    """files (path below root) with project, their folder right below root, and department, the second to last part of root."""
    parts = root.rstrip("/").split("/")
    placed = files.where(F.size(T.path_parts("path")) > 1)
    return placed.withColumns({"project": F.element_at(T.path_parts("path"), 1), "department": F.lit(parts[-2] if len(parts) > 1 else None).cast("string")})


def origin_of(config: Column | str) -> Column:
    """Where a repository comes from, by its .git/config: the first url, without user and password; empty without one."""
    url = F.trim(F.regexp_extract(T.col(config), r"(?m)^\s*url[^=\n]*=([^=\n]*)", 1))
    return F.regexp_replace(url, r"^(\w+://)[^/@]*@", "$1")


def branch_of(head: Column | str) -> Column:
    """The branch that .git/HEAD names; empty if it names a revision."""
    return F.regexp_extract(T.col(head), r"(?m)^ref[^/\n]*/[^/\n]*/([^/\s]+)", 1)


def revision_of(ref: Column | str) -> Column:
    """The first seven characters of a branch's revision."""
    return F.substring(F.trim(T.col(ref)), 1, 7)


def archive_files(spark: SparkSession, path: str) -> DataFrame:
    """archive, path, content of the regular files in tar archives (plain, gzip, bzip2, xz), read by the executors."""

    def unpacked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for archive, data in zip(frame.path, frame.content):
                with tarfile.open(fileobj=io.BytesIO(data)) as tar:
                    for member in tar:
                        if member.isfile():
                            yield pd.DataFrame({"archive": [archive], "path": [member.name], "content": [tar.extractfile(member).read()]})

    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")
    return raw.mapInPandas(unpacked, "archive string, path string, content binary")


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(path: str, sheet: int = 1) -> list[dict[str, str]]:
    """The rows of one sheet of an Excel workbook under the names of its first row; empty cells are empty strings."""
    with zipfile.ZipFile(path) as book:
        shared = []
        if "xl/sharedStrings.xml" in book.namelist():
            shared = ["".join(t.text or "" for t in item.iter(f"{_SHEET}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]
        rows = []
        for row in ElementTree.fromstring(book.read(f"xl/worksheets/sheet{sheet}.xml")).iter(f"{_SHEET}row"):
            cells = {}
            for cell in row:
                column = cell.get("r", "").rstrip("0123456789")
                text = "".join(t.text or "" for t in cell.iter() if t.tag in (f"{_SHEET}v", f"{_SHEET}t"))
                cells[column] = shared[int(text)] if cell.get("t") == "s" else text
            rows.append(cells)
    head = rows[0] if rows else {}
    return [{name: cells.get(column, "") for column, name in head.items()} for cells in rows[1:]]


def test_notes(spark: SparkSession, path: str, name: str, point: str, steps: str) -> DataFrame:
    """name, test_point, test_steps of a workbook of notes on tests, which is read once by the driver; the last note of a name counts."""
    notes = {r[name]: (r[name], r[point], r[steps]) for r in sheet_rows(path)}
    return spark.createDataFrame(list(notes.values()), "name string, test_point string, test_steps string")


def with_language(files: DataFrame, languages: DataFrame, other: str = "other") -> DataFrame:
    """files with lang by extension, case as written; languages: lang, extension (one row an extension)."""
    return files.join(languages.select("extension", "lang"), "extension", "left").withColumn("lang", F.coalesce("lang", F.lit(other)))


def language_table(spark: SparkSession, path: str) -> DataFrame:
    """lang, extension from a JSON object of arrays with leading dots; the entry `Text` is left out."""
    whole = spark.read.text(path, wholetext=True).select(F.from_json("value", "map<string,array<string>>").alias("m"))
    rows = whole.select(F.explode("m").alias("lang", "all")).where("lang <> 'Text'")
    return rows.select("lang", F.regexp_replace(F.explode("all"), r"^\.", "").alias("extension"))


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None, kind: str = "parquet") -> DataFrame:
    """Parquet, JSON lines, ORC or CSV under an explicit schema where one is given."""
    reader = spark.read.schema(schema) if schema else spark.read
    return (reader.option("header", "true") if kind == "csv" else reader).format(kind).load(path)


def read_jdbc(spark: SparkSession, url: str, query: str, column: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 1, **options: str) -> DataFrame:
    """Rows of a database query, read in parallel by ranges of a numeric column where one is given."""
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if column is None:
        return reader.option("query", query).load()
    ranged = reader.option("dbtable", f"({query}) q").option("partitionColumn", column)
    return ranged.option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1])).option("numPartitions", str(parts)).load()


def rule_table(spark: SparkSession, path: str) -> DataFrame:
    """lang, extension and bounds of a CSV of filter rules; what is no number does not apply.

    line_mean is 100 where line_max is set.
    """
    raw = spark.read.option("header", "true").csv(path)

    return raw.select(
        T.language_name("language").alias("lang"),
        F.col("extension"),
        F.coalesce(F.expr("try_cast(Include as int)"), F.lit(0)).alias("include"),
        F.expr("try_cast(Long_line_threshold as double)").alias("line_max"),
        F.when(F.expr("try_cast(Long_line_threshold as double)").isNotNull(), F.lit(100.0)).alias("line_mean"),
        F.expr("try_cast(Alphanum_threshold as double)").alias("alnum"),
        F.expr("try_cast(`Alpha filter` as double)").alias("alpha"),
    )


def repo_names(spark: SparkSession, path: str) -> DataFrame:
    """Distinct names of a list, without .git, underscores and hyphens, in lower case."""
    name = F.lower(F.regexp_replace(F.trim("value"), r"(\.git$|[_-])", ""))
    return spark.read.text(path).select(name.alias("name")).where("name <> ''").distinct()


def compiled_dependencies(spark: SparkSession, path: str, skipped: str = "/opt") -> DataFrame:
    """file, dependency of compiler output: the distinct paths that its line marks name, in order of appearance."""
    lines = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.regexp_extract_all("value", F.lit(r'(?m)^#(?:line)?\s*\d+\s+"([^"]*)"'), F.lit(1)).alias("all"))
    clean = F.transform("all", lambda p: F.regexp_replace(p, r"^(\.\./)+", ""))
    kept = lines.select("file", F.posexplode(F.array_distinct(F.filter(clean, lambda p: ~F.startswith(p, F.lit(skipped))))).alias("place", "dependency"))
    return kept.select("file", "place", "dependency")


def log_statistics(spark: SparkSession, path: str) -> DataFrame:
    """filter, before, after of log lines `<filter>: <n> -> <n>`."""
    line = r"^\s*(?:.*?\s)?(\w+): (\d+) -> (\d+)\s*$"
    rows = spark.read.text(path).where(F.rlike("value", F.lit(line)))
    return rows.select(F.regexp_extract("value", line, 1).alias("filter"), F.regexp_extract("value", line, 2).cast("long").alias("before"), F.regexp_extract("value", line, 3).cast("long").alias("after"))


#: Rows of benchmark sets that count, and the trivial solutions that do not.
MBPP_IDS = (11, 510)
TRIVIAL_CHARS = 20


def benchmark_strings(tasks: DataFrame) -> DataFrame:
    """benchmark, item_id, text of a table of tasks (benchmark, task_id, prompt, solution): doc strings and solutions.

    item_id is a hash of benchmark, task and part, the same in every reading. The mbpp set counts for its test ids alone; solutions under TRIVIAL_CHARS characters do not count.
    """
    kept = tasks.where((F.col("benchmark") != "mbpp") | F.col("task_id").between(*MBPP_IDS))
    doc = F.trim(F.coalesce(F.try_element_at(F.split("prompt", '"""', -1), F.lit(2)), F.col("prompt")))
    both = kept.select("benchmark", "task_id", F.posexplode(F.array(doc, F.trim("solution"))).alias("part", "text")).where(F.length("text") >= TRIVIAL_CHARS)
    return both.select("benchmark", F.xxhash64("benchmark", "task_id", "part").alias("item_id"), "text")

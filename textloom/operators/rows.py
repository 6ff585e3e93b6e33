"""Row-level steps of curation jobs: named filters, indices, checks, refreshes, counts of runs and labels."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from fnmatch import fnmatchcase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.ranking import buckets_for, ranked
from textloom.session import Workspace

#: Characters that say something, tokens, and bounds of completion contexts by the file's suffix.
USEFUL = r"[^\p{IsHan}a-zA-Z0-9_;,\[\]\(\)\{\}]"
TOKEN = r"[\p{IsHan}a-zA-Z0-9]+"
WEB = ("vue", "ts", "tsx", "js", "html")
LEAST_USEFUL, LEAST_TOKENS, WEB_USEFUL, WEB_TOKENS = 20, 3, 100, 10


def chosen(filters: dict[str, Callable[[DataFrame], DataFrame]], patterns: str | Iterable[str]) -> list[str]:
    """Names of filters that match one of some glob patterns (or a comma-separated list of them), in the filters' order.

    A pattern that matches nothing is an error, since a filter left out by a slip goes unseen.
    """
    wanted = [p.strip() for p in (patterns.split(",") if isinstance(patterns, str) else patterns)]
    lost = [p for p in wanted if not any(fnmatchcase(name, p) for name in filters)]
    if lost:
        raise ValueError(f"no filter is named {', '.join(lost)}")
    return [name for name in filters if any(fnmatchcase(name, p) for p in wanted)]


def run_chosen(docs: DataFrame, filters: dict[str, Callable[[DataFrame], DataFrame]], patterns: str | Iterable[str]) -> DataFrame:
    for name in chosen(filters, patterns):
        docs = filters[name](docs)
    return docs


def with_index(rows: DataFrame, key: str, out: str = "index") -> DataFrame:
    """rows with a gapless number from 0, in the order of the key's hash; equal keys in any order.

    The numbers follow from the keys alone and no task sorts all rows. rows is read twice.
    """
    n = buckets_for(rows.count())
    spread = rows.withColumn("_all", F.lit(0)).withColumn("_bucket", F.pmod(F.xxhash64(key), F.lit(n)).cast("int"))
    return ranked(spread, ["_all"], "_bucket", [key], out).drop("_all", "_bucket")


def shuffled(rows: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """rows in a random order that the key and seed fix; sorted by ranges of the random number, never in one task."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key)


def changed_sample(rows: DataFrame, n: int, key: str, changed: str = "modified", seed: int = 0) -> DataFrame:
    """n random rows of those changed, by a hash of the key: the bounded report of a redaction run."""
    return shuffled(rows.where(F.col(changed)), key, seed).limit(n)


def only_languages(files: DataFrame, allowed: DataFrame) -> DataFrame:
    """Files whose repository allows their language (allowed: repo, lang)."""
    return files.join(allowed.select("repo", "lang").distinct(), ["repo", "lang"], "left_semi")


def training_record(rows: DataFrame, stacked: list[str], content: str = "stack_content") -> DataFrame:
    """rows whose named texts follow each other, one a line, as one column; the others stay."""
    rest = [c for c in rows.columns if c not in stacked]
    return rows.select(*rest, F.concat_ws("\n", *(F.col(c) for c in stacked)).alias(content))


def rich_context(prefix: Column | str, suffix: Column | str, file_suffix: Column | str) -> Column:
    """Whether both sides of a completion say enough: useful characters and tokens, more of both for web files.

    An empty or null side never does.
    """
    web = F.lower(T.col(file_suffix)).isin(*WEB)
    useful, tokens = F.when(web, WEB_USEFUL).otherwise(LEAST_USEFUL), F.when(web, WEB_TOKENS).otherwise(LEAST_TOKENS)

    def enough(side: Column) -> Column:
        return (F.length(F.regexp_replace(side, USEFUL, "")) >= useful) & (F.regexp_count(side, F.lit(TOKEN)) >= tokens)

    return F.coalesce(enough(T.col(prefix)) & enough(T.col(suffix)), F.lit(False))


def refreshed(rows: DataFrame, updates: DataFrame, key: str, column: str) -> DataFrame:
    """rows with a column's newer values where updates (key, column) has one; an update per key at most."""
    new = updates.select(F.col(key).alias("_key"), F.col(column).alias("_new"))
    joined = rows.join(new, rows[key] == F.col("_key"), "left")
    return joined.withColumn(column, F.coalesce("_new", column)).select(*rows.columns)


def shared_ids(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """n_left, n_right, n_both: distinct ids of either side and of both."""
    sides = left.select(F.col(left_key).alias("id"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(right.select(F.col(right_key).alias("id"), F.lit(0).alias("l"), F.lit(1).alias("r")))
    by = sides.where("id is not null").groupBy("id").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return by.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("l", "n_left"), ("r", "n_right"))), F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_both"))


def folder_imports(imports: DataFrame, files: DataFrame) -> DataFrame:
    """repo, lang, src, dst: every file of the folder that an import names (imports: repo, lang, path, name)."""
    folder = F.element_at(T.path_parts(F.regexp_replace("path", r"[/\\][^/\\]*$", "")), -1)
    held = files.where(F.size(T.path_parts("path")) > 1).select("repo", "lang", F.col("path").alias("dst"), folder.alias("name"))
    return imports.select("repo", "lang", F.col("path").alias("src"), "name").distinct().join(held, ["repo", "lang", "name"]).where("src <> dst").drop("name")


def merged_lists(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """keys and the distinct members of their lists, ascending: nested maps merged with their lists united.

    Members are made distinct before lists form, so repeats never gather in one task.
    """
    each = rows.select(*keys, F.explode(column).alias("_m")).distinct()
    return each.groupBy(*keys).agg(F.array_sort(F.collect_list("_m")).alias(column))


def char_runs(text: Column | str) -> Column:
    """Runs of three or more equal characters that another character follows, each without its first."""
    return F.transform(F.regexp_extract_all(T.col(text), F.lit(r"(?s)((.)\2{2,}+)(?=.)"), F.lit(1)), lambda r: F.substring(r, F.lit(2), F.length(r)))


def run_counts(docs: DataFrame, more_than: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, span, n of the runs that a text holds more often than more_than."""
    each = docs.select(id_col, F.explode(char_runs(text_col)).alias("span"))
    return each.groupBy(id_col, "span").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def label_counts(rows: DataFrame, labels: Column, out: str = "label") -> DataFrame:
    """label, n_rows, n: in how many rows each label occurs, and how often."""
    held = F.transform(F.array_distinct(labels), lambda x: F.struct(x.alias(out), F.size(F.filter(labels, lambda y: y.eqNullSafe(x))).alias("n")))
    return rows.select(F.explode(held).alias("_l")).select("_l.*").groupBy(out).agg(F.count("*").alias("n_rows"), F.sum("n").alias("n"))


#: Fixed value: how logs name an extension without a rule.
UNKNOWN_EXTENSION = r"- \('([^']+)', '([^']+)'\):\S+ not in ext_to_filter"


def unknown_extensions(log: DataFrame, line_col: str = "value") -> DataFrame:
    """extension, n of those that log lines name as not known."""
    found = F.regexp_extract(line_col, UNKNOWN_EXTENSION, 2)
    return log.select(found.alias("extension")).where("extension <> ''").groupBy("extension").agg(F.count("*").alias("n"))


def best_similarity(matches: DataFrame, id_col: str = "doc_id", similarity: str = "similarity") -> DataFrame:
    """n, least, most and mean of each document's best similarity to a benchmark."""
    best = matches.groupBy(id_col).agg(F.max(similarity).alias("s"))
    return best.agg(F.count("*").alias("n"), F.min("s").alias("least"), F.max("s").alias("most"), F.avg("s").alias("mean"))


def split_names(span: Column | str) -> Column:
    """The names of an import of several parts, between commas and blanks, without brackets."""
    return F.filter(F.split(T.col(span), r"[,\n\t ]+", -1), lambda w: ~w.isin("", "(", ")"))


def save_copies(rows: DataFrame, path: str, sizes: list[int], order: list[str]) -> None:
    """All rows as JSON lines under path/all, and the first n in order under path/first_n for each size."""
    kept = Workspace(rows.sparkSession, "copies").keep(rows, "rows")
    kept.write.mode("overwrite").json(f"{path}/all")
    for n in sizes:
        kept.orderBy(*order).limit(n).write.mode("overwrite").json(f"{path}/first_{n}")


def save_with_part(rows: DataFrame, path: str, path_col: str, pattern: str) -> None:
    """All rows as JSON lines, and beside them the part whose path matches a pattern."""
    kept = Workspace(rows.sparkSession, "part").keep(rows, "rows")
    kept.write.mode("overwrite").json(f"{path}/all")
    kept.where(F.rlike(path_col, F.lit(pattern))).write.mode("overwrite").json(f"{path}/part")

"""Word counts, histograms and percentiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.operators.ranking import ranked
from textloom.session import Workspace


def top_words(docs: DataFrame, k: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The k most frequent words of each document: id, rank, word, n; ties to the smaller word."""
    counted = docs.select(id_col, F.explode(T.words(text_col)).alias("word")).groupBy(id_col, "word").agg(F.count("*").alias("n"))
    order = Window.partitionBy(id_col).orderBy(F.col("n").desc(), "word")
    return counted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def word_counts(docs: DataFrame, by: str = "lang", more_than: int = 500, text_col: str = "text") -> DataFrame:
    """Words that a group holds more often than more_than."""
    return docs.select(by, F.explode(T.words(text_col)).alias("word")).groupBy(by, "word").agg(F.count("*").alias("n")).where(F.col("n") > more_than)


def word_band(word: Column | str) -> Column:
    """Length band of a word: (1,6], (6,11], ... up to 1000; null outside."""
    n = F.length(T.col(word))
    return F.when(n.between(2, 6), 6).when(n.between(7, 1000), F.when(n > 36, 1000).otherwise((F.ceil((n - 6) / 5) * 5 + 6)).cast("int"))


def word_bands(docs: DataFrame, more_than: int = 10, text_col: str = "text") -> DataFrame:
    """Frequent words by length band: band, word, n."""
    counted = docs.select(F.explode(T.identifier_words(text_col)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") > more_than).select(word_band("word").alias("band"), "word", "n").where("band is not null")


def histogram(docs: DataFrame, by: str, k: int | None = None) -> DataFrame:
    """Rows of each value, the most frequent first, ties to the smaller value; the first k if k is given."""
    counted = docs.groupBy(by).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), by)
    return counted.limit(k) if k else counted


def size_bucket(n: Column | str) -> Column:
    """Sizes to 10 as they are, then the next hundred, 5000 at most."""
    n = T.col(n)
    return F.when(n <= 10, n).otherwise(F.least((F.floor(n / 100) + 1) * 100, F.lit(5000))).cast("long")


def cross_counts(docs: DataFrame, rows: str, columns: str, values: list) -> DataFrame:
    """Counts of each row value by the given column values, with the row's share of all rows."""
    made = docs.groupBy(rows).agg(F.count("*").alias("total"), *(F.count_if(F.col(columns).eqNullSafe(F.lit(v))).alias(f"n_{v}") for v in values))
    return made.withColumn("share", F.round(F.col("total") / F.sum("total").over(Window.partitionBy()), 6))


def percentiles(docs: DataFrame, value: Column, at: list[float], out: str = "p") -> DataFrame:
    """Interpolated percentiles, one column each."""
    found = docs.agg(F.percentile(value, F.array(*map(F.lit, at))).alias("_all"))
    return found.select(*(F.element_at("_all", i + 1).alias(f"{out}{round(100 * q):02d}") for i, q in enumerate(at)))


def nearest_percentiles(docs: DataFrame, value: str, at: list[float]) -> DataFrame:
    """sorted[int(n * p)] for each p: p, value.

    Values are counted first, so what is ordered is one row a distinct value, in buckets of
    the values' order if they are many.
    """
    counted = docs.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("value")).agg(F.count("*").alias("n"))
    counted = Workspace(docs.sparkSession, "percentiles").keep(counted, "counted")
    rows, all_ = counted.agg(F.count("*"), F.sum("n")).first()
    cuts = counted.select(F.percentile_approx("value", [i / 64 for i in range(1, 64)]).alias("c")).first().c or [] if rows > 20_000 else []
    bucket = sum(((F.col("value") > F.lit(c)).cast("int") for c in sorted(set(cuts))), F.lit(0))
    placed = ranked(counted.withColumn("_all", F.lit(0)).withColumn("_bucket", bucket), ["_all"], "_bucket", ["value"], "before", F.col("n"))
    wanted = placed.withColumn("p", F.explode(F.array(*map(F.lit, at)))).withColumn("place", F.floor(F.lit(all_ or 0) * F.col("p")))
    return wanted.where((F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n"))).select("p", "value")


def keep_first(docs: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in the given order.

    A partial aggregation finds each key's first order values and the row follows by a
    join, so a key that a third of all rows share is not sorted in one task. The order
    must be unique within a key.
    """
    first = docs.groupBy(*keys).agg(F.min(F.struct(*order)).alias("_first"))
    same = [docs[k].eqNullSafe(first[k]) for k in keys] + [F.struct(*(docs[o] for o in order)).eqNullSafe(first["_first"])]
    condition = same[0]
    for s in same[1:]:
        condition = condition & s
    return docs.join(first, condition, "left_semi")

"""Mix sources to target weights by Pareto order sampling."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.llm.common import key_column, keyed, word_counts
from textloom.operators.ranking import bucket_totals, buckets_for
from textloom.session import Workspace

WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SEED = 8
#: Exponent of a document's size in its inclusion probability; the odds that stand for certainty.
TILT = 0.5
SURE = -1.0


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", row_col: str | None = None) -> DataFrame:
    """row_key, doc_id, source and size (words of the text, null: 0) of each document."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, batch in keyed(batches):
            yield pa.RecordBatch.from_arrays([keys, batch.column(1), batch.column(2), pa.array(word_counts(batch.column(3)))], names=["row_key", "doc_id", "source", "size"])

    picked = docs.select(key_column(row_col), F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string"))
    return picked.mapInArrow(counted, "row_key long, doc_id long, source string, size long")


def targets(sized: DataFrame, weights: tuple[float, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_no, source_size and target of each source.

    Sources in code-point order, null last, weigh `weights` in turn and share the sum of
    all sizes; a target stops at `most` times its source's size and the excess is shared
    again by weight. Only per-source sums are handled: a source of any size is one row, a
    round of sharing is one aggregate of them, and each round caps at least one source. An
    empty table gives no rows.
    """
    work = Workspace(sized.sparkSession, "targets")
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size")).orderBy(F.col("source").asc_nulls_last())
    placed = work.keep(by.withColumn("_at", F.monotonically_increasing_id()), "sorted")
    part, tasks = F.shiftright("_at", 33), placed.groupBy(F.shiftright("_at", 33).alias("_part")).agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # over the sort's tasks, not over sources
    tasks = tasks.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    number = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    numbered = placed.withColumn("_part", part).join(tasks, "_part").withColumn("source_no", number)
    cycle = F.element_at(F.array(*map(F.lit, weights)), (F.pmod("source_no", F.lit(len(weights))) + 1).cast("int"))
    table = work.keep(numbered.select("source", "source_size", "source_no", cycle.alias("weight")), "sources")
    ratio = most * F.col("source_size") / F.col("weight")  # the share a unit of weight may get before the cap
    total = table.agg(F.sum("source_size")).first()[0] or 0
    unit = 0.0
    while total:
        free = ratio > unit
        fixed, weight = table.agg(F.sum(F.when(~free, most * F.col("source_size"))), F.sum(F.when(free, F.col("weight")))).first()
        if not weight:
            break
        after = (total - (fixed or 0)) / weight
        if after <= unit:
            break
        unit = after
    target = F.least(F.lit(float(unit)) * F.col("weight"), (most * F.col("source_size")).cast("double"))
    return work.keep(table.select("source", "source_no", "source_size", target.alias("target")), "targets")


def uniform(key: Column, seed: int) -> Column:
    """A number strictly between 0 and 1 that depends on the key and seed alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 12)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 52))


def size_class(size: str) -> Column:
    """The number of binary digits of a size, 0 for none."""
    return F.when(F.col(size) > 0, F.floor(F.log2(F.col(size).cast("double"))) + 1).otherwise(0).cast("int")


def class_odds(classes: list[tuple[int, int, int]], wanted: float, tilt: float) -> list[float]:
    """Inclusion odds of a document in each size class (class, documents, words) of a source; SURE for those certain.

    A document's inclusion probability is in proportion to 2 ** (tilt * class), one at most,
    and such that `wanted` words are expected.
    """
    lift = [2.0 ** (tilt * c) for c, _, _ in classes]
    rest, scale = sum(w * x for (_, _, w), x in zip(classes, lift)), 0.0
    for i in sorted(range(len(classes)), key=lambda i: -lift[i]):  # the largest are certain first
        scale = max(0.0, wanted) / rest if rest > 0 else math.inf
        if scale * lift[i] < 1:
            break
        wanted, rest, scale = wanted - classes[i][2], rest - classes[i][2] * lift[i], math.inf
    share = [scale * x for x in lift]
    return [x / (1 - x) if x < 1 else SURE for x in share]


def mix(sized: DataFrame, target: DataFrame, seed: int = SEED, tilt: float = TILT) -> DataFrame:
    """Each row of written sizes() with its source's target and `copies`, how often the mix takes it.

    A source wanted r times over gives floor(r) certain copies of each document; the rest is
    a Pareto sample: a document's inclusion probability grows with its size (size ** tilt,
    by size class), documents are ranked by their random odds over their inclusion odds, and
    the first are taken up to a fixed size in words, the one that crosses the rest included
    only if that comes nearer. Documents whose probability reaches one are certain too. The
    random number depends on doc_id and seed; equal ranks go by doc_id (nulls first), then
    row key; documents without words get the certain copies; null sources are one source. An
    empty table gives no rows.

    Sources are cut into buckets of the rank's own order. The expected number of a source's
    rows up to a rank follows from its classes and makes buckets even, so no source is sorted
    in one task.
    """
    work = Workspace(sized.sparkSession, "mix")

    @F.pandas_udf("array<double>")
    def solved(classes: pd.Series, wanted: pd.Series) -> pd.Series:
        return pd.Series([class_odds([(x["c"], x["n"], x["w"]) for x in cs], w, tilt) for cs, w in zip(classes, wanted)], dtype=object)

    by = sized.where("size > 0").groupBy(F.col("source").alias("_s"), size_class("size").alias("c")).agg(F.count("*").alias("n"), F.sum("size").alias("w"))
    by = by.groupBy("_s").agg(F.array_sort(F.collect_list(F.struct("c", "n", "w"))).alias("_classes"))  # 64 classes at most
    known = target.join(by, target.source.eqNullSafe(by._s), "left").drop("_s").withColumnRenamed("source", "_s")
    goal = F.coalesce(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size")), F.lit(0.0))
    known = known.withColumn("_whole", F.floor(goal).cast("int")).withColumn("_wanted", F.col("target") - F.col("_whole") * F.col("source_size"))
    known = known.withColumn("_odds", F.when(F.col("_classes").isNotNull(), solved("_classes", "_wanted")))
    known = known.withColumn("_classes", F.arrays_zip("_classes", "_odds")).drop("_odds")
    sure = F.aggregate("_classes", F.lit(0).cast("long"), lambda a, x: a + F.when(x["_odds"] == SURE, x["_classes"]["w"]).otherwise(0))
    known = work.keep(known.withColumn("_wanted", F.col("_wanted") - F.coalesce(sure, F.lit(0))), "known")
    rows = sized.join(known, sized.source.eqNullSafe(known._s)).drop("_s")
    own = F.filter("_classes", lambda x: x["_classes"]["c"] == size_class("size"))
    rows = rows.withColumn("_odds", F.when(F.col("size") > 0, F.element_at(own, 1)["_odds"]).otherwise(0.0))
    columns = ["row_key", "doc_id", "source", "size", "source_size", "target"]
    settled = rows.where("_odds <= 0").select(*columns, (F.col("_whole") + (F.col("_odds") == SURE).cast("int")).alias("copies"))
    u = uniform(F.coalesce("doc_id", "row_key"), seed)
    drawn = rows.where("_odds > 0").withColumn("_rank", u / (1 - u) / F.col("_odds"))
    upto = F.aggregate("_classes", F.lit(0.0), lambda a, x: a + F.when(x["_odds"] > 0, x["_classes"]["n"] * (1 - 1 / (1 + F.col("_rank") * x["_odds"]))).otherwise(0.0))
    all_ = F.aggregate("_classes", F.lit(0.0), lambda a, x: a + F.when(x["_odds"] > 0, x["_classes"]["n"]).otherwise(0))
    n = buckets_for(sized.count(), 1_000)
    drawn = drawn.withColumn("_bucket", F.least(F.floor(upto / all_ * n), F.lit(n - 1)).cast("int")).drop("_classes", "_odds")
    totals = bucket_totals(drawn, ["source_no"], "_bucket", F.col("size")).select("source_no", "_bucket", "_before")
    drawn = drawn.join(totals, ["source_no", "_bucket"])
    inside = Window.partitionBy("source_no", "_bucket").orderBy("_rank", "doc_id", "row_key").rowsBetween(Window.unboundedPreceding, -1)
    ahead = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    taken = (ahead + F.col("size") / 2 <= F.col("_wanted")).cast("int")
    return settled.unionByName(drawn.select(*columns, (F.col("_whole") + taken).alias("copies")))

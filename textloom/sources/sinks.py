"""Sinks: sharded, partitioned and size-bounded outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.ranking import bucket_totals, buckets_for

SHARD_BYTES = 1 << 30


def save(df: DataFrame, path: str, kind: str = "parquet", by: list[str] | None = None, rows_per_file: int = 300_000, mode: str = "overwrite") -> None:
    """Parquet, ORC, JSON lines or text files of bounded rows, in folders by column values where asked."""
    writer = df.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
    (writer.partitionBy(*by) if by else writer).format(kind).save(path)


def save_shards(df: DataFrame, path: str, text_col: str, order: str, shard_bytes: int = SHARD_BYTES, name: str = "train") -> int:
    """Parquet shards of about shard_bytes of text each, contiguous in the given order, named train-00000-of-00004; returns how many."""
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    df.repartitionByRange(int(size // shard_bytes) + 1, order).write.mode("overwrite").parquet(path)
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    parts = sorted((s.getPath() for s in fs.listStatus(at) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    for i, part in enumerate(parts):
        fs.rename(part, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at, f"{name}-{i:05d}-of-{len(parts):05d}.parquet"))
    return len(parts)


def sized_groups(df: DataFrame, size_col: str, order: str, most: int) -> DataFrame:
    """df with `file_no`: rows in order, a new number whenever the sizes so far pass another multiple of `most`.

    order is a non-negative number. The running sum is kept over buckets of its range, not
    over one sorted window.
    """
    n, top = df.agg(F.count("*"), F.max(order)).first()
    width = max(1, -(-((top or 0) + 1) // buckets_for(n)))
    rows = df.withColumn("_all", F.lit(0)).withColumn("_bucket", F.floor(F.col(order) / width))
    before = bucket_totals(rows, ["_all"], "_bucket", F.col(size_col)).select("_bucket", "_before")
    inside = Window.partitionBy("_bucket").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    summed = rows.join(before, "_bucket").withColumn("_sum", F.col("_before") + F.coalesce(F.sum(size_col).over(inside), F.lit(0)))
    return summed.withColumn("file_no", F.floor(F.col("_sum") / most).cast("long")).drop("_all", "_bucket", "_before", "_sum")


def save_sized_json(df: DataFrame, path: str, order: str, most: int = 50_000_000) -> None:
    """JSON lines in folders file_no=0, 1, ... of about `most` characters each."""
    rows = df.withColumn("_size", F.length(F.to_json(F.struct(*df.columns))))
    sized_groups(rows, "_size", order, most).drop("_size").repartition("file_no").write.mode("overwrite").partitionBy("file_no").json(path)


def save_split(kept: DataFrame, gone: DataFrame, path: str, by: list[str]) -> None:
    """Kept rows, excluded rows with their reasons, and counts by the given columns, side by side."""
    kept.write.mode("overwrite").parquet(f"{path}/kept")
    gone.write.mode("overwrite").json(f"{path}/excluded")
    gone.groupBy(*by).agg(F.count("*").alias("n")).write.mode("overwrite").json(f"{path}/counts")


def save_list(df: DataFrame, column: str, path: str) -> None:
    """Distinct values, one a line."""
    df.select(F.col(column).cast("string").alias("value")).where("value is not null").distinct().write.mode("overwrite").text(path)

"""Gapless ranks and prefix sums that never gather a segment in one task.

A window over one segment sorts the whole segment in one task, which fails when a
segment holds a third of all rows. Here every segment is cut into order-preserving
buckets; only bucket totals are accumulated over the segment, rows are ranked within
their bucket alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def bucket_totals(df: DataFrame, segment: Sequence[str], bucket: str, amount: Column) -> DataFrame:
    """Sum of amount in each bucket, and `_before`: the sum over the segment's earlier buckets."""
    totals = df.groupBy(*segment, bucket).agg(F.sum(amount).alias("_total"))
    earlier = Window.partitionBy(*segment).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return totals.withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))


def ranked(
    df: DataFrame,
    segment: Sequence[str],
    bucket: str,
    order: Sequence[Column | str],
    out: str = "rank",
    amount: Column | None = None,
) -> DataFrame:
    """Add to each row the sum of amount (1 unless given) over the rows before it.

    With amount 1 that is a rank from 0 without gaps in each segment. Rows are ordered by
    bucket, then by `order`, which must be total for the result to be repeatable. df is
    read twice and must give the same rows both times. Segment and bucket columns must
    not be null. An empty df gives an empty result.
    """
    amount = F.lit(1).cast("long") if amount is None else amount
    keys = [*segment, bucket]
    before = bucket_totals(df, segment, bucket, amount).select(*keys, "_before")
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = F.coalesce(F.sum(amount).over(inside), F.lit(0))
    return df.join(before, keys).withColumn(out, (F.col("_before") + local).cast("long")).drop("_before")


def buckets_for(rows: int, each: int = 20_000, most: int = 1 << 16) -> int:
    """How many buckets keep a bucket near `each` rows even if one segment has all rows."""
    return max(1, min(most, -(-rows // each)))

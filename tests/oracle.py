"""Runs registered queries and their DuckDB twins on the same tables and compares rows."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.sql(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return con


def difference(df, sql: str, con) -> str | None:
    """What differs between a Spark result and the oracle's, or None."""
    mine = df.toPandas()
    theirs = con.sql(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} and {sorted(theirs.columns)}"
    names = sorted(mine.columns)
    a, b = (sorted(map(repr, x[names].astype(object).itertuples(index=False, name=None))) for x in (mine, theirs))
    if a == b:
        return None
    only_a, only_b = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    return f"{len(a)} and {len(b)} rows; {len(only_a)} and {len(only_b)} alone: {str(only_a[:2])[:500]} | {str(only_b[:2])[:500]}"


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    spark = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    where = sys.argv[1]
    con, queries, sql = connect(where), entry.queries(), entry.oracle_sql()
    for name in sys.argv[2:] or [n for n in queries if not n.startswith("op") and n != "pipeline"]:
        began = time.time()
        try:
            told = difference(queries[name](spark, where), sql[name], con) if name in sql else f"rows only: {queries[name](spark, where).count()}"
        except Exception as e:  # noqa: BLE001
            told = f"ERROR {str(e)[:600]}"
        print(f"{name}: {told or 'same'} ({time.time() - began:.1f} s)", flush=True)

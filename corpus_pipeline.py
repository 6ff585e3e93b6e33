"""Documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns
a DataFrame whose Parquet is the next one's docs. All but the last return the columns of
documents. Null texts are empty texts, null ids stay, repeated rows are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, mixing, near_copies, packing, toxicity
from textloom.llm.common import documents, free_name
from textloom.session import Workspace

REJECTED_FROM = 0.5
#: Row numbers that are sent to every executor at most.
BROADCAST_ROWS = 1 << 20


def _numbered(docs: DataFrame, work: Workspace) -> tuple[DataFrame, str]:
    """docs with a row number that later reads agree on, since it is written with them; and that column's name."""
    row = free_name(docs, "_row")
    return work.keep(docs.withColumn(row, F.monotonically_increasing_id()), "numbered", compression="zstd"), row


def _without(rows: DataFrame, row: str, gone: DataFrame, work: Workspace) -> DataFrame:
    """rows without those numbered in gone: where rows lie if gone is small, else by a shuffled join."""
    gone = work.keep(gone, "gone")
    side = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return rows.join(side, row, "left_anti").drop(row)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below REJECTED_FROM."""
    work = Workspace(spark, "toxic")
    rows, row = _numbered(docs, work)
    model, counted = toxicity.fit_counted(rows, spark.read.parquet(f"{sf_dir}/labels.parquet"), keep=row)
    bad = toxicity.score_counted(counted, model).where(F.col("score") >= REJECTED_FROM)
    kept = _without(rows, row, bad.select(F.col("row").alias(row)), work)
    model.release()
    work.drop(counted)
    return kept


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the row with the largest doc_id. The lower half of the ids is the history."""
    work = Workspace(spark, "copies")
    rows, row = _numbered(docs, work)
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    hashed = work.keep(exact_dedup.digests(rows, f"doc_id < {((low or 0) + (high or 0)) // 2}", row_col=row), "hashed")
    found = exact_dedup.exact_dedup(rows, hashed=hashed)
    kept = _without(rows, row, found.where("not kept").select(F.col("row_key").alias(row)), work)
    work.drop(hashed)
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose five-word shingles are alike (Jaccard 0.8 or more), the row with the smallest doc_id."""
    work = Workspace(spark, "near")
    rows, row = _numbered(docs, work)
    found = near_copies.near_copies(rows, row)
    ids = rows.select(F.col(row).alias("row_key"), "doc_id")
    placed = work.keep(found.join(ids, "row_key"), "placed")
    first = placed.groupBy("component").agg(F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("first"))
    kept = _without(rows, row, placed.join(first, "component").where("row_key <> first").select(F.col("row_key").alias(row)), work)
    work.drop(placed)
    return kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, towards their sources' target weights."""
    work = Workspace(spark, "mix")
    rows, row = _numbered(docs, work)
    sized = work.keep(mixing.sizes(rows, row_col=row), "sizes")
    times = mixing.mix(sized, mixing.targets(sized)).where("copies > 0")
    taken = times.select(F.col("row_key").alias(row), F.sequence(F.lit(1), F.col("copies")).alias(free_name(rows, "_times")))
    return rows.join(taken, row).withColumn(free_name(rows, "_copy"), F.explode(free_name(rows, "_times"))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens with their sequence and offset."""
    pieces = packing.encode_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(Workspace(spark, "pack").keep(pieces, "pieces")).drop("row_key")


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

#: Trained scores, hashes of shingles and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to documents, each but the last written before the next reads it."""
    work, docs = Workspace(spark, "pipeline"), documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = work.keep(stage(spark, docs, sf_dir), name, compression="zstd")
    return STAGES[-1][1](spark, docs, sf_dir)

"""Near-dedup of arriving batches against the band keys seen before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from textloom.operators import minhash
from textloom.session import Workspace


def new_documents(batch: DataFrame, seen: DataFrame | None, ngram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A batch's documents that share no band with earlier ones nor with a smaller id of the batch; and their bands."""
    work = Workspace(batch.sparkSession, "incremental")
    banded = work.keep(minhash.bands(batch, ngram=ngram, id_col=id_col, text_col=text_col), "bands")
    kept = minhash.survivors(batch, minhash.near_components(banded, id_col), id_col)
    if seen is not None:
        met = banded.join(seen.select("band", "key").distinct(), ["band", "key"], "left_semi").select(id_col).distinct()
        kept = kept.join(met, id_col, "left_anti")
    kept = work.keep(kept, "kept")
    return kept, banded.join(kept.select(id_col), id_col, "left_semi")


def dedup_stream(stream: DataFrame, out: str, checkpoint: str, ngram: int = 5, id_col: str = "doc_id", text_col: str = "text") -> StreamingQuery:
    """Append the new documents of each micro-batch to out/docs and their bands to out/bands.

    Each batch writes folders of its own number and reads those of smaller numbers, so a
    batch that runs again gives the same rows.
    """

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = None
        if number:
            bands = spark.read.option("recursiveFileLookup", "false").parquet(f"{out}/bands")
            seen = bands.where(F.col("batch") < number)
        kept, banded = new_documents(batch, seen, ngram, id_col, text_col)
        kept.write.mode("overwrite").parquet(f"{out}/docs/batch={number}")
        banded.write.mode("overwrite").parquet(f"{out}/bands/batch={number}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

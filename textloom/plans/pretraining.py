"""Files to training samples: filter, near-dedup, clean, redact, build samples."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textloom.functions import pii
from textloom.operators import fim, filters, lines, minhash
from textloom.session import Workspace


def pretraining_samples(files: DataFrame, ngram: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", path_col: str | None = None) -> DataFrame:
    """id, kind, sample of the files that pass the filters, one a near-duplicate group, cleaned and redacted.

    threshold shapes the bands; candidates count as near-duplicates from a similarity of 0.8 on.
    """
    work = Workspace(files.sparkSession, "pretraining")
    kept = work.keep(filters.repo_rules(files, text_col), "kept")
    signed = work.keep(minhash.signed(kept, ngram, threshold, id_col=id_col, text_col=text_col), "signed")
    _, components = minhash.near_links(signed, id_col=id_col)
    single = minhash.survivors(kept, components, id_col)
    clean = pii.scan_and_redact(lines.regex_clean(single, text_col, path_col), text_col)
    return fim.samples(clean.drop(text_col).withColumnRenamed("new_text", text_col), id_col, text_col, lang_col)

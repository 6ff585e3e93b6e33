"""The registered queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import exact_dedup, mixing, packing, sharding, simhash, substring_dedup, token_counts, token_files, topk_search, toxicity
from textloom.llm.common import documents
from textloom.session import Workspace


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: the row that stays in its group. The lower half of the ids is the history."""
    docs = documents(spark, sf_dir)
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    found = exact_dedup.exact_dedup(docs, old=f"doc_id < {((low or 0) + (high or 0)) // 2}")
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op2_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its shard of 40 and its slot there; shards' row counts are at most one apart."""
    found = sharding.shard(documents(spark, sf_dir))
    return found.select("doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per piece of every document: its place, its ids' crc32 and its sequence."""
    work = Workspace(spark, "op3")
    pieces = packing.encode_pieces(documents(spark, sf_dir)).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.assign(work.keep(pieces, "pieces")).drop("row_key")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: whether its label is held out, its score, and the label the score predicts."""
    docs = documents(spark, sf_dir)
    model, counted = toxicity.fit_counted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score_counted(counted, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts.token_counts(documents(spark, sf_dir))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its words, how many repeated windows remove, and the hash of what stays."""
    found = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten highest inner products of every vector whose id is divisible by 100, over all other vectors."""
    return topk_search.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id % 100 = 0")


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its source's target and how many of its words the mix takes."""
    work = Workspace(spark, "op8")
    sized = work.keep(mixing.sizes(documents(spark, sf_dir)), "sizes")
    mixed = mixing.mix(sized, mixing.targets(sized))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its fingerprint and the smallest doc_id that links of at most two bits reach."""
    found = simhash.near_duplicates(documents(spark, sf_dir))
    return found.select("doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id")


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, read back from the written files: its first id's place, number of ids and their crc32."""
    path = Workspace(spark, "op10").path("token-files")
    token_files.write_token_files(documents(spark, sf_dir), path)
    read = token_files.read_token_files(spark, path)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_balanced_sharding": op2_balanced_sharding,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_toxicity": op4_toxicity,
    "op5_token_counts": op5_token_counts,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_topk_search": op7_topk_search,
    "op8_source_mixing": op8_source_mixing,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_token_files": op10_token_files,
}

_WORD = "[^\\x20\\x09-\\x0D]+"

#: What SQL can express. Perfect balance, packing, sampling, fingerprints, trained scores and token ids are beyond it.
ORACLE_SQL: dict[str, str] = {
    "op1_exact_dedup": """
        select doc_id, max(doc_id) over g keep_id, count(*) over g group_size, doc_id = max(doc_id) over g kept, sha256(t) text_sha256
        from (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents)
        window g as (partition by t)""",
    "op6_substring_dedup": f"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') w from documents),
        t as (select doc_id, unnest(w) w, generate_subscripts(w, 1) i, len(w) n from d),
        s as (select *, string_agg(w, ' ') over (partition by doc_id order by i rows between current row and 34 following) s from t),
        r as (select *, case when i <= n - 34 and count(*) over (partition by s, i <= n - 34) > 1 then i end start from s),
        c as (select *, coalesce(i - max(start) over (partition by doc_id order by i) < 35, false) gone from r),
        k as (select doc_id, count(*) n, count(*) filter (gone) removed, string_agg(w, ' ' order by i) filter (not gone) kept from c group by doc_id)
        select doc_id, coalesce(n, 0) n_words, coalesce(removed, 0) n_removed, sha256(coalesce(kept, '')) kept_sha256 from documents left join k using (doc_id)""",
    "op7_topk_search": """
        with v as (select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) e from embeddings
          where len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        s as (select a.vec_id query_id, b.vec_id, list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2]))::bigint score from v a, v b where a.vec_id % 100 = 0 and a.vec_id <> b.vec_id)
        select query_id, rank, vec_id, score from (select *, (row_number() over (partition by query_id order by score desc, vec_id))::int rank from s) where rank <= 10""",
}

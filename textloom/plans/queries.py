"""Registered queries over the driver's tables, each with its DuckDB twin where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.functions import pii, sequences
from textloom.functions import text as T
from textloom.operators import decontamination, discussions, evaluation, filters, fim, graph, interactions, lines, metadata, minhash, rows, vocabulary
from textloom.session import Workspace, spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its oracle."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents over all cores, for queries that work hard on each text."""
    return spread(docs(spark, sf_dir))


def r4(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


# ---- line statistics and filters

_STATS = """select *, regexp_replace(text, '[^\\p{Nd}]', '', 'g') dg, regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g') an, regexp_replace(text, '[^\\p{L}]', '', 'g') al,
  list_transform(string_split(text, chr(10)), lambda x: length(x)) ll from documents"""
_MEASURED = f"""select doc_id, text, lang, source, length(text) size, len(ll) n_lines, list_max(ll) max_line, list_sum(ll) / len(ll) avg_line,
  case when length(text) = 0 then 0.0 else length(dg) / length(text) end digit_ratio, case when length(text) = 0 then 0.0 else length(an) / length(text) end alnum_fraction,
  case when length(text) = 0 then 0.0 else length(al) / length(text) end alpha_fraction from ({_STATS})"""


@query(f"select doc_id, n_lines::bigint n_lines, max_line::bigint max_line, round(avg_line, 4) avg_line, round(digit_ratio, 4) digit_ratio, round(alnum_fraction, 4) alnum_fraction, size::bigint size from ({_MEASURED})")
def line_stats(spark, sf_dir):
    found = filters.line_stats(wide(spark, sf_dir))
    return found.select("doc_id", "n_lines", "max_line", r4("avg_line").alias("avg_line"), r4("digit_ratio").alias("digit_ratio"), r4("alnum_fraction").alias("alnum_fraction"), "size")


@query(f"select lang, count(*) n_docs, round(avg(avg_line), 4) mean_line, max(max_line)::bigint longest from ({_MEASURED}) where max_line <= 1000 and avg_line <= 100 and alnum_fraction >= 0.25 group by lang")
def filter_basic(spark, sf_dir):
    kept = filters.line_stats(filters.basic(wide(spark, sf_dir)))
    return kept.groupBy("lang").agg(F.count("*").alias("n_docs"), r4(F.avg("avg_line")).alias("mean_line"), F.max("max_line").alias("longest"))


_RULES = [("en", 1, 2000, 100, 0.5, 0.5), ("fr", 1, None, None, 0.25, None), ("de", 1, 800, 100, None, 0.6), ("es", 0, None, None, None, None)]


@query(f"""select doc_id from ({_MEASURED}) where (lang = 'en' and max_line <= 2000 and avg_line <= 100 and alnum_fraction >= 0.5 and alpha_fraction >= 0.5)
  or (lang = 'fr' and alnum_fraction >= 0.25) or (lang = 'de' and max_line <= 800 and avg_line <= 100 and alpha_fraction >= 0.6)""")
def filter_basic_per_lang(spark, sf_dir):
    rules = spark.createDataFrame(_RULES, "lang string, include int, line_max int, line_mean int, alnum double, alpha double")
    return filters.basic_by_rule(wide(spark, sf_dir), F.broadcast(rules), ["lang"]).select("doc_id")


@query("select doc_id, length(text)::bigint size from documents where length(text) between 100 and 5000")
def filter_size(spark, sf_dir):
    return filters.by_size(docs(spark, sf_dir)).select("doc_id", F.length("text").cast("long").alias("size"))


@query(f"select doc_id, size::bigint size from ({_MEASURED}) where max_line <= 1000 and floor(avg_line) >= 5 and digit_ratio <= 0.25 and trim(regexp_replace(text, '\\s+', ' ', 'g')) <> ''")
def filter_repo_rules(spark, sf_dir):
    return filters.repo_rules(wide(spark, sf_dir)).select("doc_id", F.length("text").cast("long").alias("size"))


@query("select page_id from pages where position('<?xml version=' in substr(html, 1, 100)) = 0")
def filter_xml(spark, sf_dir):
    return filters.not_xml(table(spark, sf_dir, "pages"), "html").select("page_id")


_VISIBLE = "trim(regexp_replace(regexp_replace(html, '(?is)<(script|style)\\b[^>]*>.*?</(script|style)\\s*>|<!--.*?-->|<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


@query(f"select page_id, length({_VISIBLE})::bigint visible from pages where length({_VISIBLE}) > 100 and length({_VISIBLE}) > 0.2 * length(html)")
def filter_html_ratio(spark, sf_dir):
    return filters.visible_enough(table(spark, sf_dir, "pages")).select("page_id", F.length(filters.visible_text("html")).cast("long").alias("visible"))


@query("""select 'before' step, count(*) n_rows, coalesce(sum(length(text)), 0)::bigint volume from documents union all
  select 'after', count(*), coalesce(sum(length(text)), 0)::bigint from documents where length(text) between 100 and 5000""")
def filter_volume(spark, sf_dir):
    d = docs(spark, sf_dir)
    return filters.filtered_volume(d, filters.by_size(d))


# ---- vocabulary, histograms, percentiles

_WORDS = "select *, unnest(list_filter(regexp_split_to_array(text, '[ \\t\\n\\r]+'), lambda w: w <> '')) word from documents"
_PARTS = "select unnest(list_filter(regexp_split_to_array(regexp_replace(text, '([A-Z][a-z])', chr(9) || '\\1', 'g'), '[\\t \\n_]+'), lambda w: w <> '')) word from documents"


@query(f"select doc_id, rank::bigint rank, word, n from (select *, row_number() over (partition by doc_id order by n desc, word) rank from (select doc_id, word, count(*) n from ({_WORDS}) group by all)) where rank <= 5")
def top_words_per_doc(spark, sf_dir):
    return vocabulary.top_words(wide(spark, sf_dir)).select("doc_id", F.col("rank").cast("long").alias("rank"), "word", "n")


@query(f"select lang, word, count(*) n from ({_WORDS}) group by all having count(*) > 500")
def lang_word_counts(spark, sf_dir):
    return vocabulary.word_counts(wide(spark, sf_dir)).select("lang", "word", "n")


@query(f"""select (case when length(word) <= 6 then 6 when length(word) > 36 then 1000 else ceil((length(word) - 6) / 5.0) * 5 + 6 end)::bigint band, word, count(*) n
  from ({_PARTS}) where length(word) between 2 and 1000 group by word having count(*) > 10""")
def word_bands(spark, sf_dir):
    return vocabulary.word_bands(wide(spark, sf_dir)).select(F.col("band").cast("long").alias("band"), "word", "n")


@query("select lang, count(*) n from documents group by lang order by n desc, lang limit 3")
def lang_histogram_top(spark, sf_dir):
    return vocabulary.histogram(docs(spark, sf_dir), "lang", 3)


@query("""select source, count(*) total, count(*) filter (lang = 'en') n_en, count(*) filter (lang = 'fr') n_fr, count(*) filter (lang = 'de') n_de, count(*) filter (lang = 'es') n_es,
  round(count(*) / sum(count(*)) over (), 6)::double "share" from documents group by source""")
def pivot_lang_source(spark, sf_dir):
    return vocabulary.cross_counts(docs(spark, sf_dir), "source", "lang", ["en", "fr", "de", "es"])


@query("select (case when n_chars <= 10 then n_chars else least((floor(n_chars / 100) + 1) * 100, 5000) end)::bigint bucket, count(*) n from documents group by 1")
def size_histogram(spark, sf_dir):
    return docs(spark, sf_dir).groupBy(vocabulary.size_bucket("n_chars").alias("bucket")).agg(F.count("*").alias("n"))


@query("select round(quantile_cont(n_chars, 0.05), 4) p05, round(quantile_cont(n_chars, 0.5), 4) p50, round(quantile_cont(n_chars, 0.95), 4) p95 from documents")
def percentiles_interp(spark, sf_dir):
    found = vocabulary.percentiles(docs(spark, sf_dir), F.col("n_chars"), [0.05, 0.5, 0.95])
    return found.select(*(r4(c).alias(c) for c in found.columns))


_AT = [0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99]


@query(f"""with s as (select n_chars "value", row_number() over (order by n_chars) - 1 i, count(*) over () n from documents), p as (select unnest({_AT})::double p)
  select p, "value" from s, p where i = floor(n * p)""")
def percentiles_nearest(spark, sf_dir):
    return vocabulary.nearest_percentiles(docs(spark, sf_dir), "n_chars", _AT)


@query("select min(doc_id) doc_id, text from documents group by text")
def exact_dedup_keep_first(spark, sf_dir):
    return vocabulary.keep_first(docs(spark, sf_dir), ["text"], ["doc_id"]).select("doc_id", "text")


# ---- lines and texts

_IDENT = "list_filter(regexp_split_to_array(regexp_replace(line, '([A-Z][a-z])', chr(9) || '\\1', 'g'), '[\\t \\n_]+'), lambda w: w <> '')"


@query(f"""with l as (select doc_id, unnest(string_split(text, chr(10))) line, generate_subscripts(string_split(text, chr(10)), 1) pos from documents),
  w as (select *, {_IDENT} w from l), p as (select *, coalesce(lag(line) over o, '') pl, coalesce(lag(w) over o, []) pw from w where len(w) > 0 window o as (partition by doc_id order by pos)),
  s as (select *, len(list_intersect(pw, w)) c, len(list_distinct(pw)) da, len(list_distinct(w)) db, greatest(length(pl), length(line)) m,
    len(list_filter(range(1, least(length(pl), length(line)) + 1), lambda i: substr(pl, i, 1) = substr(line, i, 1))) e from p),
  k as (select * from s where (length(regexp_replace(line, '[^\\p{{Han}}A-Za-z0-9]', '', 'g')) < 5 and regexp_matches(line, '[{{}}<>]'))
    or not ((da > 0 and c / da > 0.7 and c / db > 0.7) or (m > 0 and e / m > 0.7)))
  select d.doc_id, coalesce(t, '') text from documents d left join (select doc_id, string_agg(line, chr(10) order by pos) t from k group by doc_id) using (doc_id)""")
def neighbour_line_dedup(spark, sf_dir):
    return lines.neighbour_dedup(docs(spark, sf_dir))


@query()
def duplicate_line_collapse(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", lines.collapse_repeated_lines("text").alias("text"))


@query()
def regex_clean(spark, sf_dir):
    return lines.regex_clean(docs(spark, sf_dir), path_col="source").select("doc_id", "text")


@query("select doc_id, regexp_replace(text, '\\n{2,}', chr(10), 'g') text from documents")
def newline_collapse(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.collapse_newlines("text").alias("text"))


@query("select doc_id, regexp_replace(text, '(?s)\\(.*?\\)', '', 'g') text from documents")
def signature_clean(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", T.clean_signature("text").alias("text"))


@query("select doc_id, i::bigint part, substr(text, i * 1000 + 1, 1000) piece from (select *, unnest(range(0, ceil(length(text) / 1000)::int)) i from documents)")
def window_split_fixed(spark, sf_dir):
    found = docs(spark, sf_dir).select("doc_id", F.posexplode(T.fixed_windows("text", 1000)).alias("part", "piece"))
    return found.withColumn("part", F.col("part").cast("long"))


@query()
def window_split_lines(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", F.posexplode(lines.line_windows("text", 2000)).alias("part", "piece"))


@query("""select doc_id, '<|PathStart|>' || chr(9) || '#Path:' || substr(source, 4) || '/' || lang || '<|PathEnd|>' || chr(10) || text content from documents""")
def path_header(spark, sf_dir):
    path = F.concat("source", F.lit("/"), "lang")
    return docs(spark, sf_dir).select("doc_id", T.with_path_header(path, "text", "src").alias("content"))


@query("select p_partkey, case when p_size = 0 then '0' when p_size <= 10 then '1-10' when p_size <= 100 then '10-100' when p_size <= 1000 then '100-1000' else '1000+' end bucket from part")
def star_bucket(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", metadata.star_bucket("p_size").alias("bucket"))


_U = "('0x' || substr(md5(doc_id::varchar || '{}'), 1, 8))::bigint / 4294967296.0"


@query(f"""select doc_id, (case when {_U.format('reponame')} < 0.2 then '<reponame>' || source else '' end) || (case when {_U.format('filename')} < 0.2 then '<filename>' || lang else '' end)
  || (case when {_U.format('gh_stars')} < 0.2 then '<gh_stars>' || (case when n_chars % 20 = 0 then '0' when n_chars % 20 <= 10 then '1-10' else '10-100' end) else '' end)
  || (case when {_U.format('reponame')} < 0.2 or {_U.format('filename')} < 0.2 or {_U.format('gh_stars')} < 0.2 then chr(10) else '' end) || text content from documents""")
def meta_prefix(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", metadata.with_metadata("text", "source", "lang", F.col("n_chars") % 20, "doc_id").alias("content"))


# ---- shingles and near-duplicates

_PIECES = "regexp_split_to_array(text, '[^A-Za-z_0-9]')"
_GRAMS = f"""select distinct doc_id, gram from (select doc_id, w || ' ' || lead(w, 1) over o || ' ' || lead(w, 2) over o || ' ' || lead(w, 3) over o || ' ' || lead(w, 4) over o gram
  from (select doc_id, unnest({_PIECES}) w, generate_subscripts({_PIECES}, 1) i from documents) window o as (partition by doc_id order by i)) where gram is not null"""
_H32 = "('0x' || substr(h, 7, 2) || substr(h, 5, 2) || substr(h, 3, 2) || substr(h, 1, 2))::bigint"


@query(f"select doc_id, gram from ({_GRAMS})")
def shingles(spark, sf_dir):
    return minhash.gram_rows(docs(spark, sf_dir))


@query(f"select doc_id, {_H32} hash from (select doc_id, sha1(text) h from documents)")
def token_hash32(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", T.hash32("text").alias("hash"))


@query()
def minhash_bands_exact(spark, sf_dir):
    found = minhash.bands(docs(spark, sf_dir))
    return found.select("doc_id", "band", F.hex("key").alias("key"))


_LANES = ", ".join(f"min(({a}::bigint * h + {b}) % {minhash.SQL_PRIME}) m{i}" for i, (a, b) in enumerate(minhash.sql_permutations(12)))
_BANDED = f"""select doc_id, j::int band, (case j {' '.join(f"when {j} then m{3 * j} || '-' || m{3 * j + 1} || '-' || m{3 * j + 2}" for j in range(4))} end) "key" from
  (select doc_id, {_LANES} from (select doc_id, {_H32} % {minhash.SQL_PRIME} h from (select doc_id, sha1(gram) h from ({_GRAMS}))) group by doc_id), (select unnest(range(4)) j)"""


@query(_BANDED)
def lsh_bands(spark, sf_dir):
    return minhash.sql_bands(wide(spark, sf_dir))


def _near_links(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Links of similarity 0.8 or more among documents that share one of the bands of 128 permutations."""
    return minhash.near_links(Workspace(spark, "signed").keep(minhash.signed(docs(spark, sf_dir), threshold=CANDIDATES), "signed"))


#: What shapes the bands: 21 of 6 rows, under which a pair of similarity 0.8 is a candidate with probability 0.998.
CANDIDATES = 0.58


@query()
def near_dup_edges(spark, sf_dir):
    links, _ = _near_links(spark, sf_dir)
    return links.select(F.col("b").alias("src"), F.col("a").alias("dst"))


@query()
def near_dup_components(spark, sf_dir):
    return _near_links(spark, sf_dir)[1]


@query()
def near_dup_survivors(spark, sf_dir):
    return minhash.survivors(docs(spark, sf_dir), _near_links(spark, sf_dir)[1]).select("doc_id")


@query(f"""with g as ({_GRAMS}), n as (select doc_id, count(*) n, md5(string_agg(md5(gram), '' order by gram)) k from g group by doc_id),
  r as (select min(doc_id) doc_id, any_value(n) n from n group by k), h as (select g.* from g join r using (doc_id)),
  p as (select a.doc_id src, b.doc_id dst, count(*) c from h a join h b on a.gram = b.gram and a.doc_id > b.doc_id group by all)
  select src, dst, round(c / (x.n + y.n - c), 6)::double similarity from p join r x on x.doc_id = src join r y on y.doc_id = dst where 5 * c >= 4 * (x.n + y.n - c)""")
def jaccard_pairs(spark, sf_dir):
    found = minhash.similar_pairs(Workspace(spark, "jaccard").keep(minhash.signed(docs(spark, sf_dir), threshold=CANDIDATES), "signed"))
    return found.select(F.col("b").alias("src"), F.col("a").alias("dst"), F.round("similarity", 6).alias("similarity"))


# ---- decontamination

_HITS = "select doc_id, min(item_id) item from documents d join benchmark b on contains(lower(d.text), lower(b.text)) where b.text <> '' group by doc_id"


@query(_HITS)
def decontam_substring(spark, sf_dir):
    return decontamination.substring_hits(wide(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query(f"select lang, 'benchmark_match' reason, count(*) n from documents join ({_HITS}) using (doc_id) group by lang")
def decontam_reason_counts(spark, sf_dir):
    _, gone = decontamination.decontaminate(wide(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return gone.groupBy("lang", "reason").agg(F.count("*").alias("n"))


@query(f"""with t as (select doc_id, list_distinct(list_filter({_PIECES}, lambda x: x <> '')) t from documents), b as (select item_id, list_distinct(list_filter({_PIECES}, lambda x: x <> '')) t from benchmark)
  select doc_id, item, round(s, 6)::double similarity from (select doc_id, item_id item, len(list_intersect(t.t, b.t)) / greatest(1, len(list_distinct(list_concat(t.t, b.t)))) s from t, b) where s >= 0.5""")
def decontam_jaccard(spark, sf_dir):
    found = decontamination.jaccard_matches(wide(spark, sf_dir), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item", F.round("similarity", 6).alias("similarity"))


@query(_HITS.replace("group by doc_id", "group by doc_id having min(item_id) >= 0"))
def decontam_incremental(spark, sf_dir):
    needles, work = table(spark, sf_dir, "benchmark"), Workspace(spark, "incremental")
    before = needles.where("item_id < 20")
    earlier = work.keep(decontamination.substring_hits(docs(spark, sf_dir), before), "earlier")
    return decontamination.incremental_hits(docs(spark, sf_dir), needles, before.select("item_id"), earlier)


# ---- personal data

_SIMPLE_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
_TOKEN = r'token = "([0-9a-f]{40})"'


@query(f"select doc_id, unnest(regexp_extract_all(text, '{_SIMPLE_EMAIL}')) email from documents")
def pii_email_simple(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_SIMPLE_EMAIL), F.lit(0))).alias("email"))


@query(f"select lang, count(*) filter (n > 0) n_docs, sum(n)::bigint n_secrets from (select lang, len(regexp_extract_all(text, '{_SIMPLE_EMAIL}')) n from documents) group by lang")
def pii_counts(spark, sf_dir):
    n = F.size(F.regexp_extract_all("text", F.lit(_SIMPLE_EMAIL), F.lit(0)))
    return wide(spark, sf_dir).groupBy("lang").agg(F.count_if(n > 0).alias("n_docs"), F.sum(n).alias("n_secrets"))


@query(f"select doc_id, unnest(regexp_extract_all(text, '{_TOKEN}', 1)) secret from documents")
def pii_key_assignment(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(1))).alias("secret"))


@query()
def pii_full(spark, sf_dir):
    found = wide(spark, sf_dir).select("doc_id", F.explode(pii.detect("text")).alias("s"))
    return found.select("doc_id", "s.tag", "s.value", "s.start", "s.end")


@query()
def pii_redact(spark, sf_dir):
    return pii.scan_and_redact(wide(spark, sf_dir)).select("doc_id", "new_text", "number_secrets", "modified")


def _first_span(d: DataFrame, pattern: str) -> DataFrame:
    value = F.regexp_extract("text", pattern, 0)
    return d.withColumn("v", value).where("v <> ''").select("doc_id", F.lit("EMAIL").alias("tag"), F.instr("text", "v").alias("start"), (F.instr("text", "v") + F.length("v")).alias("end"))


_SPAN = "select doc_id, position(v in text) s, position(v in text) + length(v) e from (select doc_id, text, regexp_extract(text, '{}', 0) v from documents) where v <> ''"


@query(f"""with a as ({_SPAN.format(_SIMPLE_EMAIL)}), b as ({_SPAN.format('[a-z0-9.]+@[a-z0-9.]+')}),
  m as (select doc_id, max(case when least(a.e, b.e) - greatest(a.s, b.s) > 0.8 * (a.e - a.s) and least(a.e, b.e) - greatest(a.s, b.s) > 0.8 * (b.e - b.s) then 1 else 0 end) tp,
    max(case when a.s is null then 0 else 1 end) na, max(case when b.s is null then 0 else 1 end) nb from a full join b using (doc_id) group by doc_id)
  select 'EMAIL' tag, sum(tp)::bigint tp, sum(nb - tp)::bigint fn, sum(na - tp)::bigint fp, round(sum(tp) / greatest(sum(na), 1), 6)::double "precision", round(sum(tp) / greatest(sum(nb), 1), 6)::double recall from m""")
def pii_span_eval(spark, sf_dir):
    d = docs(spark, sf_dir)
    return pii.span_metrics(pii.matched_spans(_first_span(d, _SIMPLE_EMAIL), _first_span(d, "[a-z0-9.]+@[a-z0-9.]+")))


# ---- graphs: the customers of all orders, in fifty families, stand for files tied by imports

_DEPS = """select * from (select distinct o_custkey src, 50 * ((o_custkey // 50) // (2 + o_orderkey % 3)) + o_custkey % 50 dst from orders) where src > dst"""


def _deps(spark, sf_dir) -> DataFrame:
    dst = F.expr("50 * ((o_custkey div 50) div (2 + o_orderkey % 3)) + o_custkey % 50")
    return table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("src"), dst.alias("dst")).where("src > dst").distinct()


@query(f"select node, sum(o)::bigint n_out, sum(i)::bigint n_in from (select src node, 1 o, 0 i from ({_DEPS}) union all select dst, 0, 1 from ({_DEPS})) group by node")
def dep_edges(spark, sf_dir):
    return graph.degrees(_deps(spark, sf_dir))


@query(f"""with recursive e as ({_DEPS}), u as (select src a, dst b from e union select dst, src from e), r as (select a node, a reached from u union select r.node, u.b from r join u on r.reached = u.a)
  select node, min(reached) component from r group by node""")
def dep_components(spark, sf_dir):
    return graph.file_components(_deps(spark, sf_dir))


@query(f"""with recursive e as ({_DEPS}), r as (select distinct src node, 0 as level from e union select distinct dst, 0 from e union select e.src, r.level + 1 from r join e on e.dst = r.node)
  select node, max(level)::bigint level from r group by node""")
def dep_topo_level(spark, sf_dir):
    return graph.topological_levels(_deps(spark, sf_dir))


@query()
def dep_topo_order(spark, sf_dir):
    edges = Workspace(spark, "order").keep(_deps(spark, sf_dir), "edges")
    return graph.topological_order(edges, graph.file_components(edges))


# ---- samples

@query("""with l as (select doc_id, string_split(text, chr(10)) l from documents), k as (select *, len(l) // 2 k from l where len(l) > 15)
  select doc_id, array_to_string(list_slice(l, 1, k), chr(10)) || chr(10) "prefix", l[k + 1] middle, case when k + 1 < len(l) then chr(10) || array_to_string(list_slice(l, k + 2, len(l)), chr(10)) else '' end suffix from k""")
def fim_middle_line(spark, sf_dir):
    return fim.middle_line(docs(spark, sf_dir))


@query()
def fim_samples(spark, sf_dir):
    return fim.samples(wide(spark, sf_dir))


@query("select conv_id, string_agg(role || ':' || text, chr(10) order by turn) chat, count(*) n from conversations group by conv_id")
def chat_turns(spark, sf_dir):
    found = interactions.chat_turns(table(spark, sf_dir, "conversations"))
    joined = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "\n")
    return found.select("conv_id", joined.alias("chat"), F.size("messages").cast("long").alias("n"))


_PAIRS = """select a.conv_id, a.turn, a.text prompt, b.text answer, c.text wrong_answer from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1 and a.role = 'user' and b.role = 'assistant'
  join conversations c on c.conv_id = a.conv_id and c.turn = a.turn + 3 and c.role = 'assistant'"""


@query(f"select conv_id * 1000 + turn prompt_id, prompt, answer chosen, wrong_answer rejected from ({_PAIRS}) where answer <> wrong_answer and answer <> '' and wrong_answer <> ''")
def dpo_pairs(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")

    def turn(role: str, ahead: int, name: str) -> DataFrame:
        return c.where(F.col("role") == role).select("conv_id", (F.col("turn") - ahead).alias("turn"), F.col("text").alias(name))

    rows = turn("user", 0, "prompt").join(turn("assistant", 1, "answer"), ["conv_id", "turn"]).join(turn("assistant", 3, "wrong_answer"), ["conv_id", "turn"])
    made = interactions.preference_rows(rows.withColumn("id", F.col("conv_id") * 1000 + F.col("turn")), "id")
    return made.select("prompt_id", "prompt", F.col("chosen")[1]["content"].alias("chosen"), F.col("rejected")[1]["content"].alias("rejected"))


@query("""select a.conv_id::varchar || '-' || a.turn id, 'completion' category, a.text human, b.text assistant, length(b.text)::bigint groundtruth_length
  from conversations a join conversations b on a.conv_id = b.conv_id and b.turn = a.turn + 1 and a.role = 'user' and b.role = 'assistant'""")
def sft_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    asked = c.where("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    told = c.where("role = 'assistant'").select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("answer"))
    made = interactions.sft_rows(asked.join(told, ["conv_id", "turn"]).withColumn("id", F.concat_ws("-", "conv_id", "turn")))
    return made.select(F.col("conversation_id").alias("id"), "category", F.col("conversation")[0]["human"].alias("human"), F.col("conversation")[0]["assistant"].alias("assistant"), F.col("groundtruth_length").cast("long").alias("groundtruth_length"))


@query("""select coalesce(case when text = '' then 'empty' when regexp_full_match(text, '\\s+') then 'blank' when length(text) < 4 then 'short' when length(text) > 500 then 'long'
  when length(regexp_replace(text, '[^\\p{Han}A-Za-z0-9]', '', 'g')) < 4 then 'useless' when length(text) < 30 and regexp_matches(text, '^\\s*(print|console\\.log|echo|log)\\b') then 'print' end, 'passed') rule, count(*) n from conversations group by 1""")
def sft_funnel(spark, sf_dir):
    return interactions.funnel(table(spark, sf_dir, "conversations"), "text")


@query("""select event_id from (select event_id, user_id, count(*) over (partition by user_id) c from events)
  where ('0x' || substr(md5(event_id::varchar || 'user_id'), 1, 8))::bigint / 4294967296.0 < least(1.0, 3.0 / c)""")
def sft_downsample(spark, sf_dir):
    return interactions.downsample(table(spark, sf_dir, "events"), "user_id", 3, "event_id").select("event_id")


_THRESHOLDS = [round(0.05 * i, 2) for i in range(20)]


@query(f"""with s as (select least(1.0, n_chars / 5000.0)::double score, quality truth from documents join labels using (doc_id)), t as (select unnest({_THRESHOLDS})::double threshold),
  c as (select threshold, count(*) filter (score > threshold and truth = 1) tp, count(*) filter (score > threshold and truth <> 1) fp, count(*) filter (score <= threshold and truth = 1) fn, count(*) filter (score <= threshold and truth <> 1) tn from s, t group by threshold)
  select *, round(tp / greatest(tp + fp, 1), 6)::double new_accept, round(tp / greatest(fn + tp, 1), 6)::double kept_pos, round(fn / greatest(fn + tp, 1), 6)::double del_pos, round(tn / greatest(tn + fp, 1), 6)::double del_neg from c""")
def threshold_sweep(spark, sf_dir):
    scored = docs(spark, sf_dir).select("doc_id", F.least(F.lit(1.0), F.col("n_chars") / 5000.0).alias("score")).join(table(spark, sf_dir, "labels"), "doc_id")
    return interactions.threshold_sweep(scored, _THRESHOLDS, truth="quality")


# ---- discussions

@query("""with i as (select conv_id, sum(length(text)) s, count(distinct role) u, count(*) n from conversations group by conv_id)
  select conv_id, s::bigint text_size, u user_count, n event_count from i where s >= 200 and (u >= 2 or (s <= 7000 and n <= 10))""")
def issue_user_filter(spark, sf_dir):
    found = discussions.by_users_and_size(discussions.issue_stats(discussions.issues(table(spark, sf_dir, "conversations"))))
    return found.select("conv_id", "text_size", "user_count", "event_count")


@query()
def bot_filter(spark, sf_dir):
    events = table(spark, sf_dir, "conversations").withColumn("role", F.when(F.col("role") == "system", "build-bot").otherwise(F.col("role")))
    return discussions.remove_bots(discussions.issues(events)).select("conv_id", F.size("events").alias("n_events"))


@query("""with f as (select conv_id, role, min(turn) t from conversations group by all), n as (select conv_id, role, 'username_' || (row_number() over (partition by conv_id order by t) - 1) u from f)
  select conv_id, string_agg(u, ',' order by turn) authors from conversations join n using (conv_id, role) group by conv_id""")
def username_mask(spark, sf_dir):
    found = discussions.masked_users(discussions.issues(table(spark, sf_dir, "conversations")))
    return found.select("conv_id", F.array_join(F.transform("events", lambda e: e["author"]), ",").alias("authors"))


@query("""select doc_id, case when len(l) > 80 then array_to_string(list_slice(l, 1, 60), chr(10)) || chr(10) || '[Truncated]' || chr(10) || array_to_string(list_slice(l, len(l) - 19, len(l)), chr(10)) else text end text
  from (select doc_id, text, string_split(text, chr(10)) l from documents)""")
def truncate_long(spark, sf_dir):
    return docs(spark, sf_dir).select("doc_id", discussions.truncated("text").alias("text"))


@query(f"""select doc_id from documents order by ln(greatest({_U.format('sample')}, 1e-12)) / greatest(n_chars, 20) desc, doc_id limit 200""")
def weighted_sample(spark, sf_dir):
    d = docs(spark, sf_dir)
    return interactions.weighted_sample(d, 200, F.greatest("n_chars", F.lit(20)), "doc_id").select("doc_id")


@query("""select event_type, count(*) n, sum((props->>'k')::bigint)::bigint k_sum from events group by event_type""")
def json_extract_props(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(k).alias("k_sum"))




@query("select doc_id, round(length(text) / len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_\\s]')), 4)::double chars_per_token from documents")
def fertility(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", r4(sequences.chars_per_token("text")).alias("chars_per_token"))


@query(f"select p_partkey, lower(replace(p_name, ' ', '-')) name from part")
def language_names(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", T.language_name("p_name").alias("name"))


@query("""select n_imports, count(*) n_files from (select o_custkey, count(distinct o_orderstatus) n_imports from orders group by o_custkey) group by n_imports""")
def import_distribution(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.lit("r").alias("repo"), F.col("o_custkey").alias("path"), F.col("o_orderstatus").alias("name"))
    return evaluation.import_counts(rows)


@query("""select user_id, event_type, count(*) filter (lower(event_type) in ('click', 'error')) n_in, count(*) filter (lower(event_type) not in ('click', 'error')) n_out from events group by all""")
def in_repository_counts(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("department"), F.col("user_id").alias("user"), F.concat(F.lit("src/"), "event_type").alias("filename"))
    found = evaluation.in_repository(rows, spark.createDataFrame([("click",), ("error",)], "name string"))
    return found.select(F.col("user").alias("user_id"), F.col("department").alias("event_type"), "n_in", "n_out")


@query()
def repeated_runs(spark, sf_dir):
    return wide(spark, sf_dir).select("doc_id", sequences.repeats("text").alias("r")).select("doc_id", F.col("r.part").alias("part"), F.col("r.n").alias("n"))


@query("""select p_partkey, coalesce(case when length(b) < length(s) then b end, '') name, regexp_matches(s, '^(TestCase_|TESTCASE_|testcase_|test)(_|)') or regexp_matches(s, '(_|)[0-9]+$') test
  from (select p_partkey, s, regexp_replace(regexp_replace(s, '(_|)[0-9]+$', ''), '^(TestCase_|TESTCASE_|testcase_|test)(_|)', '') b from (select p_partkey,
    (case p_partkey % 3 when 0 then 'test_' when 1 then 'TestCase_' else '' end) || replace(p_name, ' ', '_') || (case p_partkey % 2 when 0 then '_' || p_partkey else '' end) s from part))""")
def tested_names(spark, sf_dir):
    k = F.col("p_partkey")
    s = F.concat(F.when(k % 3 == 0, "test_").when(k % 3 == 1, "TestCase_").otherwise(""), F.regexp_replace("p_name", " ", "_"), F.when(k % 2 == 0, F.concat(F.lit("_"), k.cast("string"))).otherwise(""))
    return table(spark, sf_dir, "part").select("p_partkey", F.coalesce(filters.tested_name(s), F.lit("")).alias("name"), filters.test_function(s).alias("test"))


# ---- row-level steps

_BEST = """with t as (select doc_id, list_distinct(list_filter({p}, lambda x: x <> '')) t from documents), b as (select item_id, list_distinct(list_filter({p}, lambda x: x <> '')) t from benchmark),
  m as (select doc_id, len(list_intersect(t.t, b.t)) / greatest(1, len(list_distinct(list_concat(t.t, b.t)))) s from t, b) select count(*) n, round(min(s), 6)::double least, round(max(s), 6)::double most, round(avg(s), 6)::double mean
  from (select doc_id, max(s) s from m where s >= 0.5 group by doc_id)""".format(p=_PIECES)


@query(_BEST)
def decontam_best_similarity(spark, sf_dir):
    found = rows.best_similarity(decontamination.jaccard_matches(wide(spark, sf_dir), table(spark, sf_dir, "benchmark")))
    return found.select("n", *(F.round(c, 6).alias(c) for c in ("least", "most", "mean")))


@query()
def decontam_lsh(spark, sf_dir):
    return decontamination.lsh_matches(docs(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query()
def char_run_counts(spark, sf_dir):
    return rows.run_counts(wide(spark, sf_dir))


@query("select role label, count(distinct conv_id) n_rows, count(*) n from conversations group by role")
def label_counts(spark, sf_dir):
    by = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.collect_list("role").alias("roles"))
    return rows.label_counts(by, F.col("roles"))


@query("select o_orderpriority as extension, count(*) n from orders where o_orderkey % 3 > 0 group by 1")
def unknown_extensions(spark, sf_dir):
    known = F.when(F.col("o_orderkey") % 3 > 0, F.concat(F.lit("- ('lang', '"), "o_orderpriority", F.lit("'):0.1 not in ext_to_filter"))).otherwise("read 10 files")
    return rows.unknown_extensions(table(spark, sf_dir, "orders").select(known.alias("value")))


@query("select conv_id * 1000 + turn id, role, case when role = 'user' then '> ' || text else text end text from conversations")
def refreshed_rows(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")
    return rows.refreshed(c, c.where("role = 'user'").select("id", F.concat(F.lit("> "), "text").alias("text")), "id", "text")


@query("select (select count(distinct doc_id) from documents) n_left, (select count(distinct doc_id) from labels) n_right, (select count(*) from (select doc_id from documents intersect select doc_id from labels)) n_both")
def shared_ids(spark, sf_dir):
    return rows.shared_ids(docs(spark, sf_dir), table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@query("select doc_id from documents where (source, lang) in (select (source, lang) from documents group by source, lang having count(*) > 3)")
def allowed_languages(spark, sf_dir):
    d = docs(spark, sf_dir).withColumn("repo", F.col("source"))
    allowed = d.groupBy("repo", "lang").agg(F.count("*").alias("n")).where("n > 3")
    return rows.only_languages(d, allowed).select("doc_id")


@query("""with f as (select s_nationkey % 3 lang, 'd' || s_suppkey % 40 folder, s_suppkey, 'd' || (s_suppkey * 3) % 40 name from supplier)
  select a.s_suppkey src, b.s_suppkey dst from f a join f b on a.lang = b.lang and a.name = b.folder and a.s_suppkey <> b.s_suppkey""")
def folder_imports(spark, sf_dir):
    k = F.col("s_suppkey")
    files = table(spark, sf_dir, "supplier").select(F.lit("r").alias("repo"), (F.col("s_nationkey") % 3).alias("lang"), F.concat(F.lit("src/d"), (k % 40).cast("string"), F.lit("/"), k.cast("string")).alias("path"), F.concat(F.lit("d"), (k * 3 % 40).cast("string")).alias("name"))
    found = rows.folder_imports(files, files)
    return found.select(*(F.element_at(F.split(c, "/"), -1).cast("long").alias(c) for c in ("src", "dst")))


@query("select user_id, string_agg(m, ',' order by m) types from (select distinct user_id, unnest([event_type, upper(event_type)]) m from events) group by user_id")
def merged_lists(spark, sf_dir):
    listed = table(spark, sf_dir, "events").select("user_id", F.array("event_type", F.upper("event_type")).alias("types"))
    return rows.merged_lists(listed, ["user_id"], "types").select("user_id", F.array_join("types", ",").alias("types"))


_USEFUL = "length(regexp_replace({}, '[^\\p{{Han}}a-zA-Z0-9_;,\\[\\]\\(\\)\\{{\\}}]', '', 'g'))"
_TOKENS = "len(regexp_extract_all({}, '[\\p{{Han}}a-zA-Z0-9]+'))"


@query(f"""select conv_id, turn from (select conv_id, turn, substr(text, 1, 60) p, substr(text, 20) s, turn % 2 = 0 web from conversations)
  where least({_USEFUL.format('p')}, {_USEFUL.format('s')}) >= (case when web then 100 else 20 end) and least({_TOKENS.format('p')}, {_TOKENS.format('s')}) >= (case when web then 10 else 3 end)""")
def rich_contexts(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    kind = F.when(F.col("turn") % 2 == 0, "ts").otherwise("py")
    return c.where(rows.rich_context(F.substring("text", 1, 60), F.expr("substring(text, 20)"), kind)).select("conv_id", "turn")


@query("select p_partkey, array_to_string(list_filter(regexp_split_to_array('( ' || replace(p_name, ' ', ', ') || ' )', '[,\n\t ]+'), lambda w: w not in ('', '(', ')')), '|') names from part")
def split_names(spark, sf_dir):
    span = F.concat(F.lit("( "), F.regexp_replace("p_name", " ", ", "), F.lit(" )"))
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(rows.split_names(span), "|").alias("names"))


@query("select p_partkey, p_brand || chr(10) || p_type stack_content from part")
def training_records(spark, sf_dir):
    return rows.training_record(table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_type"), ["p_brand", "p_type"])

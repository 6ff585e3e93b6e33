"""Personal data and secrets: spans, redaction, evaluation.

Spans are array<struct<tag, value, start, end>> in character places. Detection needs
look-around, address checks and entropy, hence pandas UDFs; redaction and evaluation are
built-in expressions.
"""

from __future__ import annotations

import ipaddress
import math
from collections import Counter

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

SPANS = "array<struct<tag:string,value:string,start:int,end:int>>"

#: Patterns of addresses, dates that look like addresses, and provider keys.
EMAIL = r"(?<![\w.+@%-])([\w.+%-]+@[\w-]+(?:\.[\w-]+)*\.[A-Za-z]{2,})(?![\w@-])"
IPV4 = r"(?<![\d.])((?:\d{1,3}\.){3}\d{1,3})(?![\d.])"
IPV6 = r"(?<![0-9A-Fa-f:.])((?:[0-9A-Fa-f]{1,4}:){2,7}[0-9A-Fa-f]{1,4}|(?:[0-9A-Fa-f]{1,4}:){1,7}:|(?:[0-9A-Fa-f]{1,4}:){1,6}:[0-9A-Fa-f]{1,4}|::[0-9A-Fa-f]{1,4})(?![0-9A-Fa-f:.])"
DATES = (
    r"(?:^|[\b\s@?,!;:\'\")(.\p{Han}])([1-2][0-9]{3}[\p{Pd}/][1-2][0-9]{3})(?:$|[\s@,?!;:\'\"(.\p{Han}])",
    r"(?:^|[\b\s@?,!;:\'\")(.\p{Han}])([1-2][0-9]{3}[\p{Pd}/.][0-3][0-9][\p{Pd}/.][0-3][0-9])(?:$|[\s@,?!;:\'\"(.\p{Han}])",
    r"(?:^|[\b\s@?,!;:\'\")(.\p{Han}])([0-3][0-9][\p{Pd}/.][0-3][0-9][\p{Pd}/.](?:[0-9]{2}|[1-2][0-9]{3}))(?:$|[\s@,?!;:\'\"(.\p{Han}])",
    r"(?:^|[\b\s@?,!;:\'\")(.\p{Han}])([0-3][0-9][\p{Pd}/](?:[0-9]{2}|[1-2][0-9]{3}))(?:$|[\s@,?!;:\'\"(.\p{Han}])",
    r"(?:^|[\b\s@?,!;:\'\")(.\p{Han}])([1-2][0-9]{3}-[0-3][0-9])(?:$|[\s@,?!;:\'\"(.\p{Han}])",
)
PROVIDER_KEYS = (
    r"\b((?:AKIA|ASIA)[0-9A-Z]{16})\b",
    r"\b(gh[pousr]_[A-Za-z0-9]{36,})\b",
    r"\b(xox[abpors]-[A-Za-z0-9-]{10,})\b",
    r"\b(sk-[A-Za-z0-9]{20,})\b",
    r"\b(eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,})\b",
    r"\b(AIza[0-9A-Za-z_-]{35})\b",
    r"(-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----)",
)
ASSIGNED = r"(?i)(?:key|token|secret|passw(?:or)?d|pwd|auth|credential)[\w.\[\]\"' -]{0,20}[:=]\s*[\"']([A-Za-z0-9+/=_-]{8,200})[\"']"
HASH_WORDS = ("sha", "md5", "hash", "byte")
#: Public name servers, which are no personal data.
NAME_SERVERS = (
    "8.8.8.8", "8.8.4.4", "1.1.1.1", "1.0.0.1", "76.76.19.19", "76.223.122.150", "9.9.9.9", "149.112.112.112",
    "208.67.222.222", "208.67.220.220", "8.26.56.26", "8.20.247.20", "94.140.14.14", "94.140.15.15",
)

_EMAIL, _IPS, _DATES = regex.compile(EMAIL), (regex.compile(IPV4), regex.compile(IPV6)), tuple(regex.compile(p) for p in DATES)
_KEYS, _ASSIGNED = tuple(regex.compile(p) for p in PROVIDER_KEYS), regex.compile(ASSIGNED)


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) if n else 0.0


def looks_random(value: str) -> bool:
    """Whether a value reads like a generated key: enough entropy for its alphabet, no plain word."""
    if regex.fullmatch(r"[0-9a-fA-F]+", value):
        return len(value) >= 16 and entropy(value) > 3.0
    mixed = sum(bool(regex.search(p, value)) for p in ("[a-z]", "[A-Z]", "[0-9]"))
    return len(value) >= 8 and entropy(value) > 3.2 and mixed >= 2


def ip_spans(text: str) -> list[tuple[str, str, int, int]]:
    """Valid addresses that are no date, and no version unless a server is mentioned nearby."""
    out = []
    for pattern in _IPS:
        for m in pattern.finditer(text):
            value, start, end = m.group(1), m.start(1), m.end(1)
            try:
                ipaddress.ip_address(value)
            except ValueError:
                continue
            if not any(c.isdigit() for c in value) or any(d.match(value) for d in _DATES):
                continue
            if value.count(".") == 3 and len(value) == 7:
                around = text[max(0, start - 100) : end + 100].lower()
                if "dns" not in around and "server" not in around:
                    continue
            out.append(("IP_ADDRESS", value, start, end))
    return out


def key_spans(text: str) -> list[tuple[str, str, int, int]]:
    """Provider keys and random-looking values assigned to secret names.

    Values of a hash's length whose line speaks of hashes before them are none, nor is
    anything in a text that mentions sha or hash in more than two of a hundred lines.
    """
    found = {}
    for pattern in (*_KEYS, _ASSIGNED):
        for m in pattern.finditer(text):
            value = m.group(1)
            if pattern is _ASSIGNED and not looks_random(value):
                continue
            line = text[text.rfind("\n", 0, m.start(1)) + 1 : m.start(1)].lower()
            if len(value) in (32, 40, 64) and any(w in line for w in HASH_WORDS):
                continue
            found.setdefault(value, None)
    if found:
        low, most = text.lower(), int(0.02 * text.count("\n"))
        if low.count("sha") > most or low.count("hash") > most:
            return []
    return [("KEY", v, m.start(), m.end()) for v in found for m in regex.finditer(regex.escape(v), text)]


def all_spans(text: str) -> list[tuple[str, str, int, int]]:
    """All spans by place; of overlapping ones the first, then the longest."""
    spans = [("EMAIL", m.group(1), m.start(1), m.end(1)) for m in _EMAIL.finditer(text)] + ip_spans(text) + key_spans(text)
    out, end = [], -1
    for s in sorted(set(spans), key=lambda s: (s[2], -s[3])):
        if s[2] >= end:
            out.append(s)
            end = s[3]
    return out


def detect(text: Column | str) -> Column:
    """Spans of e-mail addresses, IP addresses and keys; none for null."""

    @F.pandas_udf(SPANS)
    def spans(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(("tag", "value", "start", "end"), s)) for s in all_spans(t)] if t else [] for t in texts], dtype=object)

    return spans(T.col(text))


#: Private addresses that take the place of public ones.
IPV4_POOL = ("172.16.31.10", "172.16.58.3", "172.16.17.32", "192.168.127.12", "192.168.3.11")
IPV6_POOL = ("fd00:c2b6:b24b:be67:2827:688d:e6a1:6a3b", "fd00:a516:7c1b:17cd:6d81:2137:bd2a:2c5b", "fc00:e968:6179::de52:7100", "fc00:db20:35b:7399::5", "fdf8:f53e:61e4::18")
#: Invented stand-ins for the other kinds, made by rule: ten each.
EMAIL_POOL = tuple(f"user{i:02d}@example.com" for i in range(10))
KEY_POOL = tuple(f"{i:02d}".rjust(32, "k") for i in range(10))


def replacement(tag: Column, value: Column, seed: int = 0) -> Column:
    """One of the tag's pool, by a hash of the value: the same everywhere and in every run."""
    def one_of(pool: tuple[str, ...]) -> Column:
        return F.element_at(F.array(*map(F.lit, pool)), (F.pmod(F.xxhash64(value, F.lit(seed)), F.lit(len(pool))) + 1).cast("int"))

    ip = F.when(F.contains(value, F.lit(":")), one_of(IPV6_POOL)).otherwise(one_of(IPV4_POOL))
    return F.when(tag == "EMAIL", one_of(EMAIL_POOL)).when(tag == "KEY", one_of(KEY_POOL)).when(tag == "IP_ADDRESS", ip).otherwise(F.lit("<REDACTED>"))


def public_ip(span: Column) -> Column:
    """False for private addresses and known name servers."""
    private = F.rlike(span["value"], F.lit(r"^(10\.|127\.|169\.254\.|192\.168\.|172\.(1[6-9]|2\d|3[01])\.|0\.|::1$|f[cd]|fe80)"))
    return (span["tag"] != "IP_ADDRESS") | ~(private | span["value"].isin(*sorted(NAME_SERVERS)))


def redact(text: Column | str, spans: Column | str, seed: int = 0) -> Column:
    """The text with each span replaced; where two spans touch, one space parts them.

    Private addresses and name servers stay. Spans must not overlap.
    """
    t, start = T.col(text), F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    ordered = F.array_sort(F.filter(T.col(spans), public_ip), lambda a, b: a["start"] - b["start"])

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(t, acc["at"] + 1, s["start"] - acc["at"])
        between = F.when(between == "", F.lit(" ")).otherwise(between)
        return F.struct(F.concat(acc["out"], between, replacement(s["tag"], s["value"], seed)).alias("out"), s["end"].alias("at"))

    return F.aggregate(ordered, start, step, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))


def scan_and_redact(docs: DataFrame, text_col: str = "text", seed: int = 0) -> DataFrame:
    """docs with secrets (JSON), has_secrets, number_secrets, new_text and modified."""
    found = docs.withColumn("_spans", detect(text_col))
    redacted = found.withColumn("new_text", redact(F.coalesce(text_col, F.lit("")), "_spans", seed))
    return redacted.withColumns(
        {
            "secrets": F.to_json("_spans"),
            "has_secrets": F.size("_spans") > 0,
            "number_secrets": F.size("_spans").cast("long"),
            "modified": F.exists("_spans", public_ip),
        }
    ).drop("_spans")


def matched_spans(found: DataFrame, truth: DataFrame, id_col: str = "doc_id", least: float = 0.8) -> DataFrame:
    """id, tag, tp, fn, fp: spans of both sides that overlap by more than `least` of each.

    found and truth have id, tag, start, end. The interval join is an equi-join on id and
    tag first, so only spans of one document meet.
    """
    a = found.select(id_col, "tag", F.col("start").alias("fs"), F.col("end").alias("fe")).distinct()
    b = truth.select(id_col, "tag", F.col("start").alias("ts"), F.col("end").alias("te")).distinct()
    shared = F.least("fe", "te") - F.greatest("fs", "ts")
    met = a.join(b, [id_col, "tag"]).where((F.col("fs") < F.col("te")) & (F.col("ts") < F.col("fe")))
    met = met.where((shared > least * (F.col("fe") - F.col("fs"))) & (shared > least * (F.col("te") - F.col("ts"))))
    hits = met.groupBy(id_col, "tag").agg(F.countDistinct("ts", "te").alias("tp"))
    counts_a, counts_b = a.groupBy(id_col, "tag").agg(F.count("*").alias("na")), b.groupBy(id_col, "tag").agg(F.count("*").alias("nb"))
    both = counts_a.join(counts_b, [id_col, "tag"], "full").join(hits, [id_col, "tag"], "left").na.fill(0, ["na", "nb", "tp"])
    return both.select(id_col, "tag", "tp", (F.col("nb") - F.col("tp")).alias("fn"), (F.col("na") - F.col("tp")).alias("fp"))


def span_metrics(matched: DataFrame) -> DataFrame:
    """tag, tp, fn, fp, precision, recall; 1.0 where nothing was to be found or was found."""
    sums = matched.groupBy("tag").agg(*(F.sum(c).cast("long").alias(c) for c in ("tp", "fn", "fp")))

    def share(other: str) -> Column:
        n = F.col("tp") + F.col(other)
        return F.when(n == 0, F.lit(1.0)).otherwise(F.round(F.col("tp") / F.greatest(n, F.lit(1)), 6))

    return sums.withColumn("precision", share("fp")).withColumn("recall", share("fn"))

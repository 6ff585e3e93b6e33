"""Issues and commits: bots, users, replies, lengths, change ranges."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T

#: Keywords, endings and names of authors that are machines.
BOT_KEYWORDS = ("[bot]", "botmanager", "bors-", "jenkins", "k8s-", "-test-", "travis")
BOT_SUFFIXES = ("-automaton", "-automation", "-benchmark", "-build", "-deployer", "-cloud", "bot", "-ci", "-linter", "-teamcity", "-test", "-testing", "-Service-Account")
BOT_NAMES = (
    "Apache-HBase", "AutorestCI", "CLAassistant", "cmsbuild", "codecov-io", "codecov-commenter", "coveralls", "danger-public",
    "dnfclas", "msftclas", "PyDocTeur", "SparkQA", "karma-pr-reporter", "danger-public", "claassistantio", "probot-stale",
)
LEAST_SIZE, MOST_SIZE, MOST_EVENTS = 200, 7000, 10
MOST_LINES, FIRST_LINES, LAST_LINES = 80, 60, 20
TRUNCATED = "\n[Truncated]\n"


def is_bot(author: Column) -> Column:
    """Keywords and endings whatever the case, names as written."""
    a = F.lower(author)
    out = author.isin(*BOT_NAMES)
    for k in BOT_KEYWORDS:
        out = out | F.contains(a, F.lit(k))
    for s in BOT_SUFFIXES:
        out = out | F.endswith(a, F.lit(s.lower()))
    return F.coalesce(out, F.lit(False))


def merged_text(comment: Column, description: Column) -> Column:
    """The comment, or the description where it is missing or empty."""
    return F.coalesce(F.when(comment != "", comment), description, F.lit(""))


def truncated(text: Column | str) -> Column:
    """Texts of more than MOST_LINES lines keep their first and last ones."""
    t = T.col(text)
    cut = F.concat(F.array_join(F.slice(T.lines(t), 1, FIRST_LINES), "\n"), F.lit(TRUNCATED), F.array_join(F.slice(T.lines(t), -LAST_LINES, LAST_LINES), "\n"))
    return F.when(T.n_lines(t) > MOST_LINES, cut).otherwise(t)


#: Mails around or below a comment, the marks of their lines, and page breaks.
MAILS = (
    "(.*)From:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    "(.*)On.+notifications@github.com.+wrote:.+Reply to this email directly.+view it on GitHub(.*)\n?(.*)",
    "(.*)Signed-off-by: .+<.+>(.*?)\n?(.*)",
)
MAIL_DATE = r"\d+/\d+/\d+ \d{2}:\d{2} [AP]M.+wrote"
PAGE_BREAK = "_{20,}"
MAIL_SENDER, REPLY_LINE = "notifications@github.com", "Reply to this email directly"
_ENDS = r"^[\s\x1c-\x1f\x85\p{Z}]+|[\s\x1c-\x1f\x85\p{Z}]+$"


def without_reply(text: Column | str) -> Column:
    """A comment sent by e-mail without the mail it answers, and without page breaks.

    The first frame that the whole text has leaves what stands before it and, for a
    signature, after it (what follows a mail counts to the mail). Without a frame, the lines
    before the last line of a sender or date stay, and those after the last quoted line or
    reply notice (and the line after a notice that ends in a colon). Null is empty.
    """
    t = F.regexp_replace(F.coalesce(T.col(text), F.lit("")), _ENDS, "")
    rows = F.transform(T.lines(t), lambda line, i: F.struct(F.regexp_replace(line, _ENDS, "").alias("line"), i.alias("i")))

    def last(wanted) -> Column:
        return F.coalesce(F.array_max(F.transform(F.filter(rows, lambda r: wanted(r["line"])), lambda r: r["i"])), F.lit(-1))

    def quoted(line: Column) -> Column:
        return F.startswith(line, F.lit(">"))

    def noticed(line: Column) -> Column:
        return F.contains(line, F.lit(REPLY_LINE)) & ~quoted(line)

    start = F.greatest(F.lit(0), last(lambda line: F.contains(line, F.lit(MAIL_SENDER)) | F.rlike(line, F.lit(MAIL_DATE))))
    end = last(lambda line: quoted(line) | noticed(line))
    colon = noticed(F.element_at(rows, F.greatest(end + 1, F.lit(1)))["line"]) & F.endswith(F.element_at(rows, F.greatest(end + 1, F.lit(1)))["line"], F.lit(":")) & (end >= 0)
    after = end + F.when(colon, 2).otherwise(1)
    lines = T.lines(t)
    rest = F.greatest(F.size(lines) - after, F.lit(0))
    out = F.array_join(F.concat(F.slice(lines, F.lit(1), start), F.slice(lines, after + 1, rest)), "\n")
    for pattern in reversed(MAILS):
        framed = "(?s)^" + pattern
        out = F.when(F.rlike(t, F.lit(framed)), F.concat(F.regexp_extract(t, framed, 1), F.regexp_extract(t, framed, 3))).otherwise(out)
    return F.regexp_replace(F.regexp_replace(out, PAGE_BREAK, ""), _ENDS, "")


def issues(events: DataFrame, id_col: str = "conv_id", order_col: str = "turn", author_col: str = "role", text_col: str = "text") -> DataFrame:
    """id and its events (array<struct<author, text>>) in order. An issue's events are few."""
    by = events.groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(author_col).alias("author"), F.col(text_col).alias("text")))).alias("_e"))
    return by.select(id_col, F.transform("_e", lambda e: F.struct(e["author"].alias("author"), e["text"].alias("text"))).alias("events"))


def issue_stats(found: DataFrame) -> DataFrame:
    """found with text_size, user_count and event_count."""
    size = F.aggregate("events", F.lit(0), lambda n, e: n + F.coalesce(F.length(e["text"]), F.lit(0)))
    users = F.size(F.array_distinct(F.transform("events", lambda e: e["author"])))
    return found.withColumns({"text_size": size.cast("long"), "user_count": users.cast("long"), "event_count": F.size("events").cast("long")})


def remove_bots(found: DataFrame) -> DataFrame:
    """Issues without the events of bots and the calls that woke them; issues left empty go.

    The event before a bot's goes too if it names the bot or starts with a slash, unless
    that bot event is the first one removed.
    """
    start = F.struct(F.array().cast("array<struct<author:string,text:string>>").alias("kept"), F.lit(0).alias("i"), F.lit(0).alias("last"))

    def step(s: Column, e: Column) -> Column:
        before = F.try_element_at(s["kept"], F.lit(-1))
        named = F.contains(before["text"], e["author"]) | F.startswith(before["text"], F.lit("/"))
        call = F.coalesce((s["last"] > 0) & (s["last"] < s["i"] - 1) & named, F.lit(False))
        kept = F.when(~is_bot(e["author"]), F.concat(s["kept"], F.array(e))).when(call, F.slice(s["kept"], F.lit(1), F.size(s["kept"]) - 1)).otherwise(s["kept"])
        return F.struct(kept.alias("kept"), (s["i"] + 1).alias("i"), F.when(is_bot(e["author"]), s["i"]).otherwise(s["last"]).alias("last"))

    cleaned = found.withColumn("events", F.aggregate("events", start, step, lambda s: s["kept"]))
    return cleaned.where(F.size("events") > 0)


def by_users_and_size(found: DataFrame) -> DataFrame:
    """Issues large enough, with two users or else neither long nor with many events."""
    alone = (F.col("text_size") <= MOST_SIZE) & (F.col("event_count") <= MOST_EVENTS)
    return found.where((F.col("text_size") >= LEAST_SIZE) & ((F.col("user_count") >= 2) | alone))


def masked_users(found: DataFrame) -> DataFrame:
    """Authors named username_0, username_1, ... by first appearance, in events and, replaced in that order, in texts."""
    authors = F.array_distinct(F.transform("events", lambda e: e["author"]))
    numbered = F.transform(F.filter(authors, lambda a: a.isNotNull() & (a != "")), lambda a, i: F.struct(a.alias("a"), F.concat(F.lit("username_"), i.cast("string")).alias("to")))

    def mask(text: Column, names: Column) -> Column:
        return F.aggregate(names, text, lambda t, n: F.replace(t, n["a"], n["to"]))

    def named(author: Column, names: Column) -> Column:
        return F.coalesce(F.try_element_at(F.filter(names, lambda n: n["a"] == author), F.lit(1))["to"], author)

    return found.withColumn("_n", numbered).withColumn(
        "events", F.transform("events", lambda e: F.struct(named(e["author"], F.col("_n")).alias("author"), mask(e["text"], F.col("_n")).alias("text")))
    ).drop("_n")


#: Parts of subjects and whole subjects that say nothing; bounds and sampling shares.
BAD_PARTS = ("auto commit", "update contributing", "<?xml")
BAD_SUBJECTS = (
    "readme", "update", "dummy", "updated", "debug", "test", "update readme", "update readme.md", "updated readme.md", "updated readme",
)
MOST_CHARS, SHORT_SPAN, LONG_SPAN = 100_000, 2, 200
SHORT_SHARE, LONG_SHARE, SHORT_SUBJECT_SHARE = 0.1, 0.1, 0.5


def change_range(old: Column | str, new: Column | str) -> Column:
    """First and last changed line of each side and the counts of inserted and deleted lines."""

    @F.pandas_udf("struct<old_start:int,old_end:int,new_start:int,new_end:int,inserted:int,deleted:int>")
    def ranges(olds: pd.Series, news: pd.Series) -> pd.DataFrame:
        out = []
        for a, b in zip(olds, news):
            a, b = (a or "").split("\n"), (b or "").split("\n")
            ops = [o for o in difflib.SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if o[0] != "equal"]
            if ops:
                out.append((ops[0][1], ops[-1][2], ops[0][3], ops[-1][4], sum(o[4] - o[3] for o in ops), sum(o[2] - o[1] for o in ops)))
            else:
                out.append((0, 0, 0, 0, 0, 0))
        return pd.DataFrame(out, columns=["old_start", "old_end", "new_start", "new_end", "inserted", "deleted"])

    return ranges(T.col(old), T.col(new))


def commit_filter(commits: DataFrame, id_col: str = "id") -> DataFrame:
    """Commits with a telling subject and a change of moderate size; adds `change`.

    commits: id, subject, old_contents, new_contents. Very small and very large changes and
    short subjects stay with the given shares, by a hash of the id. Subjects of versions,
    of one indented word, or of very long words go, as do empty new contents.
    """
    low = F.lower("subject")
    dull = low.isin(*BAD_SUBJECTS) | F.rlike(low, F.lit(r"^v?\d+\.\d+\.\d+($|\S)"))
    for s in BAD_PARTS:
        dull = dull | F.contains(low, F.lit(s))
    n_words = F.size(T.words("subject"))
    indented = F.startswith("subject", F.lit(" ")) & (n_words == 1)
    long_words = F.length("subject") / F.greatest(n_words, F.lit(1)) > 20
    told = (n_words >= 5) | (T.uniform(id_col, "subject") < SHORT_SUBJECT_SHARE)
    kept = commits.where((n_words > 0) & ~dull & ~indented & ~long_words & told & (F.length("new_contents") > 0) & (F.length("old_contents") < MOST_CHARS))
    ranged = kept.withColumn("change", change_range("old_contents", "new_contents"))
    span = F.col("change.old_end") - F.col("change.old_start")
    fits = ((span > SHORT_SPAN) | (T.uniform(id_col, "short") < SHORT_SHARE)) & ((span < LONG_SPAN) | (T.uniform(id_col, "long") < LONG_SHARE))
    return ranged.where(fits)


def commit_sample(commits: DataFrame, id_col: str, whole_share: float = 0.2, margin: int = 32) -> DataFrame:
    """commits with `content`: before, message and after; a share in full, the others about the change."""
    u = F.floor(T.uniform(id_col, "margin") * margin).cast("int")

    def window(text: str, a: str, b: str) -> Column:
        first = F.greatest(F.col(f"change.{a}") - u, F.lit(0))
        part = F.array_join(F.slice(T.lines(text), first + 1, F.col(f"change.{b}") + u - first), "\n")
        return F.when(T.uniform(id_col, "whole") < whole_share, F.col(text)).otherwise(part)

    parts = (F.lit("<commit_before>"), window("old_contents", "old_start", "old_end"), F.lit("<commit_msg>"), F.col("subject"), F.lit("<commit_after>"), window("new_contents", "new_start", "new_end"))
    return commits.withColumn("content", F.concat(*parts))


def without_opted_out(commits: DataFrame, opted_out: DataFrame, id_col: str, repos_col: str = "repos") -> DataFrame:
    """Commits whose list of repositories lost those of owners who opted out; commits without any left go."""
    owners = opted_out.select(F.lower("owner").alias("owner")).distinct()
    each = commits.select(id_col, F.posexplode(F.split(repos_col, ",", -1)).alias("pos", "repo")).withColumn("owner", F.lower(F.split("repo", "/")[0]))
    left = each.join(owners, "owner", "left_anti").groupBy(id_col).agg(F.array_sort(F.collect_list(F.struct("pos", "repo"))).alias("_r"))
    named = left.select(id_col, F.array_join(F.transform("_r", lambda r: r["repo"]), ",").alias(repos_col))
    return commits.drop(repos_col).join(named, id_col)


def allowed_extension(path: Column | str, allowed: list[str], sampled: dict[str, float] | None = None, key: Column | str = "path") -> Column:
    """Whether a file's extension is allowed (or it is a Dockerfile or Makefile); some only for a share of the files."""
    name = F.element_at(T.path_parts(path), -1)
    extension = F.lower(F.element_at(F.split(name, r"\.", -1), -1))
    out = extension.isin(*allowed) | name.isin("Dockerfile", "Makefile")
    for e, share in (sampled or {}).items():
        out = out & ((extension != e) | (T.uniform(key, "extension") < share))
    return out

"""Stars, licences and metadata prefixes of files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T


def star_bucket(stars: Column | str) -> Column:
    """0, 1-10, 10-100, 100-1000 or 1000+; null counts as none."""
    n = F.coalesce(T.col(stars), F.lit(0))
    return F.when(n == 0, "0").when(n <= 10, "1-10").when(n <= 100, "10-100").when(n <= 1000, "100-1000").otherwise("1000+")


def with_metadata(content: Column | str, repo: Column | str, path: Column | str, stars: Column | str, key: Column | str, share: float = 0.2) -> Column:
    """The content after its repository, file name and star bucket, each with the given chance by a hash of the key."""
    fields = (("reponame", T.col(repo)), ("filename", T.col(path)), ("gh_stars", star_bucket(stars)))
    chosen = [T.uniform(key, name) < share for name, _ in fields]
    parts = [F.when(c, F.concat(F.lit(f"<{name}>"), value)).otherwise(F.lit("")) for c, (name, value) in zip(chosen, fields)]
    any_ = chosen[0] | chosen[1] | chosen[2]
    return F.concat(*parts, F.when(any_, F.lit("\n")).otherwise(F.lit("")), T.col(content))


def licences(column: Column | str) -> Column:
    """Licence names of a list of {item} structs nested under `list`."""
    return F.transform(T.col(column)["list"], lambda x: x["item"])

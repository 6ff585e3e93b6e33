"""Column functions over texts: lines, words, ratios, shingles, hashes, similarities.

All are built-in expressions, so they stay inside generated code and prune like any other
column. A null text gives null unless a docstring says otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what separates the pieces that shingles are made of.
PIECE_BREAK = "[^A-Za-z_0-9]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lines(text: Column | str) -> Column:
    """The lines of a text; a text always has one more than it has line feeds."""
    return F.split(col(text), "\n", -1)


def n_lines(text: Column | str) -> Column:
    t = col(text)
    return (F.length(t) - F.length(F.replace(t, F.lit("\n"), F.lit(""))) + 1).cast("long")


def max_line_length(text: Column | str) -> Column:
    return F.array_max(F.transform(lines(text), F.length)).cast("long")


def avg_line_length(text: Column | str) -> Column:
    n = n_lines(text)
    return (F.length(col(text)) - n + 1) / n


def ratio_of(text: Column | str, dropped: str) -> Column:
    """Share of a text's characters that are left when those of a pattern go; 0 for an empty text."""
    t = col(text)
    size = F.length(t)
    return F.when(size == 0, F.lit(0.0)).otherwise(F.length(F.regexp_replace(t, dropped, "")) / F.greatest(size, F.lit(1)))


def digit_ratio(text: Column | str) -> Column:
    return ratio_of(text, r"[^\p{Nd}]")


def alnum_fraction(text: Column | str) -> Column:
    return ratio_of(text, r"[^\p{L}\p{N}]")


def alpha_fraction(text: Column | str) -> Column:
    return ratio_of(text, r"[^\p{L}]")


def words(text: Column | str) -> Column:
    """White-space separated words."""
    return F.filter(F.split(col(text), r"[ \t\n\r]+", -1), lambda w: w != "")


def identifier_words(text: Column | str) -> Column:
    """Words between blanks and underscores, camel case split."""
    parts = F.transform(F.split(col(text), r"[\t \n_]+", -1), lambda w: F.split(w, "(?=[A-Z][a-z])", -1))
    return F.filter(F.flatten(parts), lambda w: w != "")


def pieces(text: Column | str) -> Column:
    """Pieces between single characters that are no letter, digit or underscore; empty pieces stay."""
    return F.split(col(text), PIECE_BREAK, -1)


def shingles(tokens: Column, n: int, least: int = 0) -> Column:
    """Distinct n-grams of an array, joined by spaces; none when there are fewer than n (or `least`) tokens.

    Shifted copies are zipped, rather than sliced at each place in a lambda, where the
    array's own expression would be computed again for every place.
    """
    count = F.greatest(F.size(tokens) - n + 1, F.lit(0))
    grams = F.slice(tokens, F.lit(1), count)
    for k in range(1, n):
        grams = F.zip_with(grams, F.slice(tokens, F.lit(k + 1), count), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.when(F.size(tokens) >= max(n, least), F.array_distinct(grams)).otherwise(F.array().cast("array<string>"))


def hash32(value: Column | str) -> Column:
    """The first four bytes of SHA-1 as a little-endian unsigned number."""
    h = F.sha1(col(value))
    swapped = F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
    return F.conv(swapped, 16, 10).cast("long")


def uniform(key: Column | str, salt: str = "") -> Column:
    """A number in [0, 1) that depends on the key alone: the first 32 bits of its MD5 over 2**32."""
    return F.conv(F.substring(F.md5(F.concat(col(key).cast("string"), F.lit(salt))), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct elements; 0 for two empty arrays."""
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.size(F.array_union(a, b)))


def overlap_ratios(a: Column, b: Column) -> tuple[Column, Column]:
    """Shared elements over each side's distinct ones; -1 for an empty side."""
    common = F.size(F.array_intersect(a, b))

    def over(x: Column) -> Column:
        n = F.size(F.array_distinct(x))
        return F.when(n == 0, F.lit(-1.0)).otherwise(common / F.greatest(n, F.lit(1)))

    return over(a), over(b)


def positional_match(a: Column, b: Column) -> Column:
    """Equal characters at equal places over the longer length; 0 for two empty texts."""
    size = F.greatest(F.length(a), F.length(b))
    short = F.least(F.length(a), F.length(b))
    places = F.sequence(F.lit(1), F.greatest(short, F.lit(1)))
    same = F.size(F.filter(places, lambda i: (i <= short) & (F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))))
    return F.when(size == 0, F.lit(0.0)).otherwise(same / F.greatest(size, F.lit(1)))


def collapse_newlines(text: Column | str) -> Column:
    return F.regexp_replace(col(text), "\n{2,}", "\n")


def clean_signature(text: Column | str) -> Column:
    """Without bracketed arguments."""
    return F.regexp_replace(col(text), r"(?s)\(.*?\)", "")


def fixed_windows(text: Column | str, size: int) -> Column:
    """The text in consecutive parts of `size` characters, the last one shorter; none for an empty text."""
    t = col(text)
    n = F.ceil(F.length(t) / size).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.substring(t, i * size + 1, F.lit(size)))
    return F.when(n > 0, parts).otherwise(F.array().cast("array<string>"))


def path_parts(path: Column | str) -> Column:
    return F.split(col(path), r"[/\\]", -1)


def with_path_header(path: Column | str, content: Column | str, root: str = "") -> Column:
    """The content under a line that names its path, without the root folder."""
    p = col(path)
    if root:
        p = F.when(F.startswith(p, F.lit(root)), F.substring(p, F.lit(len(root) + 1), F.length(p))).otherwise(p)
    return F.concat(F.lit("<|PathStart|>\t#Path:"), p, F.lit("<|PathEnd|>\n"), col(content))


def language_name(name: Column | str) -> Column:
    """Language names as data sets spell them: lower case, c-sharp for c#, c++ for cpp."""
    n = F.lower(col(name))
    return F.when(n == "c#", "c-sharp").when(n == "f#", "f-sharp").when(n == "cpp", "c++").otherwise(F.regexp_replace(n, " ", "-"))

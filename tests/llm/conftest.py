import pytest

#: Texts that every operator meets: nulls, empties, repeats, ties, control and wide characters, long ones.
TEXTS = [
    None, "", " ", "\n", "a", "A", "a", "Hello  world\n\n don't stop", "x\ty\x0bz", "café ÉCOLE straße", "漢字 かな 😀😀", "a\xa0b c",
    "<|endoftext|> hello", "nul\0in it", "line one\nline two\n", "tail space ", "word " * 3000, "Hello  world\n\n don't stop", "\x1c\x1d x", "ﬁ İstanbul Σίσυφος ΟΔΟΣ",
]


@pytest.fixture(scope="session")
def odd(spark):
    """Documents with odd texts, a null id, a repeated row and columns with clashing names."""
    rows = [(i, t, "en", None if i % 3 == 0 else f"s{i % 2}", i, "x", 7) for i, t in enumerate(TEXTS)]
    rows += [(None, "no id", None, None, None, "x", 7), (4, "a", "en", "s0", 4, "x", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, rank string, row_key int")


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")

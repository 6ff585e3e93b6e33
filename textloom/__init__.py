"""textloom: DataFrame operators that curate text and source-code training corpora."""

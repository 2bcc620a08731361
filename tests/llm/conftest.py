import pytest

from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):
    """Documents from (doc_id, text) pairs, with extra columns whose names operators use inside."""

    def make(pairs, lang="en", source="s"):
        rows = [(i, t, lang, source, len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        for name in ("kept", "n_words", "task", "rank", "label", "root", "score"):
            df = df.withColumn(name, F.lit("own"))
        return df

    return make


@pytest.fixture()
def odd_pairs():
    """NULLs, empty, blank, repeated and very long texts, and a row without an id."""
    long = " ".join(f"word{i} of{i % 97}" for i in range(40_000))
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (None, "one"),
        (6, long), (7, long), (8, "a\u00a0b\x1cc d\x0be"), (9, "<|endoftext|> x <|startoftext|>"),
        (10, "ÉÀ ß 日本語 \U0001f600  two  blanks\r\n\r\nend"),
    ]

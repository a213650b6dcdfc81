"""Rows and fixtures of the text operators' tests."""

import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars int"
WORDS = ("the and of river stone over light house with many green field under old tree when "
         "morning comes from east wind").split()


def prose(seed: int, n: int = 60) -> str:
    out = [WORDS[(seed * 7 + i * i + i // 3 * seed) % len(WORDS)] + ("." if i % 9 == 8 else "")
           for i in range(n)]
    return " ".join(out)


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows and ids."""
    long_text = " ".join(prose(i, 50) for i in range(400))
    rows = [(i, prose(i), "en", f"s{i % 3}", 1) for i in range(30)]
    rows += [(100, None, "en", "s0", 1), (101, "", "en", "s0", None), (102, " \n\t ", None, "s1", 1),
             (103, prose(1), None, None, 1), (None, prose(2), "en", "s1", 1),
             (None, None, None, None, None), (104, long_text, "en", "s2", 1),
             (105, "x" * 50_000, "en", "s2", 1), (106, "123 456 !!!", "en", "s2", 1),
             (5, prose(5), "en", "s2", 1), (5, prose(5), "en", "s2", 1), (6, prose(40), "en", "s0", 1),
             (107, "é\u2003ß <|endoftext|> 漢字 \U0001f600", "de", "s1", 1)]
    return rows


@pytest.fixture(scope="session")
def edge_docs(spark):
    """The edge rows, with further columns named like columns that operators make."""
    docs = spark.createDataFrame(edge_rows(), DOCS)
    for name in ("key", "size", "row", "h", "n", "name", "fp", "body", "shard", "copies", "at", "a.b", "c`d"):
        docs = docs.withColumn(name, F.lit("mine"))
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)

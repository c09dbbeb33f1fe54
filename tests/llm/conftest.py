import re
from collections import Counter

import pytest

WORD = re.compile("[^\x20\x09-\x0d]+")


def words(text):
    """Words with A-Z folded, as the contracts define them."""
    return [w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(text or "")]


@pytest.fixture(scope="session")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Null, empty, blank, tied and repeated rows, and columns with clashing names."""
    long = " ".join(f"w{i % 97}x{i}" for i in range(30000))
    rows = [(1, None, "en", "a"), (2, "", "en", None), (3, " \t\n ", None, None), (4, "one two", "en", "a"), (4, "one two", "en", "a"), (None, "one two", "fr", "b"), (5, "Ünï çödé 你好 <|endoftext|> 12'34", "fr", "b"), (6, "a" * 5000, "de", "a"), (7, long, "de", "c"), (8, long, None, "c"), (9, "12 34 !!", "en", "a")]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    clash = ["size", "n", "t1", "key", "row", "drop", "words", "score", "tok", "n_lines", "batch", "count"]
    for c in clash:
        d = d.selectExpr("*", f"doc_id AS {c}")
    return d


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


def counter(xs):
    return Counter(xs)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

# Names that clash with columns the operators use inside.
CLASHING = ["fp", "hash", "_row", "id", "key", "text_key", "shard", "n_words", "size", "w", "root"]


@pytest.fixture(scope="session")
def hard_docs(spark):
    """Null in any column, empty and very long texts, ties, repeated rows, extra columns."""
    long = " ".join(f"word{i % 997}" for i in range(60_000))
    prose = "The harbour lies in the quiet bay and the boats of the village come back with the evening tide"
    rows = [
        (1, prose, "en", "a"), (2, prose, "en", "a"), (2, prose, "en", "a"), (2, prose + " again", "en", "b"),
        (3, None, "en", "a"), (4, "", None, None), (5, "   \n\t ", "de", "b"), (None, prose, None, "b"),
        (None, None, None, None), (6, long, "en", "c"), (7, "x" * 200_000, "en", "c"), (8, "1234 !!! 5678", None, "c"),
        (9, "Ünïcödé ΑΒΓΣ İstanbul naïve 日本語 ½ " + prose, "de", "b"), (10, "a\x00b\x1c c\u00a0d\u2003e \u0301f", None, "a"),
        (11, "<|endoftext|> and <|startoftext|>x it's we'll I'm", "en", None), (12, "one two", "en", "a"),
        (13, "ONE TWO", "en", "a"), (14, "same line\nsame line\nother\n\nsame line", "en", "a")]
    schema = "doc_id long, text string, lang string, source string"
    df = spark.createDataFrame(rows, schema)
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(7) for c in CLASHING})


@pytest.fixture(scope="session")
def no_docs(hard_docs):
    return hard_docs.where("false")


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def tables(spark, sf):
    return {t: [r.asDict() for r in spark.read.parquet(f"{sf}/{t}.parquet").collect()]
            for t in ("documents", "benchmark", "conversations")}


def sorted_rows(rows):
    return sorted(rows, key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


@pytest.fixture(scope="session")
def same():
    def check(df, cols, want):
        got = sorted_rows(tuple(r[c] for c in cols) for r in df.collect())
        assert got == sorted_rows(want)
    return check


@pytest.fixture(scope="session")
def dicts():
    def of(df, cols=("doc_id", "text", "lang", "source")):
        return [r.asDict() for r in df.select(*cols).collect()]
    return of

"""Small tables for the tests of the training-data operators."""

from __future__ import annotations

import pytest


@pytest.fixture
def documents(spark):
    """Makes documents from (doc_id, text, source) rows, in several partitions."""

    def make(rows, parts: int = 3):
        full = [(i, t, "en", s, None if t is None else len(t)) for i, t, s in rows]
        return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long").repartition(parts)

    return make


@pytest.fixture
def odd(spark):
    """Rows with nulls in every column, empty and long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 977}" for i in range(30_000))
    rows = [
        (1, "a b c d e f g h", "en", "s", 1), (2, "a b c d e f g h", "en", "s", 1), (2, "a b c d e f g h", "en", "s", 1),
        (3, "", "en", None, 0), (4, None, None, None, None), (None, "x y", "de", "t", 3), (None, None, None, "t", None),
        (5, long, "en", "s", len(long)), (6, "   \n\t ", "fr", "t", 6), (7, "one", "en", "", 3),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def clashing():
    """Adds columns with names that operators return or use."""
    from pyspark.sql import functions as F

    names = ("kept", "size", "target", "row", "score", "spans", "rank", "verdict", "n", "sig", "gram", "tokens", "length", "prior", "held_out")

    def add(df):
        return df.select("*", *[F.lit("clash").alias(n) for n in names])

    return add

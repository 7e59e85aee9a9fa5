from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Rows of ``documents``: ids and texts, with columns whose names operators may use themselves."""

    def make(*rows: tuple):
        table = [(i, t, "x", 1, b"z") for i, t in rows]
        return spark.createDataFrame(table, "doc_id long, text string, salt string, doc int, known binary")

    return make


# Texts that any operator must take: null, empty, blank, long, repeated, without an id.
ODD = [
    (1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "one two three\nfour"), (5, "one two three\nfour"), (6, "é ü ß ñ"),
    (None, "no id here " * 9), (7, "no id here " * 9), (None, "no id here " * 9), (8, "z" * 5000), (9, "ab " * 60_000), (10, "\x00\x01 nul " * 20),
    (7, "another text of the same id, which is long enough to hold a window of thirteen words and more"),
    (11, "another text of the same id, which is long enough to hold a window of thirteen words and more"),
]


@pytest.fixture
def odd(docs):
    return docs(*ODD)


@pytest.fixture
def nothing(docs):
    return docs(*ODD).limit(0)

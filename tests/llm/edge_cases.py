"""Tables with unusual rows, as fixtures."""

import pytest
from pyspark.sql import types as T

from millrace.llm.base import prepare

LONG = "lorem " * 9 + "ipsum dolor sit amet " * 3000


@pytest.fixture(scope="session")
def session(spark):
    return prepare(spark)


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # Names that operators use inside.
    T.StructField("id", T.StringType()), T.StructField("row", T.IntegerType()), T.StructField("body", T.StringType()),
    T.StructField("host", T.StringType()), T.StructField("n_words", T.LongType()), T.StructField("kept_id", T.LongType()),
])


def documents(session, texts, ids=None, langs=None, sources=None):
    """A documents table with columns whose names clash with those that operators use."""
    ids = list(range(len(texts))) if ids is None else ids
    langs = ["en"] * len(texts) if langs is None else langs
    sources = [f"src{i % 3}" for i in range(len(texts))] if sources is None else sources
    rows = [(i, t, a, s, len(t or ""), "x", 7, None, "h", -1, 5) for i, t, a, s in zip(ids, texts, langs, sources)]
    return session.createDataFrame(rows, DOCS)


EDGES = [
    None, "", " \t\n", "one", "one two three", "the cat sat on the mat and the dog sat on the rug " * 3, LONG, "x" * 200_000,
    "The cat.", "The cat.", "àé ñ 日本 ▁   \x00 \x1c", "a\nb\na\nb\n\n", "mail me: jo.do@mail.example.com +1 (555) 123-4567 now",
]


@pytest.fixture(scope="session")
def edge_docs(session):
    """Nulls, empty, blank, short, long and repeated texts; repeated and null ids."""
    ids = [*range(len(EDGES)), 9, None, None]
    return documents(session, [*EDGES, EDGES[9], None, "the cat sat"], ids, [None, "en", "xx", "EN-us", "", *["en"] * 11], [None, "", *["src1"] * 14])


@pytest.fixture(scope="session")
def no_docs(session):
    return documents(session, [])

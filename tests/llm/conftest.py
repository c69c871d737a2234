"""Small corpora with the awkward rows that every text operator must take."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


def doc_rows(texts):
    """(doc_id, text) pairs as full rows."""
    return [(i, t, "en", f"src{(i or 0) % 3}", len(t) if t is not None else None)
            for i, t in texts]


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(texts):
        return spark.createDataFrame(doc_rows(texts), DOCS)
    return make


LINE = "This line stands in several documents, word for word."
LONG = " ".join(f"word{i % 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def odd_texts():
    """Nulls, empty, white space, very long, repeated rows, ties, a null id."""
    return [(1, None), (2, ""), (3, " \t\n \r\n"), (4, LONG), (4, LONG), (5, "one"),
            (6, LINE + "\nown line of document six, long enough"),
            (7, "  " + LINE.upper() + "\t\nown line of document seven, long enough"),
            (8, LINE + "\n" + LINE + "\nshort\nshort"), (9, "short"), (10, "short"),
            (11, "été \U0001f600 naïve <|endoftext|> don't 12 ½ x"),
            (12, "password = hunter2secret and AKIA" + "A1" * 10 + " " + "0a" * 20),
            (None, LINE + "\nnothing else"), (13, "\x00\x1c\x85 odd controls")]


@pytest.fixture(scope="session")
def odd_docs(make_docs, odd_texts):
    return make_docs(odd_texts)


@pytest.fixture(scope="session")
def empty_docs(make_docs):
    return make_docs([])

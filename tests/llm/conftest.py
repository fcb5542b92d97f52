import pytest

from corpusloom.llm.queries import importable

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, bucket int, score double"


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names the operators use inside."""
    importable(spark)

    def make(rows, sources=None):
        sources = sources or [f"src{i % 3}" for i in range(len(rows))]
        full = [(k, t, "en", s, None if t is None else len(t), "k", 1, 0.5) for (k, t), s in zip(rows, sources)]
        return spark.createDataFrame(full, DOCS)

    return make


LONG = " ".join(f"word{i} line" for i in range(30_000))
ODD = [(1, "one two three"), (1, "one two three"), (2, None), (None, "no key"), (None, None), (3, ""), (4, LONG), (5, "日本 é \n\n x  y"), (1, "other text")]


@pytest.fixture(scope="session")
def odd(docs):
    """Nulls, empty and very long texts, repeated rows, ties of keys."""
    return docs(ODD)


@pytest.fixture(scope="session")
def empty(docs):
    return docs([])

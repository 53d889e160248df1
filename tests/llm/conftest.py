"""Small corpora with the cases that every operator must define a result for."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


def _corpus() -> list[str | None]:
    rng = random.Random(11)
    vocabulary = ["the", "of", "and", "É", "naïve", "x,", "Tail.", "10", "a|b"] + [f"w{k}" for k in range(300)]

    def text(n: int) -> str:
        return "".join(rng.choice(vocabulary) + rng.choice([" "] * 12 + ["\n", "  ", "\t"]) for _ in range(n))

    passage = text(90)
    base = text(200)
    texts: list[str | None] = [None, "", " ", "one", "one two", "\n\n", "é" * 300, "Orre " * 400, "ab" * 3000]
    texts += [text(rng.randint(1, 400)) for _ in range(40)]
    texts += [text(rng.randint(0, 60)) + passage + text(rng.randint(0, 60)) for _ in range(12)]
    for edits in range(12):  # near copies, more and more different
        words = base.split(" ")
        for _ in range(edits):
            words[rng.randrange(len(words))] = "changed"
        texts.append(" ".join(words))
    texts += [base] * 5 + [texts[12]] * 3 + [text(6000)]
    return texts


@pytest.fixture(scope="session")
def corpus():
    """(doc_id, text) with equal texts, a null doc_id and one doc_id twice."""
    rows = list(enumerate(_corpus()))
    return rows


@pytest.fixture(scope="session")
def odd_rows(corpus):
    """Rows with a null doc_id and repeated rows, besides the corpus."""
    text = corpus[30][1]
    return [*corpus, (None, text), (None, None), (7, corpus[7][1]), (31, "another text with the same id")]


@pytest.fixture(scope="session")
def docs(spark, corpus):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in corpus]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    rows = [(i, t, None, None, None) for i, t in odd_rows]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty_docs(spark):
    return spark.createDataFrame([], DOCS)

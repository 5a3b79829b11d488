import random

import pytest

WORDS = [a + b + c for a in ("an", "be", "co", "du", "er", "fi") for b in ("ra", "lo", "mi", "ne") for c in ("t", "s", "nd", "le", "")]


@pytest.fixture
def prose():
    """A maker of reproducible prose."""
    r = random.Random(7)

    def make(n: int) -> str:
        return " ".join(r.choice(WORDS) for _ in range(n))

    make.random = r
    return make


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty texts, ties, repeated rows and columns whose names operators use themselves."""
    rows = [
        (1, None, "en", "a", 0), (2, "", None, "a", 0), (None, "some words here to read", "en", None, None),
        (3, "some words here to read", "en", "b", 1), (3, "some words here to read", "en", "b", 1), (4, "…!?", "de", "b", 1),
        (5, "x" * 50_000 + " end", "en", "c", 2), (6, "same text again and again", "en", "c", 2), (7, "same text again and again", "fr", "c", 2),
    ]
    return spark.createDataFrame(
        [(*r, "u", "s", "k", 0.5) for r in rows],
        "doc_id bigint, text string, lang string, source string, n_chars bigint, uid string, sha string, kept string, score double",
    )


@pytest.fixture
def no_documents(odd_documents):
    return odd_documents.limit(0)

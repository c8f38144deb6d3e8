from __future__ import annotations

import random

import pytest


def prose(rng: random.Random, n: int, words: int = 400) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def odd_texts():
    """Ids and texts with nulls, ties, repeated rows, empty, short, very long, near and exact copies."""
    rng = random.Random(5)
    base = [prose(rng, 120) for _ in range(6)]
    long = prose(rng, 30_000, 5_000)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10, base[0]), (11, base[0].replace(" ", "\n", 3)), (12, base[1] + " tail"), (13, base[2].upper())]
    rows += [(20, None), (21, ""), (22, " \t\n"), (23, "one"), (24, "two words"), (25, "two words"), (None, base[3]), (None, None)]
    rows += [(30, long), (31, long + " end"), (4, base[4]), (4, base[4]), (40, "é\x1cñ  x y 中文\n\n\nz"), (41, "Shti " * 300)]
    rows += [(50, base[5][:300] + " " + base[0][40:500]), (51, "a\nb\nc\nd\na\nb\nx"), (52, "c\nd\nq"), (53, "a\na\na\na")]
    return rows


@pytest.fixture
def docs(spark, odd_texts):
    """The rows with columns whose names the operators use themselves."""
    rows = [(i, t, 1.5, "x", None, 7) for i, t in odd_texts]
    return spark.createDataFrame(rows, "doc_id long, text string, row double, id string, fp int, SPANS int")


@pytest.fixture
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(autouse=True)
def no_caches_of_other_tests(request):
    """Empties the caches of the encoder that a module's tests share, so that the next test finds its own only."""
    yield
    if "coders" in request.fixturenames:
        own, _ = request.getfixturevalue("coders")
        for cache in (own.stable, own.leaves, own.words, own.heads):
            cache.clear()

from __future__ import annotations

import pytest

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lam mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()

DOCS = "doc_id long, text string, lang string, source string, n_chars long, items string, row int"


def prose(seed: int, n: int) -> str:
    """n words that depend on the seed only."""
    out, x = [], seed * 2654435761 % 4294967296 + 1
    for i in range(n):
        x = (1103515245 * x + 12345) % 4294967296
        out.append(WORDS[(x >> 16) % len(WORDS)] + (WORDS[(x >> 8) % len(WORDS)] if i % 3 else ""))
    return " ".join(out)


def rows(texts, lang="en", source="src1"):
    """Documents with the columns of the supplied table and two whose names operators use themselves."""
    return [(i, t, lang, source, None if t is None else len(t), "x", 1) for i, t in texts]


@pytest.fixture(scope="session")
def frame(spark):
    return lambda texts: spark.createDataFrame(rows(texts), DOCS)


@pytest.fixture(scope="session")
def odd(frame):
    """NULLs in any column, empty and blank texts, repeated rows, ties, one very long text."""
    long = prose(99, 60_000)
    texts = [(1, None), (2, ""), (3, " \n\t "), (None, "alpha beta gamma"), (4, prose(4, 80)), (4, prose(4, 80)), (5, prose(4, 80)), (6, long), (7, "one")]
    return frame(texts)

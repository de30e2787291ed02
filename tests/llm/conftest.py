import random

import pytest


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and blank texts, a very long text, ties, repeated rows, and columns with clashing names."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 6)))
    base = [word() for _ in range(300)]
    long = " ".join(rng.choice(base) for _ in range(30_000))
    shared = " ".join(base[:40])
    rows = [
        (1, shared + " one", "en", "s0", "x", 1),
        (2, shared + " one", "en", "s0", None, 2),
        (2, shared + " one", "en", "s0", None, 2),
        (3, shared + " two", None, "s0", "y", 3),
        (4, None, "en", None, "y", 4),
        (5, "", "en", "s0", "y", 5),
        (6, " \t\n ", "en", "s0", "y", 6),
        (7, long, "de", "s1", "y", 7),
        (None, "a text without an id, " + " ".join(base[60:75]), "en", "s0", "y", 8),
        (8, "two words", "en", "s0", "y", 9),
        (9, "\n".join([" ".join(base[100:110])] * 4), "en", "s0", "y", 10),
        (10, "ÀÉ " + " ".join(w.upper() for w in base[:40]) + " one", "en", "s0", "y", 11),
    ]
    rows += [(20 + k, " ".join(rng.choice(base) for _ in range(rng.randint(1, 120))), "en", "s0", "z", k) for k in range(40)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, score string, n long")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, score string, n long")

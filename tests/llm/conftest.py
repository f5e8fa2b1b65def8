import random

import pytest


def prose(seed: int, n: int, words: int = 400) -> str:
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(words)}x{seed % 7}" for _ in range(n))


@pytest.fixture(scope="session")
def make():
    return prose


@pytest.fixture(scope="session")
def table(spark):
    """Documents with an extra column whose name clashes with what operators use inside."""

    def of(rows, schema="doc_id long, text string, lang string, source string, n_chars long, n long, id string"):
        full = [(i, t, "en", s, len(t or ""), 1, "x") for i, t, s in (r if len(r) == 3 else (*r, "s") for r in rows)]
        return spark.createDataFrame(full, schema)

    return of

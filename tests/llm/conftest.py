import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars int"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts or (doc_id, text) pairs."""
    def make(rows, extra=None):
        rows = [(r if isinstance(r, tuple) else (i, r)) for i, r in enumerate(rows)]
        df = spark.createDataFrame(
            [(i, t, "en", f"owner{(i or 0) % 3}/repo", None if t is None else len(t)) for i, t in rows], DOCS)
        return df if extra is None else df.selectExpr("*", *extra)
    return make


def prose(seed, n, words=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))

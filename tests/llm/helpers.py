"""Made-up texts and fixtures for the tests; a test module imports the fixtures it uses."""

import random

import pytest

from nightledger.llm.frames import ready

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
VOCABULARY = "the of and to in that is was he for it with as his on be at by had not".split()


def prose(seed: int, n: int, extra: int = 400) -> list[str]:
    """n made-up words, partly common ones."""
    rng = random.Random(seed)
    return [rng.choice(VOCABULARY) if rng.random() < 0.4 else f"w{rng.randrange(extra)}é" for _ in range(n)]


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text) or (doc_id, text, source)."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return ready(spark).createDataFrame(full, DOCS)

    return make


def tuples(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)

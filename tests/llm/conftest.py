import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size int, shard string, Kept int, node int"


@pytest.fixture
def documents(spark):
    """A table of documents with columns that clash with names the operators use."""

    def make(rows):
        full = [(i, text, lang, source, len(text or ""), 1, "x", 2, 3) for i, text, lang, source in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return make


@pytest.fixture
def awkward():
    """NULLs, empty and blank texts, one very long text, ties and repeated rows."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    near = [rng.choice(words) for _ in range(90)]
    rows = [
        (1, None, "en", "a"),
        (2, "", "en", None),
        (3, " \n\t ", None, "a"),
        (4, "one two", "en", "a"),
        (5, "ONE two", "en", "b"),
        (6, long, "de", "b"),
        (7, " ".join(near), "en", "c"),
        (8, " ".join([*near[:-1], "other"]), "en", "c"),
        (8, " ".join([*near[:-1], "other"]), "en", "c"),
        (9, " ".join(near), "en", None),
        (10, "ßü é 😀 " * 20, "fr", "c"),
        (11, "\x00 \x1f odd\xa0space", "fr", "c"),
    ]
    return rows + [(20 + i, " ".join(rng.choice(words) for _ in range(30 + i)), "en", "a") for i in range(30)]

import random

import pytest

#: extra columns whose names operators use themselves
EXTRA = "id long, n long, key long, kept boolean, component long, line int, length long, score double, label string"


@pytest.fixture(scope="session")
def doc_frame(spark):
    """(doc_id, text[, lang]) rows as a table of documents with clashing extra columns."""
    def make(rows):
        rows = [(i, t, *(rest or [None])) for i, t, *rest in rows]
        base = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        extra = [f"cast(null as {c.split()[1]}) as {c.split()[0]}" for c in EXTRA.split(", ")]
        return base.selectExpr("*", "'s' as source", "cast(length(text) as long) as n_chars", *extra)
    return make


@pytest.fixture(scope="session")
def prose():
    """Pseudo-prose of n words from a seeded generator."""
    syllables = "the an of re ing tion ble and nd st er on ly wh at es ha ou".split()

    def make(n, seed):
        r = random.Random(seed)
        return " ".join("".join(r.choice(syllables) for _ in range(r.randint(1, 4))) for _ in range(n))
    return make

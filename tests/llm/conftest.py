import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng, n):
    common = ["the", "of", "and", "to", "in", "is"]
    return " ".join(rng.choice(common) if rng.random() < 0.4 else "".join(rng.choice(["th", "er", "on", "an", "re", "ti", "es"]) for _ in range(rng.randint(2, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """Invented documents with nulls, empties, copies, near copies, a shared passage and a long one: (doc_id, text)."""
    rng = random.Random(3)
    passage = words(rng, 60)
    base = [words(rng, 150) for _ in range(30)]
    rows = [(k, t) for k, t in enumerate(base)]
    rows += [(100 + k, base[k]) for k in range(5)]  # exact copies
    for k in range(5, 12):  # near copies
        w = base[k].split()
        w[rng.randrange(len(w))] = "changed"
        rows.append((200 + k, " ".join(w)))
    rows += [(300 + k, f"{words(rng, 20)} {passage} {words(rng, 20)}") for k in range(6)]
    rows += [(400, None), (401, ""), (402, "a"), (403, "   \n "), (404, "é" * 70), (405, "é" * 70 + "x"), (406, "x" * 200), (407, words(rng, 5000)), (408, "one two three"), (409, "one two three")]
    rows += [(0, base[0])]  # a repeated row
    return rows


@pytest.fixture(scope="session")
def docs(spark, texts):
    """With null and clashing columns."""
    rows = [(i, t, None if i % 3 == 0 else "en", None if i % 5 == 0 else f"src{i % 3}", None if t is None else len(t)) for i, t in texts]
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, SCHEMA).repartition(3, "doc_id").withColumns({"bucket": F.lit("x"), "path": F.lit(1), "node": F.lit(2), "extra": F.lit(None).cast("string"), "w": F.lit(0.5)})


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

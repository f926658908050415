import random

import pytest

#: doc_id, text, lang, source, n_chars, and two columns whose names clash with inner ones
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, chunk string, id int"


def prose(rng: random.Random, n: int) -> str:
    words = [rng.choice(["of", "the", "and", "tion", "able", "in"]) + rng.choice(["", "ing", "est", "or", "x%d" % rng.randrange(40)]) for _ in range(n)]
    return " ".join(words).capitalize() + "."


def sample_rows() -> list[tuple]:
    """Copies, near copies, shared passages, empty, null, short and long texts, ties and nulls in every column."""
    rng = random.Random(4)
    texts = ["\n".join(prose(rng, rng.randrange(3, 40)) for _ in range(rng.randrange(1, 5))) for _ in range(40)]
    shared = prose(rng, 30)
    texts += [texts[3], texts[3], texts[5] + " tail", "head " + texts[7], texts[8] + "\n" + shared, shared + "\n" + texts[9], shared]
    texts += [None, "", " \n\t\n", "one", "One", "one two", "é" * 30 + shared[:60] + "ü" * 40, "日本語 " * 30, prose(rng, 3000) + "\n" + shared, "a" * 3000, "a" * 2990 + "b"]
    rows = [(i, t, "en" if i % 3 else None, "s%d" % (i % 2), None if i % 5 == 0 else 1, "c", None) for i, t in enumerate(texts)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return sample_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The rows with a null id, and one row twice."""
    return spark.createDataFrame([*rows[:8], (None, rows[3][1], None, None, None, None, None), (None, None, None, None, None, None, None), rows[2], rows[2]], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)

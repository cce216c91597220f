"""Small tables with everything that may go wrong in them."""

import pytest

CLASHING = ("component_id", "kept", "score", "shard", "slot", "label", "part", "row", "key", "n", "features", "unit", "ids", "text_view", "block")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)


def make(spark, rows):
    """Documents of (doc_id, text), with metadata of which some are null and columns that clash."""
    full = [(i, t, None if n % 5 == 0 else "en", None if n % 7 == 0 else f"src{n % 3}", None if n % 4 == 0 else len(t or ""), *CLASHING) for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def sentence(start, size=40):
    return " ".join(f"w{start + i}" for i in range(size))


ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one two three"), (6, "One  TWO\nthree"),
    (7, sentence(0)), (8, sentence(0)), (9, sentence(0) + " tail"), (7, sentence(0)), (None, sentence(0)), (None, None),
    (10, sentence(500, 30_000)), (11, "é ü 漢字 🙂 " * 30), (12, sentence(100, 400) + " " + sentence(0)), (13, "x" * 70_000), (14, "a\x00b\x0bc"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return make(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def build(spark):
    return lambda rows: make(spark, rows)

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns that operators use inside; none may be confused with a table's own.
CLASH = ["fp", "cell", "block", "word", "n", "score", "bin", "id", "anchor", "kind", "norm", "shared", "mark", "part", "root", "rep", "__exceptions", "__keep"]


def prose(rng, n, letters="the of and in to is on that for with as was by at from this are be or an".split()):
    syllables = ["er", "tion", "th", "an", "re", "ble", "in", "sh", "wh", "ou", "ly", "es", "ti", "nd", "or", "ha"]
    return " ".join(rng.choice(letters) if rng.random() < 0.3 else "".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    """Rows with nulls, empty and very long texts, ties and repeats."""
    rng = random.Random(5)
    a, b = prose(rng, 60), prose(rng, 300)
    long = prose(rng, 120_000)
    rows = [
        (1, a, "en", "s", 5), (2, a, "en", "s", 5), (2, a, "en", "s", 5), (3, a + " tail", None, None, None), (4, None, "en", "s", 0), (5, "", "en", "s", 0),
        (6, " \n\t ", "en", "s", 0), (7, long, "en", "s", 1), (8, long, "en", "s", 1), (9, b, "fr", "s", 1), (None, b, "fr", "s", 1), (None, None, None, None, None),
        (10, "123 456 !!!", "fr", "s", 1), (11, "one", "fr", "s", 1), (12, "Ünïcødé 漢字 🙂 \x00 text", "de", "s", 1), (13, "x" * 50_000, "de", "s", 1),
    ]
    return rows + [(20 + i, prose(rng, 40), "en" if i % 2 else "fr", "s", 1) for i in range(20)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, COLUMNS)


@pytest.fixture(scope="session")
def odd_clash(spark, odd):
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASH if c not in odd.columns))


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)

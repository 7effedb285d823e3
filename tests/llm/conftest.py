import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n long, t string, size long, kept boolean, y int, gone_id long, mix_copy int"


def prose(r: random.Random, words: int, vocabulary: int = 400) -> str:
    names = [f"w{chr(97 + i % 26)}{i:x}" for i in range(vocabulary)]
    return " ".join(r.choice(names) + r.choice(("", "", "", "", ",", ".", ".\n")) for _ in range(words))


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with everything that may be odd: nulls, empty and long texts, ties, repeated rows, clashing columns."""
    r = random.Random(4)
    base = prose(r, 300)
    near = base.split(" ")
    near[20] = "changed"
    rows = [
        (1, base, "en", "a"), (2, base, "en", "b"), (3, " ".join(near), "de", "a"), (4, None, None, None), (5, "", "en", "a"), (6, " \t\n ", "fr", None), (7, "one two", "en", "b"), (8, "One  two", "en", "b"),
        (9, prose(r, 30_000), "en", "c"), (10, "no-space-" * 5000, "en", "c"), (11, prose(r, 50) + "\n" + base[:900], "en", "a"), (12, "naïve “ünïcode” 漢字 🙂 " * 30, "es", "d"), (None, prose(r, 40), "en", "a"), (None, base, None, "a"),
        (13, base + " " + base, "en", "a"), (13, base + " " + base, "en", "a"), (14, prose(r, 120), "en", "eé"), (14, prose(r, 60), "en", "e"), (15, "trash *** &&& " * 40, "en", "a"), (16, "a\x00b " * 60, "en", "a"),
    ]
    rows += [(i, prose(r, 60 + i % 50), "en" if i % 3 else "de", "a" if i % 2 else "b") for i in range(20, 80)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, len(x[1] or ""), 7, "clash", 9, True, 3, 1, 2) for x in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return frame(spark, odd_rows).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(i, int(i % 7 > 0), int(i % 5 == 0)) for i in range(1, 80)] + [(20, 1, 0), (None, 1, 1), (21, None, None)], "doc_id long, quality int, toxic int")


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")

import os

import pytest

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, batch int"


@pytest.fixture(scope="session")
def data():
    return DATA


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in every column, empty and long texts, ties, repeated rows and clashing columns."""
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    long = " ".join(words[(i * i + i // 7) % 10] + str(i % 97) for i in range(9000))
    base = "The quick brown fox jumps over the lazy dog near a river bank while nine grey geese fly south again. " * 6
    rows = [
        (1, base, "en", "s", 1), (2, base, "en", "s", 1), (2, base, "en", "s", 1), (3, base + "tail", None, None, None),
        (4, None, "en", "s", None), (5, "", None, "s", 0), (6, " \t\n", "en", None, 3), (7, long, "en", "s", 9),
        (8, long[:20000] + " end", "de", "s", 9), (9, "one two", "de", "s", 7), (10, "One TWO", "de", "s", 7),
        (11, "漢字 ▁ é́ 😀 \x00 ''s", "zz", "s", 2), (None, base, "en", "s", 1), (None, None, None, None, None),
        (12, "Licensed under the Apache License, Version 2.0. mit license", "en", "s", 1), (13, "123 !!", "en", "s", 1),
    ]
    return [(*r, 0.5, 7, 3) for r in rows]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)

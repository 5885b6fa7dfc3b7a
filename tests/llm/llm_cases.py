"""Rows that every operator must take: fixtures for the tests of this folder."""

import pytest

LONG = " ".join(f"word{i % 977} and{i % 13}" for i in range(60_000))

#: Nulls, empty and very long texts, repeated rows, equal ids with unlike texts, extra columns with names of outputs.
ODD = [
    (1, "one two three four five six", "en", "a", 27), (1, "one two three four five six", "en", "a", 27),
    (1, "another text of the same id", None, "a", None), (None, "no id at all", "en", None, 12),
    (None, None, None, None, None), (2, None, "en", "a", 0), (3, "", "en", "b", 0), (4, " \t\n ", "en", "b", 4),
    (5, LONG, "en", "b", len(LONG)), (6, LONG + " tail", "en", "b", len(LONG) + 5),
    (7, "naïve café – 北京 🙂 <|endoftext|>", "fr", "c", 30), (8, "one  two three\tfour five six", "en", "c", 29),
]
EXTRA = "key string, ids string, kept int, score string, spans int, norm string, group_size int, match0 int, judged int"


@pytest.fixture(scope="session")
def odd(spark):
    rows = [(*r, *["x", "y", 0, "z", 1, "n", 2, 3, 4]) for r in ODD]
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def some_labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 1), (3, 0, None), (3, 1, 1), (99, 1, 1)],
                                 "doc_id long, quality int, toxic int")

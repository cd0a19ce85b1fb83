from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rank int"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def real(spark):
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls everywhere, empty and very long texts, ties, repeated rows, odd white space."""
    words = "the quick brown fox jumps over a lazy dog and runs away from it all day long".split()
    long = " ".join(words[i * 7 % len(words)] + str(i % 911) for i in range(60_000))
    rows = [
        (1, "a b c a b c", "en", "s1", 11, "x", 1), (1, "a b c a b c", "en", "s1", 11, "x", 1),
        (2, None, "en", "s1", None, None, None), (3, "", None, "s2", 0, "y", 2),
        (4, " \t\n\x0b\x0c\r ", "de", None, 7, "y", 2), (5, long, "en", "s1", len(long), "z", 3),
        (6, long + " tail", "en", "s2", len(long) + 5, "z", 3), (None, "no id here", "fr", "s1", 10, "", 0),
        (None, None, None, None, None, None, None), (7, "ÄÖÜ äöü ß x", "de", "s3", 11, "q", 1),
        (8, "A  b\tc A b c", "en", "s4", 12, "q", 1), (9, "line\nline\nother\n\nline", "en", "s1", 21, "", 1),
        (10, "12 34 !!", "fr", "s2", 8, "", 1), (11, "abcabc", "es", "zz", 6, "", 1),
        (12, " ".join(words * 5), "en", "s1", 9, "", 1), (13, " ".join(words * 5) + "!", "en", "s1", 9, "", 1),
        (12, "the same id with another text", "en", "s9", 29, "", 1),
    ]
    return rows + [(100 + i, "copy of one text", "en", "hot", 16, "", 1) for i in range(200)]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)

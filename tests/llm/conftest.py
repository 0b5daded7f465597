import os

import pytest

SF = "/root/testdata/sf0.001"

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, curve string, "
    "labels string, component_id string, n_tokens string, place string, n string, `key` string, low string"
)


@pytest.fixture(scope="session")
def odd_rows():
    """Documents with nulls in every column, empty and long texts, ties and
    repeated rows; the further columns have names that operators use too."""
    texts = [
        "The quick brown fox jumps over the lazy dog. MIT License, see below.",
        "The quick brown fox jumps over the lazy dog. MIT License, see below.",
        "",
        " \n\t ",
        None,
        "A",
        "word " * 30_000,
        "é日本😀 ▁▁ \x00   ﬁ İ K",
        "12345 !!! ###",
        "cc by cc by gnu general public license",
        "a" * 700,
    ]
    extra = (0.5, 7, "x", "y", "z", "t", "p", "q", "k", "l")
    rows = [(i, t, "en" if i % 2 else None, "s", 1, *extra) for i, t in enumerate(texts)]
    rows += [(None, "no id at all", None, None, None, *[None] * 10), (None, None, None, None, None, *[None] * 10)]
    return [*rows, rows[0], rows[0]]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf():
    return SF if os.path.isdir(SF) else pytest.skip("no test data")

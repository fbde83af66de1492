import os

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "ids string, spans string, counts string, size string, shard int, payload string, m int, "
    "_made string, _hash string, _block int"
)
LONG = "palabra otra vez " * 20_000
ROWS = [
    (1, "one two three four five six seven eight nine ten", "en", "a"),
    (2, None, "en", "a"),
    (3, "", "de", "b"),
    (4, " \n\t ", None, None),
    (5, "one two three four five six seven eight nine ten", "en", None),
    (5, "one two three four five six seven eight nine ten", "en", None),
    (6, LONG, "es", "c"),
    (7, "mail me at jo.doe@mail.example.com or +1 (555) 010-9999 now", "en", "b"),
    (None, "no id here but some words to go with it", "xx", "b"),
    (None, None, None, None),
    (8, "日本語のテキスト é ① \x00 ▁ ﬁ", "ja", "a"),
    (9, "one two", "en", "b"),
    (10, "one two", "en", "b"),
    (11, "host 1.2.3." + "4" * 5000 + " or " + "9" * 5000, "en", "b"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in any column, empty and long texts, ties, repeated rows, clashing names."""
    rows = [
        (i, t, lang, s, None if t is None else len(t), "x", "x", "x", "x", 1, "x", 1, "x", "x", 1)
        for i, t, lang, s in ROWS
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def given(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    return {r["doc_id"]: r for r in rows}

import os
import random

import pytest

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _id string, _text string"


@pytest.fixture(scope="session")
def spark():
    from lakelens.session import get_session
    return get_session("local[4]", app="lakelens-llm-tests", shuffle_partitions=8)


def edge_rows():
    """NULLs in every column, empty and very long texts, ties, repeated rows,
    and extra columns whose names clash with internal ones."""
    rng = random.Random(5)
    vocab = [f"w{i}" for i in range(400)]
    long = " ".join(rng.choice(vocab) for _ in range(60_000))
    rows = [
        (1, None, None, None, None, "x", None),
        (2, "", "en", "a", 0, None, "y"),
        (3, " \t\n ", "en", "a", 4, "z", "z"),
        (4, long, "en", "b", len(long), "z", "z"),
        (5, "Same text, five words here.", "en", "b", 1, "z", "z"),
        (6, "Same text, five words here.", "en", "c", 1, "z", "z"),
        (6, "Same text, five words here.", "en", "c", 1, "z", "z"),
        (None, "no id but a text of several words here", "en", "c", 1, "z", "z"),
        (7, "été ñandú ÀÉ 東京   word joined", "fr", "", 1, "z", "z"),
    ]
    for i in range(8, 60):
        n = rng.choice([1, 2, 5, 12, 40, 120])
        rows.append((i, " ".join(rng.choice(vocab) for _ in range(n)), "en", rng.choice("abcd"), n, "z", "z"))
    return rows


@pytest.fixture(scope="session")
def edge(spark):
    return spark.createDataFrame(edge_rows(), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

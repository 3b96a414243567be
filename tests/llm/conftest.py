"""A table with everything that can go wrong, and the documents of the smallest scale."""

import os

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows and ids, columns that clash with results."""
    long = " ".join(f"w{i} word{i % 97}." for i in range(60_000))
    rows = [
        (1, "The same Text stands here twice", "a"), (2, "the same text stands HERE twice", "b"), (3, None, "a"), (4, "", None),
        (5, " \n\t ", "a"), (6, "one", "c"), (7, "one two", "c"), (8, "ÄÖ ß é 日本 語", None), (9, long, "a"), (9, long, "a"),
        (10, long + " end", "b"), (None, "no id here but a text", "b"), (None, None, None), (None, "no id here but a text", "b"),
        (11, "x" * 200_000, "d"), (12, "1.2.3." * 20_000, "d"), (13, "a@b" + ".c" * 30_000, "d"), (14, "9" * 100_000, "d"),
        (15, "no id here but a text", "z"), (16, "tie", "t"), (16, "tie", "t"), (16, "another text of that id", "t"),
    ]
    schema = "doc_id long, text string, source string, kept string, score string, _spans string, size long, shard string"
    return spark.createDataFrame([(*r, None, "x", None, i, None) for i, r in enumerate(rows)], schema).repartition(3)


@pytest.fixture(scope="session")
def nothing(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def benchmark(spark, docs):
    return spark.read.parquet(f"{SF_DIR}/benchmark.parquet")


@pytest.fixture(scope="session")
def labels(spark, docs):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


@pytest.fixture(scope="session")
def hot(spark):
    """A third of all rows are copies of one text, a third near copies of another."""
    import random

    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(900)]
    base = [rng.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(600):
        if i % 3 == 0:
            text = "exact copy of the\nsame old long line of text\nagain and again"
        elif i % 3 == 1:
            edited = list(base)
            for _ in range(rng.randrange(0, 9)):
                edited[rng.randrange(len(edited))] = rng.choice(vocabulary)
            text = " ".join(edited)
        else:
            text = " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(1, 60)))
        rows.append((i * 7 % 600, text, "hot" if i % 3 else "rest"))
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(8)

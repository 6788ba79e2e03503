import random

import pytest

#: Cases that every operator must give a defined result for; ids are not all distinct.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "one"),
    (5, "same text here"),
    (5, "same text here"),
    (None, "a row without an id"),
    (None, None),
    (6, "Ünïcode 漢字 😀 é x <|endoftext|> 'll"),
    (7, "x" * 9000),
    (8, "word " * 5000),
]

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, h1 string, score string, n string, label int"


@pytest.fixture
def tables(spark, folder):
    """Write documents (and labels) with nulls and clashing names in the other columns."""

    def write(rows, labels=(), langs=None):
        full = [(i, t, (langs or {}).get(i), None, None, "h", None, "n", None) for i, t in rows]
        spark.createDataFrame(full, DOCUMENTS).repartition(3).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
        marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
        marks.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
        return folder

    return write


@pytest.fixture(scope="session")
def prose():
    """Text of ``n`` invented words, from a seed."""

    def make(n, seed):
        rng = random.Random(seed)
        parts = ["an", "the", "ou", "re", "on", "tion", "ble", "st", "er", "in", "ly", "ha"]
        return " ".join("".join(rng.choices(parts, k=rng.randint(1, 4))) for _ in range(n))

    return make


@pytest.fixture
def edges():
    return list(EDGES)

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed: int, n: int) -> list[str]:
    r = random.Random(seed)
    return ["".join(r.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(r.randint(2, 9))) for _ in range(n)]


def odd_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows, near copies, a shared passage, white space of all kinds."""
    a, b, passage = words(1, 120), words(2, 200), words(3, 60)
    near = [*a[:60], "changed", *a[61:]]
    texts = [
        (5, None), (6, ""), (7, " \t\n "), (None, " ".join(words(4, 40))), (1, " ".join(a)), (2, " ".join(a)), (3, " ".join(near)),
        (8, " ".join(b[:50] + passage + b[50:])), (9, "\n".join(words(5, 30) + passage)), (9, "\n".join(words(5, 30) + passage)),
        (10, "word"), (11, "Two WORDS"), (12, "x " * 3000), (13, "y" * 5000), (14, "Released under the MIT License. <|endoftext|> don't ΑΣ it's 42!"),
        (15, "Licensed under the Apache License, Version 2.0 and CC BY-NC 4.0 under the mit license"), (16, " ".join(words(6, 5000))),
        (17, "\x1c\x85  a b ́c"), (18, " ".join(words(7, 13))), (19, " ".join(words(7, 13))), (None, None), (20, " ".join(["same"] * 40)), (21, " ".join(["same"] * 40)),
    ]
    return [(i, t, ["en", "fr", None][k % 3], ["s0", "s0", "s1", None][k % 4], None if t is None else len(t)) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents, with extra columns whose names operators use inside."""
    df = spark.createDataFrame(odd_rows(), SCHEMA)
    return df.withColumns({"id": F.lit("clash"), "size": F.lit(1), "fp": F.lit(2), "words": F.lit(3), "tree": F.lit(4), "body": F.lit(5), "r": F.lit(6), "key": F.lit(7)})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")

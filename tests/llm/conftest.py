import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, shard string, "
          "n_words string, node string, keep string")


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def edge_rows():
    """Null, empty, blank, repeated, near, very long and odd texts, some without an id."""
    base = words(120, 1)
    near = base[:60] + ["changed"] + base[61:]
    long = words(30_000, 2, 5_000)
    passage = words(60, 3)
    texts = [
        (1, " ".join(base)), (2, " ".join(base)), (3, " ".join(near)), (3, "other text"),
        (4, None), (5, ""), (6, " \n\t "), (7, " ".join(long)), (None, " ".join(base)),
        (None, None), (8, "One. Licensed under the MIT License.\nLicensed under CC BY-NC 4.0."),
        (9, "a b c"), (10, "A B C"), (11, "a  b\nc"),
        (12, " ".join(words(80, 4) + passage + words(80, 5))),
        (13, " ".join(words(50, 6) + passage[5:55] + words(50, 7))),
        (14, "éclair 日本語 " * 60), (15, "same line here\n" * 40), (15, "same line here\n" * 40),
        (16, " x y \x1c z"), (17, "!!! ### | $$$ " * 30),
    ]
    return [(i, t, "en", "s", len(t or ""), "x", "y", "z", "k") for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    return spark.createDataFrame(edge_rows(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)

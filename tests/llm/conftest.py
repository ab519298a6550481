import random

import pytest
from pyspark.sql import types as T

# Clashing names: columns that operators make or use themselves.
ODD = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("size", T.StringType()),
        T.StructField("_id", T.StringType()),
        T.StructField("_text", T.LongType()),
        T.StructField("text_hash", T.StringType()),
        T.StructField("n_lines", T.StringType()),
        T.StructField("position", T.StringType()),
        T.StructField("component_id", T.StringType()),
    ]
)


def words(rng, n, vocabulary=5_000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_rows():
    """Nulls everywhere, empty, blank and very long texts, copies, repeated rows, ties."""
    rng = random.Random(5)
    plain = " ".join(words(rng, 60))
    long = "\n".join(" ".join(words(rng, 12)) for _ in range(3_000))
    texts = [
        (1, plain, "s1"), (2, plain.upper(), "s1"), (2, plain.upper(), "s1"), (3, None, "s2"),
        (4, "", "s2"), (5, " \t\n\x0b ", None), (None, plain, None), (None, None, None),
        (6, long, "s3"), (7, long + " tail", "s3"), (8, "one two", "s1"), (9, "One  TWO", "s4"),
        (10, "a\nb\n\n", "s4"), (11, "ünï çødé 　 \x85 \U0001f600 İ ß Σ", "s5"),
        (12, "word " * 50, "s5"), (13, plain + " end", "s1"), (2**62, "token = 12345678 " + plain, ""),
    ]
    return [(i, t, None, s, None, "x", "y", 7, "z", "q", "p", None) for i, t, s in texts]


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_rows(), ODD)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture
def scratch(spark, tmp_path):
    from greenshoe.llm.shared import Scratch

    s = Scratch(spark, "test")
    s.root = f"file://{tmp_path}/scratch"
    return s


@pytest.fixture(scope="session")
def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")

"""A small table of documents with nulls, empty and long texts, copies, repeated
rows and columns whose names the operators use themselves."""

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = ["the", "of", "le", "der", "el", "éa", "straße", "niño", "Alpha", "beta", "gamma", "delta", "x1", "naïve", "😀", "and", "is"]

    def prose(k: int) -> str:
        return " ".join(rng.choice(words) + str(rng.randrange(40)) * (rng.random() < 0.6) for _ in range(k))

    shared = prose(80)
    texts: list[str | None] = [None, "", " \t\n", "a", "A", "only", prose(3000), "b" * 2500, "ab " * 900]
    for i in range(n):
        t = prose(rng.randrange(1, 200))
        if i % 5 == 0:
            t = t + " " + shared + " " + prose(rng.randrange(0, 30))
        if i % 7 == 3:
            t = rng.choice([x for x in texts if x])
        if i % 7 == 5:
            w = max((x for x in texts if x), key=len).split(" ")[:150]
            w[rng.randrange(len(w))] = "changed"
            t = " ".join(w)
        texts.append(t)
    rows = [(i * 3 + 2, t, rng.choice(["en", "fr", None]), rng.choice(["s1", "s0", "s2", None, "s1", "s1"]), len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[20], rows[20], (None, texts[12], "en", "s1", 1), (None, None, None, None, None)]
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def table(spark, tmp_path_factory):
    """A folder with a documents table of given rows."""

    def write(rows: list[tuple]) -> str:
        folder = tmp_path_factory.mktemp("sf")
        spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
        return str(folder)

    return write

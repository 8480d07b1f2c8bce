"""Small tables that every operator must stand: nulls, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import random

import pytest

SF0001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def odd_rows():
    r = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    body = " ".join(r.choice(words) for _ in range(120))
    return [
        (1, body, "en", "a"), (2, body.upper(), "en", "a"), (3, None, None, None), (4, "", "en", "b"), (5, " \t\n ", "xx", "b"),
        (6, "one", "en", "c"), (7, "one", "en", "c"), (7, "one", "en", "c"), (8, "Ünï \U0001f600 cödé", "de", "c"),
        (9, " ".join(r.choice(words) for _ in range(30_000)), "en", "a"), (10, "x" * 50_000, "en", "a"),
        (None, body + " tail", "en", "a"), (11, body + " tail of it", None, "a"), (12, "ß" * 700, "en", None),
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """The odd rows with extra columns named like the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(odd_rows, "doc_id long, text string, lang string, source string")
    for name in ("size", "_size", "key", "node", "n", "rank", "shard", "keep_id", "tid", "target", "marks", "label", "_c0", "digest"):
        df = df.withColumn(name, F.lit("clash"))
    return df


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string")


@pytest.fixture(scope="module")
def documents(spark):
    df = spark.read.parquet(f"{SF0001}/documents.parquet").cache()
    yield df
    df.unpersist()


@pytest.fixture(scope="module")
def document_rows(documents):
    return [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in documents.collect()]

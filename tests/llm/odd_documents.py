"""Fixtures shared by the operators' tests: documents with every odd case."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

from conftest import SF_SMALL

LONG = 12_000
EXTRA = ("size", "h", "times", "text_hash", "spans", "row", "kept", "n_words", "fp", "part", "T")


def odd_rows() -> list[tuple]:
    """Documents with NULLs, empty and long texts, ties, repeated rows and ids."""
    rng = random.Random(7)
    vocabulary = [f"w{i}é" for i in range(400)]
    passage = " ".join(rng.choices(vocabulary, k=70))
    other = " ".join(rng.choices(vocabulary, k=130))
    rows = [
        (1, "a b\tc", "s1"), (2, None, None), (3, "", "s1"), (4, " \n\t ", "ſ"), (None, "x y z w v u", "s2"),
        (None, None, "s2"), (5, " ".join(rng.choices(vocabulary, k=LONG)), "s3"), (5, passage + "\n" + other, "s3"),
        (6, passage, "s1"), (6, passage, "s1"), (7, "intro words " + passage.upper() + " then " + passage, None),
        (8, "é ß\n日本 🙂 " * 40, "S"), (9, other + " " + passage, "s2"), (10, passage, "s2"),
        (None, passage, "s2"), (-3, "<|endoftext|> Don't   stop  now", "s1"), (11, other + " tail", "s3"),
    ]
    return [(i, t, None, s, None if t is None else len(t), *["x"] * len(EXTRA)) for i, t, s in rows]


def document_schema(extra: tuple[str, ...] = EXTRA) -> T.StructType:
    kinds = [("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()),
             ("source", T.StringType()), ("n_chars", T.LongType()), *((c, T.StringType()) for c in extra)]
    return T.StructType([T.StructField(n, k) for n, k in kinds])


@pytest.fixture(scope="session")
def odd(spark):
    """The odd documents, with extra columns whose names operators use."""
    return spark.createDataFrame(odd_rows(), document_schema()).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], document_schema())


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet")

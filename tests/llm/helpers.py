"""Small document tables with every awkward case: nulls, empty and long texts, repeats and clashing column names."""

import random

import pytest

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def words(seed, n):
    rng = random.Random(seed)
    return [rng.choice("aeiou") + "".join(rng.choice("bcdlmnrst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]


def prose(seed, n):
    return " ".join(words(seed, n))


AWKWARD = [
    (None, "a text without an id"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Ünïcödé wörds İ K ſ 漢字 \U0001f600 end"),
    (6, prose(6, 120)), (6, prose(6, 120)), (7, prose(6, 120)), (8, "same " * 400), (9, prose(9, 30000)), (10, "x" * 70000),
    (11, "tab\tand  two spaces\x1c odd \x85 ends.\r\n\r\nNew \u00a0line "), (12, "\\x00\x00 \x01 nul"),
]


@pytest.fixture(scope="session")
def table(spark):
    """``table(rows)`` gives documents; ``clash`` adds columns whose names operators use themselves."""
    def make(rows, clash=()):
        frame = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], SCHEMA)
        return frame.selectExpr("*", *[f"'own' AS `{name}`" for name in clash])
    return make


@pytest.fixture(scope="session")
def awkward():
    return list(AWKWARD)

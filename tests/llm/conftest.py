import pytest
from pyspark.sql import types as T

#: Rows that every operator must take: nulls anywhere, empty, white-space and
#: long texts, repeated rows, ties, and a text without letters.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # extra columns whose names could clash with an operator's own
    T.StructField("score", T.StringType()), T.StructField("key", T.StringType()), T.StructField("batch", T.LongType())])

WORDS = "river stone amber willow copper lantern meadow harbor velvet thunder orchard pebble".split()


def passage(seed: int, n: int) -> str:
    out, x = [], seed * 7919 + 13
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % 12] + str((x >> 16) % 50))
    return " ".join(out)


def awkward_rows():
    base = passage(1, 60)
    rows = [
        (1, base, "en", "a"), (2, base, "en", "a"), (3, base.replace(base.split()[30], "changed"), "en", None),
        (4, passage(2, 40) + "\nshared line of some length\n" + passage(3, 10), "de", "b"),
        (5, "SHARED line of some length  \nshort\n\nshort", None, "b"), (6, None, None, None), (7, "", "en", "a"),
        (8, " \t\n ", "fr", "a"), (9, "12 34 !!", "fr", "a"), (10, passage(4, 30_000), "en", "long"),
        (11, "one two", "es", "a"), (12, "one two", "es", "a"), (None, passage(5, 25), "en", None), (None, passage(6, 25), "en", None),
        (13, "Été naïve \U0001f600 straße", "fr", "c"), (14, passage(7, 30), "en", "d"), (14, passage(7, 30), "en", "d"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "x", "y", 0) for i, t, lang, s in rows]


@pytest.fixture()
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA)


@pytest.fixture()
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_small():
    return "/root/testdata/sf0.01"

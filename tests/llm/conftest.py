import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

DOCUMENT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                         T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])
LABEL = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.LongType()), T.StructField("toxic", T.LongType())])
ITEM = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
#: Columns that clash with names the operators use or return.
CLASH = ("rid", "n", "node", "size", "kept", "score", "spans", "text_", "label", "token", "copies", "gram")


@pytest.fixture(scope="session")
def make(spark):
    """documents(rows, clash=False): rows are (doc_id, text) or full ones."""
    def documents(rows, clash=False):
        full = [(*r, *([None, "s", None][len(r) - 2:] if len(r) < 5 else ())) for r in rows]
        df = spark.createDataFrame(full, DOCUMENT).repartition(3)
        if clash:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit("x") for c in CLASH})
        return df
    return documents


@pytest.fixture(scope="session")
def make_labels(spark):
    return lambda rows: spark.createDataFrame(rows, LABEL)


@pytest.fixture(scope="session")
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, ITEM)


def prose(seed, n):
    """Invented words, some of them common."""
    import random
    r = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "is"]
    words = [r.choice(common) if r.random() < 0.3 else "".join(r.choice("abcdefghiklmnoprstu") for _ in range(r.randint(2, 9))) for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


@pytest.fixture(scope="session")
def text():
    return prose


@pytest.fixture(scope="session")
def hard_rows(text):
    """Nulls, empty and blank texts, a very long text, ties, repeated rows, null and repeated ids."""
    a, b = text(1, 120), text(2, 60)
    return [(1, a), (2, a), (2, a), (3, a + " tail"), (4, None), (5, ""), (6, " \n\t "), (7, "one"), (8, "one two"), (9, "One TWO"), (10, b), (None, b), (None, None),
            (11, "x" * 200_000), (12, "é" * 500 + " ß ñ " + a), (13, text(3, 30_000)), (14, "a b c d e " * 300), (15, b), (15, text(4, 20)), (16, "line\nline\nline\n\n \nline x")]

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SMALL = "/root/testdata/sf0.001"
MID = "/root/testdata/sf0.01"

#: Cases that every operator must take: nulls, empty, white space only, ties, repeated rows, a long text.
LONG = " ".join(f"word{i % 5000}" for i in range(30_000))
EDGE = [
    (1, None, "en", "a"), (2, "", "en", None), (3, " \t\n", None, "a"), (4, "Same text here, of six words.", "en", "b"),
    (5, "Same text here,  of six words.", "en", "b"), (5, "Same text here,  of six words.", "en", "b"),
    (6, "Same text here,  of six words.", "en", "b"), (None, "no id on this one", "en", "c"), (7, LONG, "en", "c"),
    (8, LONG + " tail", "en", "c"), (9, "ÄÖ ß 日本 ▁x 🎉 <s> <|endoftext|> 12.5", "de", None),
]


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(*r, 0, "x", 1.5) for r in EDGE]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, row int, h string, size double")


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")

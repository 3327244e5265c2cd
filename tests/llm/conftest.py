import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def con():
    from compare import connect

    return connect(SMALL)


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns with names that operators use."""
    long_ = " ".join(f"w{i % 997}" for i in range(30000))
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [
        (1, "a b c d e f g h i j k l", "en", "s1"), (1, "a b c d e f g h i j k l", "en", "s1"), (1, "other words with one id", "en", "s1"),
        (2, None, "en", "s1"), (3, "", "de", "s2"), (4, "  \n\t ", "de", "s2"), (None, "no id here at all", None, None), (None, None, None, None),
        (5, long_, "en", "s1"), (6, "x " + passage + " y", "en", "s2"), (7, "z " + passage, None, "s2"), (8, "Ünï ΣΑΣ <|endoftext|> don't!", "de", None), (9, "one", "en", "s1"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "1 as k", "'x' as key", "2 as label", "3 as n", "4 as below", "5 as score")


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

SF = "/root/testdata/sf0.001"
LONG = "Langer Text, mit vielen Wörtern! " * 3000
LINE = "  Shared LINE\t"

#: doc_id, text, lang, source, n_chars and columns whose names clash with results and work columns
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \n\t ", "en", "a", 4), (4, "one", "en", "b", 3),
    (5, "one", "en", "b", 3), (5, "one", "en", "b", 3), (None, "one two", "en", None, 7), (None, None, None, "a", None),
    (6, LONG, "de", "hot", 1), (7, LONG + "x", "de", "hot", 1), (8, "É é ß 日本 x|y & <z> #\nÉ é\nÉ é", "fr", "hot", 9),
    *[(20 + i, f"alpha {i}\n{LINE}\nSHARED line\nshared line \x0b\n\n", "en", "hot", 5) for i in range(12)],
    (40, "a b c d e f g h i j k l m", "en", "é", 3), (41, "A B c D e f g h i j k l M", "en", "é", 3),
    (42, "w " * 300, "en", "a", 1), (43, " ".join(f"word{i}" for i in range(80)), "en", "a", 1),
    (44, "<|endoftext|> 0 00 a0b </s><s> ​\xa0x  y   z ", "en", "a", 1),
]
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size string, target string, kept string, score string, "
          "items string, matches string, copies string, n_words string, line string, fp string, term string, pos string, class string")


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls, empty and long texts, ties, repeated rows, clashing extra columns."""
    return spark.createDataFrame([(*r, *["clash"] * 13) for r in EDGE], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(edge):
    return edge.limit(0)


@pytest.fixture(scope="session")
def edge_rows():
    return [(r[0], r[1]) for r in EDGE]


@pytest.fixture(scope="session")
def items(spark):
    rows = [(1, "b c d e f g h i j k l"), (2, "One!"), (None, "two"), (3, None), (4, " . "), (5, "B C d e f g h i j k"), (5, "É É é")]
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.exists(SF):
        pytest.skip("test data not present")
    return lambda name: spark.read.parquet(f"{SF}/{name}.parquet")


def rows_of(df):
    from collections import Counter
    return Counter(map(tuple, df.collect()))

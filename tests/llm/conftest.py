import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def docs(spark):
    """Documents with the awkward cases: nulls in any column, empty and long
    texts, ties, repeated rows, clashing column names."""
    words = [f"w{i}" for i in range(300)]
    base = " ".join(words[:120])
    rows = [
        (1, base + "\nshared closing line of text here", "en", "a", 7),
        (2, base.replace("w60", "other") + "\nshared closing line of text here", "en", "a", None),
        (3, " ".join(words[150:290]), "fr", "b", 1),
        (3, " ".join(words[150:290]), "fr", "b", 1),
        (4, None, "en", None, 2),
        (5, "", None, "b", 3),
        (None, "!!! ... 123", "en", "c", 4),
        (6, "un deux trois quatre " * 4000, "fr", None, 5),
        (7, "one\n\n  \ntwo <|endoftext|> don't", "en", "c", 6),
        (8, base, None, "a", 8),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, `__Row` int")

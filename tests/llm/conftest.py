import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with nulls, empty and long texts, repeated rows, and columns named like the operators' own."""
    long = " ".join(f"w{i % 977} x{i}" for i in range(40_000))
    rows = [
        (1, "a b c d e f g h", "en", "s1", 15), (2, "a b c d e f g h", "en", "s1", 15), (2, "a b c d e f g h", "en", "s1", 15),
        (3, None, None, None, None), (4, "", "en", "s2", 0), (5, " \t\n ", "en", "s2", 4), (None, "no id here at all", "en", "s1", 17),
        (6, long, "en", "s2", len(long)), (7, 'say token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567" now', "en", None, 60), (8, "éé ▁ 漢字 \x00 🙂", "fr", "s3", 10),
        (9, "You are an idiot. Fine day.", "en", "s3", 27), (10, "host mail7.example.com and 4845168114407329 end", "en", "s3", 40),
    ]
    df = spark.createDataFrame(rows, DOCS)
    return df.selectExpr("*", "1 as score", "2 as rule", "'x' as ids", "3 as size", "'k' as fp", "4 as n_words", "'h' as host", "5 as rank", "6 as text_key")


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def words(text):
    """Words as every operator counts them."""
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SMALL = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over a lazy dog near one wide river. " * 3000


@pytest.fixture(scope="session")
def messy(spark):
    """Documents with nulls in every column, empty, wordless and long texts, repeats, and clashing extra columns."""
    rows = [
        (1, "The cat sat on the mat and looked at the dog. It was a good day for all of them there.", "en", "s1", 80, 9, "x"),
        (2, None, "en", "s1", None, 9, "x"),
        (3, "", None, "s2", 0, None, None),
        (4, "  \n\t ", "de", None, 5, 9, "x"),
        (5, "!!! ... ###", "de", "s1", 11, 9, "x"),
        (6, LONG, "en", "s1", len(LONG), 9, "x"),
        (6, LONG, "en", "s1", len(LONG), 9, "x"),
        (7, "Der Hund und die Katze sind im Haus und sie sehen den Vogel an.", "de", "s3", 60, 9, "x"),
        (None, "Der Hund und die Katze sind im Haus und sie sehen den Vogel an.", "de", "s3", 60, 9, "x"),
        (8, "Der Hund und die Katze sind im Haus und sie sehen den Vogel an.", None, "s3", 60, 9, "x"),
        (9, "é" * 5000, "fr", "s1", 5000, 9, "x"),
    ]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra long, other string")
    return plain.toDF("doc_id", "text", "lang", "source", "n_chars", "DOC_ID", "Text")


@pytest.fixture(scope="session")
def none(messy):
    return messy.limit(0)

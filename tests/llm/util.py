"""Helpers of the tests of the training-data operators."""

import zlib

SF = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, lang string, source string, n_chars int, page_id string, k1 string, size string"


def odd_docs(spark):
    """Nulls in every column, empty, blank, very long and repeated texts, repeated
    ids, and extra columns whose names clash with internal ones."""
    long_text = " ".join(f"w{i}" for i in range(30_000))
    rows = [(1, "alpha beta gamma delta epsilon zeta", "en", "a", 35, "x", "k", "s"),
            (1, "alpha beta gamma delta epsilon zeta", "en", "a", 35, "x", "k", "s"),
            (2, "alpha beta gamma delta epsilon zeta", None, "b", None, None, None, None),
            (3, None, None, None, None, None, None, None), (4, "", "de", None, 0, "", "", ""),
            (None, "alpha beta", "en", "a", 10, "x", "k", "s"), (None, None, None, None, None, None, None, None),
            (5, " \t\n ", "en", "a", 4, "x", "k", "s"), (6, long_text, "en", "b", 1, "x", "k", "s"),
            (7, "x" * 50_000, "en", "b", 1, "x", "k", "s"), (1, "another text of the same id", "en", "c", 1, "", "", "")]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)


def held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 5 == 0

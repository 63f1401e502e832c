"""A substring index of names (P7): posting rows of their trigrams.

A name that contains a needle of three or more characters contains all its trigrams, so
the posting rows of those are intersected and only the names found are compared.  The
index is rows of (gram, id) sorted by gram: a look-up reads the row groups of its own
trigrams, and the postings of a common one are as many rows as it has names, spread over
files and tasks like any others.  Shorter needles are compared with every name.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelframe.functions import name_contains
from reelframe.functions.exprs import fold_ascii

GRAM = 3
WILDCARDS = "%_"


def postings(names: DataFrame, key: str, column: str) -> DataFrame:
    """(gram, key): every distinct trigram of every name, without regard to the case of
    A-Z.  Null names and those below three characters have none."""
    folded = fold_ascii(column)
    starts = F.sequence(F.lit(1), F.length(folded) - (GRAM - 1))
    grams = F.array_distinct(F.transform(starts, lambda i: F.substring(folded, i, GRAM)))
    return names.where(F.length(folded) >= GRAM).select(F.explode(grams).alias("gram"), key)


def write_postings(names: DataFrame, key: str, column: str, path: str) -> None:
    """Sorted by gram, then key, in ranges: a hot gram spans files."""
    rows = postings(names, key, column).repartitionByRange("gram", key).sortWithinPartitions("gram", key)
    rows.write.mode("overwrite").parquet(path)


def needle_grams(needle: str) -> list[str]:
    """The needle's distinct trigrams; those with a pattern character (``%`` and ``_``
    stay wildcards in the name filter) say nothing."""
    folded = needle.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    grams = {folded[i:i + GRAM] for i in range(len(folded) - GRAM + 1)}
    return sorted(g for g in grams if not set(g) & set(WILDCARDS))


def find_names(names: DataFrame, index: DataFrame, key: str, column: str, needle: str) -> DataFrame:
    """The rows of ``names`` whose ``column`` contains ``needle`` (as ``name_contains``),
    by the index if the needle has a trigram."""
    grams = needle_grams(needle)
    if not grams:
        return names.where(name_contains(column, needle))
    hits = index.where(F.col("gram").isin(grams)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hits = hits.where(F.col("_n") == len(grams)).select(key)
    return names.join(hits, key, "left_semi").where(name_contains(column, needle))

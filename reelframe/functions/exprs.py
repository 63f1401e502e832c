"""Scalar column helpers used by the questions and the data-quality operators."""

from __future__ import annotations

import re
import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def escape_like(text: str) -> str:
    """Escape Spark's LIKE escape character only.

    ``%`` and ``_`` in the parameter stay wildcards (the SQL form binds the raw
    name into ``'%name%'``); a backslash must match itself instead of raising.
    """
    return text.replace("\\", "\\\\")


def fold_ascii(col: str | Column) -> Column:
    """Lower case of A-Z only; other letters keep their case."""
    return F.translate(_c(col), string.ascii_uppercase, string.ascii_lowercase)


def name_contains(col: str | Column, text: str) -> Column:
    """``LIKE '%text%'`` that ignores the case of A-Z only (SQL form of the name filter)."""
    folded = text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))
    return fold_ascii(col).like(f"%{escape_like(folded)}%")


def name_matches(col: str | Column, pattern: str) -> Column:
    """Case-insensitive regular-expression search (document form of the name filter)."""
    return _c(col).rlike(f"(?iu){pattern}")


def decade_intdiv(year: str | Column) -> Column:
    """``(year / 10) * 10`` with integer division (truncates toward zero).

    ``%`` keeps the sign of the dividend, so ``y - y % 10`` is exactly the
    truncating form for negative years too.
    """
    y = _c(year).cast("bigint")
    return y - y % 10


def decade_floor(year: str | Column) -> Column:
    """``floor(year / 10) * 10`` (rounds toward minus infinity)."""
    return F.floor(_c(year) / 10) * 10


def decade_label(decade: str | Column) -> Column:
    """``1990`` -> ``'1990s'`` (cast to a whole number first so no ``.0`` appears)."""
    return F.concat(_c(decade).cast("bigint").cast("string"), F.lit("s"))


def repeat_each(arr: str | Column, times: str | Column) -> Column:
    """``[a, b]`` repeated element-wise ``k`` times -> ``[a, a, b, b]`` (k >= 1)."""
    return F.flatten(F.transform(_c(arr), lambda x: F.array_repeat(x, _c(times).cast("int"))))


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` or null when the denominator is zero or null."""
    return F.when(_c(den) != 0, _c(num) / _c(den))


def pct(part: str | Column, total: str | Column) -> Column:
    """Percentage with a zero guard."""
    return safe_ratio(_c(part) * 100.0, total)


def histogram_bucket(value: str | Column, edges: Sequence[float]) -> Column:
    """1-based bin index for half-open bins ``[e_i, e_{i+1})``, the last bin closed.

    Values outside ``[edges[0], edges[-1]]`` and nulls get null.  Works for uneven
    edges: the index is the number of inner edges ``<= value``.
    """
    v = _c(value)
    lo, hi = float(edges[0]), float(edges[-1])
    inner = F.array(*[F.lit(float(e)) for e in edges[1:-1]])
    idx = F.size(F.filter(inner, lambda e: e <= v)) + 1
    return F.when((v >= lo) & (v <= hi), idx.cast("int"))


def rank_of(value: Column, cuts: Column, bits: int) -> Column:
    """Number of cuts at or below ``value``, found by halving; nulls rank first."""
    halves = F.array(*[F.lit(1 << bit) for bit in reversed(range(bits))])
    # the cut that ends the lower half decides each step
    at = F.aggregate(halves, F.lit(0), lambda at, half: at + F.when(F.get(cuts, at + half - 1) <= value, half).otherwise(0))
    return F.when(value.isNull() | F.isnan(value) | cuts.isNull(), F.lit(0)).otherwise(at)


def one_row(*frames: DataFrame) -> DataFrame:
    """The columns of several one-row frames side by side (a union and a maximum:
    no join without a key)."""
    both = frames[0]
    for f in frames[1:]:
        both = both.unionByName(f, allowMissingColumns=True)
    return both.agg(*[F.max(c).alias(c) for c in both.columns])


_HEADER_JUNK = re.compile(r"[\"'(),]")


def header_clean(name: str) -> str:
    """``"('mid',)"`` -> ``mid`` (metadata only; applied with ``toDF``)."""
    return _HEADER_JUNK.sub("", name).strip()


def dealt(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` over all shuffle partitions.  Adaptive execution merges
    the partitions of a plain aggregate by their compressed bytes, and narrow keys
    compress so well that one task would hash many millions of them."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)

"""A layout for filters on several columns (S21): a space-filling key.

The values of each column are ranked by quantile cuts, and the bits of the ranks are
interleaved into one number (Z-order).  Rows sorted by it lie near each other in every
column, so a file holds a narrow range of each, and the minima and maxima in the Parquet
footers let a filter on any of the columns skip most files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelframe.functions.exprs import rank_of

BITS = 6  # 64 ranks per column
ACCURACY = 10_000


def quantile_cuts(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """One row: per column the ascending cuts between 2^bits ranks (null: no values)."""
    shares = F.lit([i / (1 << bits) for i in range(1, 1 << bits)])
    return df.agg(*[F.percentile_approx(F.col(c).cast("double"), shares, ACCURACY).alias(c) for c in columns])


def interleave(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Bit i of rank j becomes bit ``i * len(ranks) + j``."""
    key = F.lit(0).cast("bigint")
    for i in range(bits):
        for j, rank in enumerate(ranks):
            bit = F.shiftright(rank, i).bitwiseAND(F.lit(1)).cast("bigint")
            key = key + F.shiftleft(bit, i * len(ranks) + j)
    return key


def with_zkey(df: DataFrame, columns: Sequence[str], bits: int = BITS, name: str = "_z") -> DataFrame:
    """``df`` with the key over numeric ``columns``.  The cuts are a scalar subquery of
    one row, so no join and no job while the plan is built."""
    if bits * len(columns) > 62:
        raise ValueError("the key has at most 62 bits")
    found = quantile_cuts(df, columns, bits)
    numbers = range(len(columns))
    cut = df.select("*", *[found.select(c).scalar().alias(f"_cuts{i}") for i, c in enumerate(columns)])
    # ranks first, so that each is derived once
    ranked = cut.select(*df.columns, *[rank_of(F.col(c).cast("double"), F.col(f"_cuts{i}"), bits).alias(f"_rank{i}")
                                       for i, c in enumerate(columns)])
    key = interleave([F.col(f"_rank{i}") for i in numbers], bits)
    return ranked.select(*df.columns, key.alias(name))


def write_zorder(df: DataFrame, path: str, columns: Sequence[str], num_files: int | None = None,
                 bits: int = BITS) -> None:
    """Write ``df`` range-partitioned and sorted by the key (not kept).  Rows of one key
    are told apart by the columns themselves, so equal keys may be split."""
    keyed = with_zkey(df, columns, bits)
    order = ["_z", *columns]
    parts = keyed.repartitionByRange(num_files, *order) if num_files else keyed.repartitionByRange(*order)
    parts.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").parquet(path)


def file_ranges(stored: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(file, rows, and per column c low_c and high_c) of a stored table."""
    ends = [a for c in columns for a in (F.min(c).alias(f"low_{c}"), F.max(c).alias(f"high_{c}"))]
    return stored.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("rows"), *ends)


def files_to_read(ranges: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """One row: all files, and those that closed ``bounds`` (column -> low, high; None:
    open) leave to be read, by their ranges."""
    fits = F.lit(True)
    for c, (low, high) in bounds.items():
        fits = fits & (F.lit(True) if low is None else F.col(f"high_{c}") >= low)
        fits = fits & (F.lit(True) if high is None else F.col(f"low_{c}") <= high)
    return ranges.agg(F.count(F.lit(1)).alias("files"), F.count_if(F.coalesce(fits, F.lit(False))).alias("files_read"))

"""Distributions of the exploration step.

Histograms follow numpy semantics: half-open bins ``[e_i, e_{i+1})`` with the
last bin closed, out-of-range values ignored, empty bins reported as 0 (the
bin frame comes from ``spark.range`` and is left-joined to the counts).
Percentages are of all non-missing values of the measured column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelframe.functions import decade_floor, histogram_bucket, one_row, pct
from reelframe.operators.profiling import quantiles

# Fixed bin edges of the exploration step.
RATING_EDGES = [0, 2, 4, 6, 8, 10]
CREDIT_EDGES = [0, 5, 10, 15, 20, 50, 100, 1000]
STD_DECIMALS = 6


def numeric_values(df: DataFrame, column: str) -> DataFrame:
    """F13 + F14: tolerant numeric conversion (unparsable -> null), nulls dropped."""
    return (df.select(F.expr(f"try_cast(`{column}` AS DOUBLE)").alias("value"))
            .dropna(subset=["value"]))


def summary(values: DataFrame, exact: bool = True) -> DataFrame:
    """count, min, max, mean, median, sample std of a ``value`` column.

    The standard deviation is reported to ``STD_DECIMALS`` places: engines
    accumulate the moments differently and disagree in the last bits."""
    v = F.col("value")
    stats = values.agg(F.count(F.lit(1)).alias("count"), F.min(v).alias("min"), F.max(v).alias("max"),
                       F.avg(v).alias("mean"), F.round(F.stddev_samp(v), STD_DECIMALS).alias("std"))
    # one group, keyed by a remainder that is always 0 (a literal key would plan a join without keys)
    one = F.pmod(F.hash("value"), F.lit(1)).alias("k")
    median = quantiles(values.select(one, "value"), ["k"], [0.5], exact)
    return one_row(stats, median.select(F.col("q")[0].alias("median"))).select(
        "count", "min", "max", "mean", "median", "std")


def year_stats(years: DataFrame, column: str = "start_year", exact: bool = True) -> DataFrame:
    """Statistics of the (text) year column after tolerant conversion."""
    return summary(numeric_values(years, column), exact)


def films_per_decade(years: DataFrame, column: str = "start_year") -> DataFrame:
    """Films per floor decade with their share of the converted years."""
    counts = (numeric_values(years, column)
              .groupBy(decade_floor("value").cast("bigint").alias("decade"))
              .agg(F.count(F.lit(1)).alias("films")))
    return share(counts, "films").orderBy("decade")


def share(counts: DataFrame, count_col: str) -> DataFrame:
    """``count / total * 100`` with the total over every row of ``counts``.

    ``counts`` is an aggregate over a bounded key set (bins, decades, genres), so
    the un-partitioned window total runs over a handful of rows."""
    total = F.sum(count_col).over(Window.partitionBy())
    return counts.withColumn("pct", pct(count_col, total))


def top_genres(genres: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` most frequent genres with their share of *all* genre rows."""
    counts = genres.groupBy("genre").agg(F.count(F.lit(1)).alias("count"))
    top = (counts.filter(F.col("genre").isNotNull()).orderBy(F.desc("count"), "genre").limit(k)
           .withColumn("_total", F.lit(False)))
    # the denominator counts every genre row (nulls included): one extra row, so the
    # window below runs over k + 1 rows however many genres exist
    total = counts.agg(F.sum("count").cast("bigint").alias("count")) \
        .select(F.lit(None).cast("string").alias("genre"), "count", F.lit(True).alias("_total"))
    both = top.unionByName(total)
    denominator = F.max(F.when(F.col("_total"), F.col("count"))).over(Window.partitionBy())
    return (both.withColumn("pct", pct("count", denominator))
            .filter(~F.col("_total")).drop("_total")
            .orderBy(F.desc("count"), "genre"))


def rating_stats(ratings: DataFrame, exact: bool = True) -> DataFrame:
    """Statistics of the average rating after tolerant conversion."""
    return summary(numeric_values(ratings, "average_rating"), exact)


def histogram(values: DataFrame, edges: Sequence[float]) -> DataFrame:
    """Count and share per bin, every bin reported."""
    spark = values.sparkSession
    n_bins = len(edges) - 1
    lo = F.array(*[F.lit(float(e)) for e in edges[:-1]])
    hi = F.array(*[F.lit(float(e)) for e in edges[1:]])
    bins = (spark.range(n_bins)
            .select((F.col("id") + 1).cast("int").alias("bin"))
            .withColumn("lower", F.element_at(lo, F.col("bin")))
            .withColumn("upper", F.element_at(hi, F.col("bin"))))
    # out-of-range values form the null bin: counted in the total, never shown
    counted = share(values.groupBy(histogram_bucket("value", edges).alias("bin"))
                    .agg(F.count(F.lit(1)).alias("count")), "count")
    return (bins.join(counted.filter(F.col("bin").isNotNull()), "bin", "left")
            .select("bin", "lower", "upper",
                    F.coalesce("count", F.lit(0).cast("bigint")).alias("count"),
                    F.coalesce("pct", F.lit(0.0)).alias("pct"))
            .orderBy("bin"))


def rating_histogram(ratings: DataFrame, edges: Sequence[float] = RATING_EDGES) -> DataFrame:
    return histogram(numeric_values(ratings, "average_rating"), edges)


def credits_per_film(principals: DataFrame) -> DataFrame:
    """Credit rows per film (non-null film ids)."""
    return (principals.filter(F.col("movie_id").isNotNull())
            .groupBy("movie_id").agg(F.count(F.lit(1)).alias("credits")))


def credits_stats(principals: DataFrame, exact: bool = True) -> DataFrame:
    """Mean, median, min, max, std of the credits per film."""
    return summary(credits_per_film(principals).select(F.col("credits").cast("double").alias("value")), exact)


def credits_histogram(principals: DataFrame, edges: Sequence[float] = CREDIT_EDGES) -> DataFrame:
    return histogram(credits_per_film(principals).select(F.col("credits").cast("double").alias("value")),
                     edges)

"""Copy between layouts, copy verification and storage statistics.

Sizes come from the files Spark wrote (their names and lengths, contents unread),
row counts from the data; both are aggregates, nothing is summed on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reelframe.functions import one_row
from reelframe.sources.sinks import overwrite_table, table_path


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def row_counts(tables: dict[str, DataFrame], column: str) -> DataFrame:
    return _union([df.agg(F.count(F.lit(1)).alias(column)).select(F.lit(n).alias("table_name"), column)
                   for n, df in tables.items()])


def copy_tables(tables: dict[str, DataFrame], target_root: str) -> dict[str, str]:
    """Copy every table to ``target_root/<table>`` (overwrite: re-runnable)."""
    for name, df in tables.items():
        overwrite_table(df, target_root, name)
    return {name: table_path(target_root, name) for name in tables}


def read_tables(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(path) for name, path in paths.items()}


def copy_verify(source: dict[str, DataFrame], target: dict[str, DataFrame]) -> DataFrame:
    """Source vs target row counts per table, match flag, and whether all match."""
    joined = (row_counts(source, "source_rows")
              .join(row_counts(target, "target_rows"), "table_name", "full_outer")
              .withColumn("match", F.coalesce(F.col("source_rows") == F.col("target_rows"), F.lit(False))))
    return joined.withColumn("all_match", F.bool_and("match").over(Window.partitionBy()))  # <= #tables rows


def copy_stats(verify: DataFrame) -> DataFrame:
    """Tables copied, rows copied, verification outcome."""
    return verify.agg(F.count(F.lit(1)).alias("tables_copied"),
                      F.sum("target_rows").cast("bigint").alias("rows_copied"),
                      F.bool_and("match").alias("all_match"))


def storage_stats(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Files, bytes, rows, average row size and MB per stored table."""
    parts = []
    for name, path in paths.items():
        # the files, whether or not they hold rows, and the rows in them
        files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                 .option("recursiveFileLookup", True).load(path)
                 .agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("length"), F.lit(0))
                      .cast("bigint").alias("bytes")))
        rows = spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"))
        parts.append(one_row(files, rows)
                     .select(F.lit(name).alias("table_name"), "files", "bytes", "rows"))
    return (_union(parts)
            .withColumn("avg_row_bytes", F.when(F.col("rows") > 0, F.col("bytes") / F.col("rows")))
            .withColumn("size_mb", F.col("bytes") / (1024.0 * 1024.0)))


def largest_tables(stats: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` largest stored tables with their share of the total bytes."""
    total = F.sum("bytes").over(Window.partitionBy())  # one row per stored table
    return (stats.withColumn("share_pct", F.when(total != 0, F.col("bytes") * 100.0 / total))
            .orderBy(F.desc("bytes"), "table_name").limit(k)
            .select("table_name", "bytes", "size_mb", "rows", "share_pct"))


def storage_compare(flat: DataFrame, nested: DataFrame) -> DataFrame:
    """Total bytes of the flat tables vs the nested collection, difference and
    variation in percent of the flat size."""
    f = flat.agg(F.sum("bytes").cast("bigint").alias("bytes")).select(F.lit("flat").alias("layout"), "bytes")
    n = nested.agg(F.sum("bytes").cast("bigint").alias("bytes")).select(F.lit("nested").alias("layout"), "bytes")
    both = f.unionByName(n)
    return both.groupBy().agg(
        F.sum(F.when(F.col("layout") == "flat", F.col("bytes"))).alias("flat_bytes"),
        F.sum(F.when(F.col("layout") == "nested", F.col("bytes"))).alias("nested_bytes"),
    ).withColumn("difference_bytes", F.col("nested_bytes") - F.col("flat_bytes")) \
     .withColumn("variation_pct", F.when(F.col("flat_bytes") != 0,
                                         F.col("difference_bytes") * 100.0 / F.col("flat_bytes")))


def gain(measurements: DataFrame, baseline: str, candidate: str) -> DataFrame:
    """Per measured item, ``(baseline - candidate) / baseline * 100`` with a zero
    guard.  ``measurements``: (item, variant, value)."""
    pivot = measurements.groupBy("item").agg(
        F.avg(F.when(F.col("variant") == baseline, F.col("value"))).alias("baseline"),
        F.avg(F.when(F.col("variant") == candidate, F.col("value"))).alias("candidate"))
    return (pivot.withColumn("ratio", F.when(F.col("candidate") != 0, F.col("baseline") / F.col("candidate")))
            .withColumn("gain_pct", F.when(F.col("baseline") != 0,
                                           (F.col("baseline") - F.col("candidate")) * 100.0 / F.col("baseline"))))

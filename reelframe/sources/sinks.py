"""Table sinks (S7, S11-S13, S17) and the physical layout writer.

All writers are plain DataFrame writers into a directory the caller names; on a
cluster that is a shared file system or object store (for scratch output, use
``reelframe.session.checkpoint_root``).  Writes are idempotent per directory
(``overwrite``) or additive.  A plain ``append`` that is run again adds its rows again;
``append_batch`` names its batch and replaces that batch only, so it repeats cleanly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelframe.schema import LOAD_ORDER, SCHEMAS


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def append_table(df: DataFrame, root: str, table: str) -> None:
    """Append rows to a table directory (an empty frame writes no data files)."""
    df.write.mode("append").parquet(table_path(root, table))


BATCH = "batch_id"


def append_batch(df: DataFrame, root: str, table: str, batch_id: str) -> None:
    """Append the rows of one named batch.  The batch is a directory of its own, and
    only that directory is overwritten: the same batch twice leaves one copy, and other
    batches stay.  An empty batch that was written before keeps its rows."""
    (df.withColumn(BATCH, F.lit(batch_id)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(BATCH).parquet(table_path(root, table)))


def overwrite_table(df: DataFrame, root: str, table: str,
                    partition_by: Sequence[str] | None = None) -> None:
    """Replace a table (or the nested collection) with ``df``."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(table_path(root, table))


def create_tables(spark: SparkSession, root: str, tables: Sequence[str] | None = None,
                  schemas: dict[str, T.StructType] | None = None) -> None:
    """(re)create empty tables with their declared schemas."""
    for table in tables or LOAD_ORDER:
        schema = (schemas or SCHEMAS)[table]
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(table_path(root, table))


def empty_tables(spark: SparkSession, root: str, tables: Sequence[str] | None = None) -> None:
    """Empty every table, children first, keeping each table's schema."""
    for table in reversed(list(tables or LOAD_ORDER)):
        path = table_path(root, table)
        current = spark.read.parquet(path)
        spark.createDataFrame([], current.schema).write.mode("overwrite").parquet(path)


def write_layout(df: DataFrame, path: str, sort_by: Sequence[str] | None = None,
                 partition_by: Sequence[str] | None = None, num_files: int | None = None,
                 bloom: dict[str, int] | None = None) -> None:
    """The re-aimed index set.  Range-partition and sort on the looked-up
    columns so Parquet min/max statistics let point and range filters skip row
    groups (title lookup, year range, rating order); optionally partition
    directories by a low-cardinality column (e.g. decade).

    ``bloom`` (column -> distinct values expected in a file) adds a Bloom filter to those
    columns: an equality filter then skips the row groups that cannot hold the value,
    however the rows are sorted.  A column with few values is dictionary-encoded, and
    its dictionary serves the same purpose."""
    out = df
    if sort_by:
        out = (out.repartitionByRange(num_files, *sort_by) if num_files
               else out.repartitionByRange(*sort_by)).sortWithinPartitions(*sort_by)
    writer = out.write.mode("overwrite")
    for column, distinct in (bloom or {}).items():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{column}", str(distinct)))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_bucketed(df: DataFrame, table_name: str, key: str, buckets: int, path: str) -> None:
    """Bucket + sort a table on its join key so equi-joins between tables
    bucketed the same way skip the shuffle."""
    (df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table_name))

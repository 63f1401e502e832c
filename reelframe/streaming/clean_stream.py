"""The load step as an incremental job: cleaning rules on a stream of CSV files.

New raw files dropped into a folder are read with a fixed text schema, typed
like the batch ingest, tagged with the first failed rule, and appended to a
Parquet table partitioned by ``status`` (``valid`` / ``rejected``).  The file
sink and the checkpoint in the shared folder make the job exactly-once and
restartable after a lost executor or driver.

Only the stateless row rules run here, so no row is lost and no state is kept;
duplicate keys and duplicate rows need the whole table and stay a batch check
(``operators.cleaning.clean_table``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from reelframe.operators.cleaning import REASON, UNPARSABLE, reject_reason
from reelframe.sources.csv_ingest import apply_schema


def read_stream(spark: SparkSession, folder: str, columns: Sequence[str], table: str,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Typed streaming frame over the CSV files of ``folder`` (columns in file order)."""
    text = T.StructType([T.StructField(c, T.StringType(), True) for c in columns])
    reader = (spark.readStream.schema(text).option("header", True).option("escape", '"')
              .option("enforceSchema", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return apply_schema(reader.csv(folder), table)


def tag(table: str, df: DataFrame) -> DataFrame:
    tagged = df.withColumn(REASON, reject_reason(table, df.columns)).drop(UNPARSABLE)
    return tagged.withColumn("status", F.when(F.col(REASON).isNull(), F.lit("valid"))
                             .otherwise(F.lit("rejected")))


def start(spark: SparkSession, folder: str, columns: Sequence[str], table: str, out_path: str,
          checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Start the cleaning stream; ``available_now`` processes what is there and stops."""
    writer = (tag(table, read_stream(spark, folder, columns, table)).writeStream
              .format("parquet").option("path", out_path).option("checkpointLocation", checkpoint)
              .partitionBy("status").outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def valid_rows(spark: SparkSession, out_path: str) -> DataFrame:
    """The valid side of the streamed table (partition-pruned read)."""
    return spark.read.parquet(out_path).filter(F.col("status") == "valid").drop("status", REASON)


def rejected_rows(spark: SparkSession, out_path: str) -> DataFrame:
    return spark.read.parquet(out_path).filter(F.col("status") == "rejected").drop("status")

"""CSV catalog ingest (S1-S6, S8): scan, header normalisation, rename, typing.

Raw exports carry tuple-style headers (``"('mid',)"``) and doubled quotes
inside fields.  The reader never infers types: every column is read as text,
headers are normalised and mapped to the schema's names (metadata only), then
cast to the declared type with ``try_cast``.  Whole numbers written as ``1999.0``
are kept.  Missing-value texts become null; a text that is neither missing nor of
its type is null too, and names its column in ``unparsable``, which the cleaning
rules turn into a reason of its own instead of failing the load.
"""

from __future__ import annotations

import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelframe.functions import header_clean
from reelframe.operators.cleaning import UNPARSABLE
from reelframe.schema import COLUMN_MAP, LOAD_ORDER, SCHEMAS

# Texts read as missing by default (fixed values, those of pandas.read_csv).
DEFAULT_NA_VALUES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """One CSV file or directory, header on, every column as text."""
    return (spark.read.option("header", True).option("escape", '"').option("multiLine", False)
            .option("inferSchema", False).csv(path))


def normalise_headers(df: DataFrame) -> DataFrame:
    """S3 + S4: ``"('primaryName',)"`` -> ``primaryName`` -> ``name``; unmapped names kept."""
    cleaned = [header_clean(c) for c in df.columns]
    return df.toDF(*[COLUMN_MAP.get(c, c) for c in cleaned])


def typed(col: Column, data_type: T.DataType) -> Column:
    """Text to a declared type, null if it is not of that type.  Integers may be
    written as doubles without a fraction; NaN is null."""
    if isinstance(data_type, T.StringType):
        return col
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        value = col.try_cast(data_type)
        return F.when(~F.isnan(value), value)
    number = col.try_cast("decimal(38,10)")
    return F.coalesce(col.try_cast(data_type), F.when(number == F.floor(number), F.floor(number).try_cast(data_type)))


def apply_schema(df: DataFrame, table: str, na_values: list[str] | None = None) -> DataFrame:
    """S5 + S6: missing-value texts to null, text columns to the declared types
    (tolerant), columns absent from the file stay absent.  ``unparsable`` names the
    first column whose text is no value of its type (null: none)."""
    schema = SCHEMAS[table]
    missing = DEFAULT_NA_VALUES if na_values is None else na_values
    out, bad = [], []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        col = F.when(~F.col(f.name).isin(missing), F.col(f.name)) if missing else F.col(f.name)
        value = typed(col, f.dataType)
        if not isinstance(f.dataType, T.StringType):
            bad.append(F.when(col.isNotNull() & value.isNull(), F.lit(f.name)))
        out.append(value.alias(f.name))
    extra = [c for c in df.columns if c not in schema.fieldNames()]
    return df.select(*out, *extra, (F.coalesce(*bad) if bad else F.lit(None).cast("string")).alias(UNPARSABLE))


def read_table_csv(spark: SparkSession, path: str, table: str,
                   na_values: list[str] | None = None) -> DataFrame:
    return apply_schema(normalise_headers(read_csv_text(spark, path)), table, na_values)


def read_catalog_csv(spark: SparkSession, csv_dir: str, tables: list[str] | None = None,
                     na_values: list[str] | None = None) -> dict[str, DataFrame]:
    """The catalog tables in parent-first order; a missing file is a warning, a
    file without rows an empty table."""
    out: dict[str, DataFrame] = {}
    for table in tables or LOAD_ORDER:
        path = f"{csv_dir.rstrip('/')}/{table}.csv"
        try:
            text = read_csv_text(spark, path)
        except AnalysisException as e:
            if "UNABLE_TO_INFER_SCHEMA" in str(e):  # no file holds even a header
                names = SCHEMAS[table].fieldNames()
                text = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in names]))
            else:
                warnings.warn(f"{table}: {path} not found, table skipped", stacklevel=2)
                continue
        if not text.columns:
            text = text.select(*[F.lit(None).cast("string").alias(n) for n in SCHEMAS[table].fieldNames()])
        out[table] = apply_schema(normalise_headers(text), table, na_values)
    return out


def file_inventory(spark: SparkSession, csv_dir: str, pattern: str = "*.csv") -> DataFrame:
    """File name, table name and size in KB, without reading contents.  The table
    is the lower-cased stem of the first name below ``csv_dir`` (a file, or a folder
    that a writer filled with part files)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", pattern)
             .option("recursiveFileLookup", True).load(csv_dir).select("path", "length"))
    name = F.element_at(F.split("path", "/"), -1)
    root = csv_dir.rstrip("/").split("/")[-1]
    top = F.split_part(F.substring_index("path", f"/{root}/", -1), F.lit("/"), F.lit(1))
    return files.select(name.alias("file_name"),
                        F.lower(F.regexp_replace(top, r"\.[^.]*$", "")).alias("table_name"),
                        (F.col("length") / 1024.0).alias("size_kb"))


def export_csv(df: DataFrame, path: str, headers: dict[str, str] | None = None) -> None:
    """Write ``df`` as CSV with tuple-style headers (the raw export format)."""
    inverse = {v: k for k, v in COLUMN_MAP.items()}
    names = [(headers or {}).get(c, f"('{inverse.get(c, c)}',)") for c in df.columns]
    (df.toDF(*names).write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("quoteAll", False).csv(path))

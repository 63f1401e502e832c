"""Type inference for text columns without a declared schema.

Every value takes a step of a lattice

    missing < boolean, integer < big < decimal < double < text

(big: whole numbers beyond 64 bits; boolean and number meet in text).  One
aggregate over all columns counts the values of each step and keeps one of them as a
witness and the widest digits.  Counts add, witnesses and widths take the least
and the largest, so the states of batches merge into the state of the whole, and a
column's type follows from its state alone: the narrowest type that holds every value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelframe.schema import SCHEMAS
from reelframe.sources.csv_ingest import DEFAULT_NA_VALUES, apply_schema, normalise_headers, typed
from reelframe.sources.csv_records import find_csv, read_quoted_csv

STEPS = ("missing", "boolean", "integer", "big", "decimal", "double", "text")

# How a value is written (fixed patterns; blanks around numbers do not matter).
BOOLEAN = r"^(True|TRUE|true|False|FALSE|false)$"
WHOLE = r"^[ \t]*[+-]?[0-9]+[ \t]*$"
FIXED = r"^[ \t]*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[ \t]*$"
FLOATING = r"^[ \t]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|[iI][nN][fF]([iI][nN][iI][tT][yY])?)[ \t]*$"
MOST_DIGITS = 38
_TYPES = {"bigint": T.LongType(), "double": T.DoubleType()}


def _digits(value: Column) -> tuple[Column, Column]:
    """Digits before (without leading zeros) and after the point."""
    before = F.regexp_extract(value, r"^[ \t]*[+-]?0*([0-9]*)", 1)
    after = F.regexp_extract(value, r"\.([0-9]*)", 1)
    return F.length(before), F.length(after)


def value_step(value: Column, na_values: Sequence[str]) -> Column:
    whole, scale = _digits(value)
    missing = value.isNull() | value.isin(list(na_values)) if na_values else value.isNull()
    return (F.when(missing, "missing").when(value.rlike(BOOLEAN), "boolean")
            .when(value.rlike(WHOLE), F.when(value.try_cast("bigint").isNotNull(), "integer").otherwise("big"))
            .when(value.rlike(FIXED) & (whole + scale <= MOST_DIGITS), "decimal")
            .when(value.rlike(FLOATING), "double").otherwise("text"))


def type_state(df: DataFrame, na_values: Sequence[str] | None = None) -> DataFrame:
    """(position, column_name, step, n, witness, whole, scale) of a frame of text
    columns: one scan, one aggregate with few groups."""
    na = DEFAULT_NA_VALUES if na_values is None else na_values
    cells = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column_name"), F.col(f"`{c}`").alias("value"))
                      for i, c in enumerate(df.columns)])
    v = df.select(F.inline(cells)).withColumn("step", value_step(F.col("value"), na))
    whole, scale = _digits(F.col("value"))
    number = F.col("step").isin("integer", "big", "decimal", "double")
    return v.groupBy("position", "column_name", "step").agg(
        F.count(F.lit(1)).alias("n"), F.min("value").alias("witness"),
        F.coalesce(F.max(F.when(number, whole)), F.lit(0)).alias("whole"),
        F.coalesce(F.max(F.when(number, scale)), F.lit(0)).alias("scale"))


def merge_states(states: Sequence[DataFrame]) -> DataFrame:
    """State of the rows of all ``states`` (columns of one name and place)."""
    both = states[0]
    for s in states[1:]:
        both = both.unionByName(s)
    return both.groupBy("position", "column_name", "step").agg(
        F.sum("n").alias("n"), F.min("witness").alias("witness"), F.max("whole").alias("whole"),
        F.max("scale").alias("scale"))


def column_types(state: DataFrame) -> DataFrame:
    """(position, column_name, n_rows, n_missing, step, spark_type, pandas_type, witness).

    ``step`` is the join of the column's steps and ``witness`` a value that forces it.
    ``spark_type`` is the narrowest type of Spark's; ``pandas_type`` the one that
    ``pandas.read_csv`` gives (whole numbers with gaps are float64, booleans with gaps,
    whole numbers beyond 64 bits and numbers of over 20 digits before the point object)."""
    n = {s: F.coalesce(F.sum(F.when(F.col("step") == s, F.col("n"))), F.lit(0)).alias(f"n_{s}") for s in STEPS}
    seen = {s: F.min(F.when(F.col("step") == s, F.col("witness"))).alias(f"w_{s}") for s in STEPS}
    c = state.groupBy("position", "column_name").agg(
        F.sum("n").alias("n_rows"), *n.values(), *seen.values(), F.max("whole").alias("whole"), F.max("scale").alias("scale"))
    has = {s: F.col(f"n_{s}") > 0 for s in STEPS}
    numbers = has["integer"] | has["big"] | has["decimal"] | has["double"]
    fraction = has["decimal"] | has["double"]
    step = (F.when(has["text"] | (has["boolean"] & numbers), "text").when(has["boolean"], "boolean")
            .when(has["double"], "double").when(has["decimal"], "decimal").when(has["big"], "big")
            .when(has["integer"], "integer").otherwise("missing"))
    c = c.withColumn("joined", step)
    width = F.greatest(F.col("whole") + F.col("scale"), F.lit(1))
    exact = F.when(width <= MOST_DIGITS, F.concat(F.lit("decimal("), width.cast("string"), F.lit(","),
                                                  F.col("scale").cast("string"), F.lit(")"))).otherwise("double")
    spark_type = (F.when(F.col("joined") == "boolean", "boolean").when(F.col("joined") == "integer", "bigint")
                  .when(F.col("joined").isin("big", "decimal"), exact)
                  .when(F.col("joined").isin("double", "missing"), "double").otherwise("string"))
    pandas_type = (F.when(F.col("joined") == "boolean", F.when(has["missing"], "object").otherwise("bool"))
                   .when(F.col("joined") == "integer", F.when(has["missing"], "float64").otherwise("int64"))
                   .when(fraction & (F.col("joined") != "text"), F.when(F.col("whole") <= 20, "float64").otherwise("object"))
                   .when(F.col("joined") == "missing", "float64").otherwise("object"))
    # booleans among numbers are text without a value that alone is
    witness = F.coalesce(*[F.when(F.col("joined") == s, F.col(f"w_{s}")) for s in STEPS], F.col("w_boolean"))
    return c.select("position", "column_name", "n_rows", "n_missing", F.col("joined").alias("step"),
                    spark_type.alias("spark_type"), pandas_type.alias("pandas_type"), witness.alias("witness"))


def infer_types(df: DataFrame, na_values: Sequence[str] | None = None) -> dict[str, str]:
    """Column -> Spark type.  Runs one job; the driver gets a row per column.  A
    frame without rows has text columns."""
    found = column_types(type_state(df, na_values)).select("column_name", "spark_type").toLocalIterator()
    types = {r.column_name: r.spark_type for r in found}
    return {c: types.get(c, "string") for c in df.columns}


def apply_types(df: DataFrame, types: dict[str, str], na_values: Sequence[str] | None = None) -> DataFrame:
    """Missing-value texts to null, the rest to ``types``."""
    na = DEFAULT_NA_VALUES if na_values is None else list(na_values)
    out = []
    for c in df.columns:
        value = F.when(~F.col(f"`{c}`").isin(na), F.col(f"`{c}`")) if na else F.col(f"`{c}`")
        kind = types.get(c, "string")
        if kind.startswith(("decimal", "boolean")):
            out.append(value.try_cast(kind).alias(c))
        elif kind == "string":
            out.append(value.alias(c))
        else:
            out.append(typed(value, _TYPES[kind]).alias(c))
    return df.select(*out)


def infer_schema(df: DataFrame, na_values: Sequence[str] | None = None) -> DataFrame:
    """A frame of text columns with the types its values have."""
    named = normalise_headers(df)
    return apply_types(named, infer_types(named, na_values), na_values)


def read_inferred_csv(spark: SparkSession, path: str | list[str], na_values: Sequence[str] | None = None) -> DataFrame:
    """S1 + S3 + S4 + S5 for a file that no schema declares."""
    return infer_schema(read_quoted_csv(spark, path), na_values)


def read_directory(spark: SparkSession, folder: str, pattern: str = "*.csv",
                   na_values: list[str] | None = None) -> dict[str, DataFrame]:
    """Every table of a folder, catalog tables by their schema (with
    ``unparsable``), others by the types their values have."""
    out = {}
    for name, paths in find_csv(spark, folder, pattern).items():
        text = read_quoted_csv(spark, paths)
        out[name] = (apply_schema(normalise_headers(text), name, na_values) if name in SCHEMAS
                     else infer_schema(text, na_values))
    return out

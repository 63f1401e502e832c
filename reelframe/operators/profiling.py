"""Column profiling (D1-D3, A20-A23) and table counts.

The column profile is one unpivot of every table into (table, column, value),
counted per value; totals, missing, empty and distinct values all follow from
those counts (``exact=False`` uses ``approx_count_distinct``: one aggregate with
bounded memory).

Quantiles are exact at every size.  Values are counted per distinct value; an
approximate histogram only says where to cut them into buckets of about equal
size, bucket totals give the bucket of every wanted rank, and inside those
buckets the running count finds the value.  No task sees more than one bucket.
``exact=False`` uses ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelframe.functions import pct
from reelframe.functions.exprs import rank_of

STD_DECIMALS = 6  # moments are accumulated differently across engines; last bits differ
BUCKET_BITS = 10
BUCKETS = 1 << BUCKET_BITS  # per column; they steer balance only, never the result
APPROX_ACCURACY = 1_000_000
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table plus a grand-total row."""
    counts = _union([df.agg(F.count(F.lit(1)).alias("row_count"))
                     .select(F.lit(name).alias("table_name"), "row_count")
                     for name, df in tables.items()])
    total = counts.agg(F.sum("row_count").cast("bigint").alias("row_count")) \
        .select(F.lit("TOTAL").alias("table_name"), "row_count")
    return counts.unionByName(total)


def dataset_summary(tables: dict[str, DataFrame], storage: DataFrame | None = None) -> DataFrame:
    """Rows and columns per table, plus a total row.  ``storage`` (rows of
    ``transfer.storage_stats``) adds the stored size in MB and its total."""
    per_table = _union([df.agg(F.count(F.lit(1)).alias("rows"))
                        .select(F.lit(name).alias("table_name"), "rows",
                                F.lit(len(df.columns)).cast("bigint").alias("columns"))
                        for name, df in tables.items()])
    sums = [F.sum(c).cast("bigint").alias(c) for c in ("rows", "columns")]
    if storage is not None:
        per_table = per_table.join(storage.select("table_name", "size_mb"), "table_name", "left")
        sums.append(F.sum("size_mb").alias("size_mb"))
    total = per_table.agg(*sums).select(F.lit("TOTAL").alias("table_name"), *per_table.columns[1:])
    return per_table.unionByName(total)


def profile_tables(tables: dict[str, DataFrame], exact: bool = True) -> DataFrame:
    """One row per column — type, rows, missing, empty strings, distinct values
    (nulls excluded), each with its percentage of the rows.  Every table is scanned
    once; a table without rows still has a row per column."""
    parts = []
    for name, df in tables.items():
        fields = df.schema.fields
        long = (df.select(*[F.col(f.name).cast("string").alias(f.name) for f in fields])
                .unpivot([], [f.name for f in fields], "column_name", "value")
                .select(F.lit(name).alias("table_name"), "column_name", "value", F.lit(1).alias("n")))
        frame = df.sparkSession.range(1).select(F.inline(F.array(*[
            F.struct(F.lit(name).alias("table_name"), F.lit(f.name).alias("column_name"),
                     F.lit(None).cast("string").alias("value"), F.lit(0).alias("n")) for f in fields])))
        parts.append(long.unionByName(frame))
    cells = _union(parts)
    present = F.col("value").isNotNull()
    if exact:
        cells = cells.groupBy("table_name", "column_name", "value").agg(F.sum("n").alias("n"))
        unique = F.count_if(present & (F.col("n") > 0))
    else:
        unique = F.approx_count_distinct("value")
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("bigint")
    per_col = cells.groupBy("table_name", "column_name").agg(
        F.sum("n").cast("bigint").alias("total_rows"), total(~present).alias("missing"),
        total(F.col("value") == "").alias("empty"), unique.cast("bigint").alias("unique_values"))
    types = F.create_map(*[x for name, df in tables.items() for f in df.schema.fields
                           for x in (F.lit(f"{name}.{f.name}"), F.lit(f.dataType.simpleString()))])
    return per_col.select(
        "table_name", "column_name",
        F.element_at(types, F.concat_ws(".", "table_name", "column_name")).alias("dtype"), "total_rows",
        "missing", pct("missing", "total_rows").alias("missing_pct"),
        "empty", pct("empty", "total_rows").alias("empty_pct"),
        "unique_values", pct("unique_values", "total_rows").alias("unique_pct"))


def profile_columns(name: str, df: DataFrame, exact: bool = True) -> DataFrame:
    return profile_tables({name: df}, exact)


def exact_quantiles(values: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """(*keys, q: array of double) — linearly interpolated quantiles of ``value`` per
    (non-null) key, nulls and NaN left out."""
    # adaptive execution merges partitions by compressed bytes; a hash beside the value does
    # not compress, so that these bytes bound the number of values a task holds
    counts = (values.where(F.col("value").isNotNull() & ~F.isnan("value"))
              .groupBy(*keys, "value", F.xxhash64("value").alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
              .drop("_hash"))
    steps = F.lit([i / BUCKETS for i in range(1, BUCKETS)])
    # the filter makes this read the same counts as the steps below, which share one exchange
    cuts = counts.where("n > 0").groupBy(*keys).agg(F.percentile_approx("value", steps, 10 * BUCKETS).alias("cuts"))
    # one row per key: bounded; the bucket is the number of cuts at or below the value
    placed = counts.join(F.broadcast(cuts), keys)
    placed = placed.select(*keys, "value", "n", rank_of(F.col("value"), F.col("cuts"), BUCKET_BITS).alias("bucket"))
    by_bucket = placed.groupBy(*keys, "bucket").agg(F.sum("n").alias("held"))
    upto = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    by_bucket = (by_bucket.withColumn("before", F.coalesce(F.sum("held").over(upto), F.lit(0)))
                 .withColumn("total", F.sum("held").over(whole)))
    # the two neighbouring ranks of every wanted position
    wanted = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p")) for i, p in enumerate(probs)])
    asked = by_bucket.select("*", F.inline(wanted)).withColumn("at", F.col("p") * (F.col("total") - 1))
    asked = asked.select("*", F.explode(F.array(F.floor("at"), F.ceil("at"))).alias("rank")).where(
        (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("held"))).distinct()
    chosen = asked.groupBy(*keys, "bucket").agg(F.first("before").alias("before"), F.collect_list(
        F.struct("i", "at", "rank")).alias("ranks"))  # at most two ranks for each probability
    inside = placed.join(F.broadcast(chosen), [*keys, "bucket"])
    running = Window.partitionBy(*keys, "bucket").orderBy("value")
    inside = inside.withColumn("stop", F.col("before") + F.sum("n").over(running))
    hits = inside.select(*keys, "value", "stop", "n", F.inline("ranks")).where(
        (F.col("rank") < F.col("stop")) & (F.col("rank") >= F.col("stop") - F.col("n")))
    pair = hits.groupBy(*keys, "i", "at").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    value = (F.when(F.col("low") == F.col("high"), F.col("low"))
             .otherwise((F.ceil("at") - F.col("at")) * F.col("low") + (F.col("at") - F.floor("at")) * F.col("high")))
    ordered = F.sort_array(F.collect_list(F.struct("i", value.alias("v"))))
    return pair.groupBy(*keys).agg(F.transform(ordered, lambda x: x.v).alias("q"))


def approx_quantiles(values: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    p = F.array(*[F.lit(float(q)) for q in probs])
    return values.where(F.col("value").isNotNull()).groupBy(*keys).agg(
        F.percentile_approx("value", p, APPROX_ACCURACY).alias("q"))


def quantiles(values: DataFrame, keys: list[str], probs: list[float], exact: bool = True) -> DataFrame:
    return (exact_quantiles if exact else approx_quantiles)(values, keys, probs)


def _numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def describe_tables(tables: dict[str, DataFrame], exact: bool = True,
                    columns: dict[str, list[str]] | None = None) -> DataFrame:
    """Count, mean, sample std, min, 25/50/75 % (linear interpolation), max
    for each numeric column, as doubles."""
    numeric = {n: (columns or {}).get(n) or _numeric_columns(df) for n, df in tables.items()}
    numeric = {n: cols for n, cols in numeric.items() if cols}
    stats, long, labels = [], [], []
    for name, cols in numeric.items():
        x = {c: F.col(c).cast("double") for c in cols}
        stats.append(tables[name].agg(F.array(*[F.struct(
            F.lit(c).alias("column_name"), F.count(c).alias("count"), F.avg(x[c]).alias("mean"),
            F.round(F.stddev_samp(x[c]), STD_DECIMALS).alias("std"), F.min(x[c]).alias("min"),
            F.max(x[c]).alias("max")) for c in cols]).alias("s"))
            .select(F.lit(name).alias("table_name"), F.inline("s")))
        # a number per column is a smaller key than two names
        first = len(labels)
        labels += [(name, c) for c in cols]
        long.append(tables[name].select(F.inline(F.array(*[
            F.struct(F.lit(first + i).alias("_column"), x[c].alias("value")) for i, c in enumerate(cols)]))))
    keys = ["table_name", "column_name"]
    q = quantiles(_union(long), ["_column"], [0.25, 0.5, 0.75], exact)
    named = F.get(F.array(*[F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name")) for t, c in labels]),
                  F.col("_column"))
    q = q.select(named.alias("_named"), "q").select("_named.*", "q")
    return (_union(stats).join(q, keys, "left")
            .select(*keys, "count", "mean", "std", "min", F.col("q")[0].alias("p25"),
                    F.col("q")[1].alias("p50"), F.col("q")[2].alias("p75"), "max"))


def describe(name: str, df: DataFrame, columns: list[str] | None = None, exact: bool = True) -> DataFrame:
    return describe_tables({name: df}, exact, {name: columns} if columns else None)

"""Helpers shared by the training-data operators."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.session import scratch_folder

# Words of the contracts: maximal runs of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


_scopes: list[list[str]] = []  # folders written by the settle() calls in progress


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder under the session's shared checkpoint folder; the enclosing
    ``settle`` removes it, else the end of the driver does."""
    path = scratch_folder(spark, f"llm-{name}")
    if _scopes:
        _scopes[-1].append(path)
    return path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a cut of the lineage
    that survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settle(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """``stored(build())``, then the tables that ``build`` wrote on its way are removed."""
    path = scratch(spark, name)
    _scopes.append([])
    try:
        df = build()
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    finally:
        for used in _scopes.pop():
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(used)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BROADCAST_ROWS = 100_000  # narrow rows, or elements of their arrays: a few MB


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", elements: str | None = None) -> DataFrame:
    """Join that broadcasts ``small`` only if its counted rows (or the ``elements`` of
    an array column) are few, and shuffles both sides otherwise."""
    n = small.count() if elements is None else small.agg(F.sum(F.size(elements))).first()[0] or 0
    return big.join(F.broadcast(small) if n <= BROADCAST_ROWS else small, on, how)


def digest_pair(*cols: Column | str) -> list[Column]:
    """A 128-bit key of the given values as two longs (nulls are skipped by the
    hash, so pass an ``isNull`` flag where null and empty must differ)."""
    return [F.xxhash64(F.lit(seed), *cols).alias(name) for seed, name in ((11, "k1"), (29, "k2"))]


def row_digest(df: DataFrame) -> list[Column]:
    """Key of the document itself: id and whole text, null-safe."""
    return digest_pair(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Stream the runs of equal (non-null integer) keys of sorted batches; only
    the run in progress is held."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        k = np.stack([np.asarray(t.column(c).to_numpy()) for c in keys], axis=1)
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if held and (k[0] != last).any():
            yield pa.concat_tables(held)
            held = []
        start = 0
        for cut in cuts:
            held.append(t.slice(start, cut - start))
            yield pa.concat_tables(held)
            held, start = [], cut
        held.append(t.slice(start))
        last = k[-1]
    if held:
        yield pa.concat_tables(held)


def per_worker(key: str, make: Callable[[], Any]) -> Any:
    """An object kept for the life of a Python worker (tasks of a worker share it;
    functions and their globals are shipped anew with each stage).  One at a time:
    a worker that moves on to another stage gives up what the last one kept."""
    kept = sys.modules.setdefault("_reelframe_worker", types.ModuleType("_reelframe_worker"))
    if vars(kept).get("key") != key:
        kept.key = kept.value = None
        kept.value = make()
        kept.key = key
    return kept.value

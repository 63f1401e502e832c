"""Embedding near-duplicates: random-hyperplane sign hashing in several tables,
exact cosine verification, distributed connected components.

Equal vectors are one class first.  A table of the hash puts classes whose signs
agree on ``bits`` hyperplanes into one bucket.  Buckets are cut into blocks of at
most about ``block`` classes and compared block by block, so no task holds a
whole bucket and no pair is emitted: a task counts, for each class, the links it
sees (a pair met in several tables counts in the first one only) and returns a
spanning set of links for the components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import digest_pair, runs, settle, stored, table
from reelframe.llm.components import connected_components

THRESHOLD = 0.95
MISS = 0.002  # probability that two vectors at the threshold share no bucket
PER_BUCKET = 16
BLOCK = 512
SEED = 20240229


def hash_size(classes: int, threshold: float = THRESHOLD) -> tuple[int, int]:
    """(tables, bits) for so many different vectors: about ``PER_BUCKET`` of them to a bucket,
    and as many tables as keep the chance of missing a pair at the threshold at ``MISS``."""
    bits = max(8, math.ceil(math.log2(max(classes / PER_BUCKET, 1))))
    agree = (1 - math.acos(min(threshold, 1.0)) / math.pi) ** bits
    return max(1, math.ceil(math.log(MISS) / math.log1p(-agree))) if agree < 1 else 1, bits


def scaled(v: np.ndarray) -> np.ndarray:
    """``v`` by the power of two that brings its largest entry near one: exact, and
    squares neither overflow nor vanish."""
    return np.ldexp(v, -np.frexp(np.abs(v).max())[1])


def planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng(SEED + dim).standard_normal((dim, tables * bits))


def _signer(tables: int, bits: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weigh = 1 << np.arange(bits, dtype=np.int64)
        by_dim: dict[int, np.ndarray] = {}
        for batch in batches:
            vectors = [scaled(np.asarray(x.as_py(), np.float64)) for x in batch.column(2)]
            sigs = np.zeros((len(vectors), tables), np.int64)
            dims = np.array([len(v) for v in vectors])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                h = by_dim.setdefault(int(dim), planes(int(dim), tables, bits))
                signs = (np.stack([vectors[i] for i in at]) @ h > 0).reshape(len(at), tables, bits)
                sigs[at] = signs @ weigh
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([v.tobytes() for v in vectors], pa.binary()),
                 batch.column(3), batch.column(4),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * tables),
                                          pa.array(sigs.ravel()))],
                names=["k1", "k2", "vector", "rep", "size", "sigs"])
    return sign


def _labels(n: int, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Smallest index reachable by the links p-q."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[p], label[q])
        np.minimum.at(label, p, low)
        np.minimum.at(label, q, low)
        label = label[label]
        if (label == before).all():
            return label


def _comparer(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches, ["tab", "sig", "dim", "left", "right"]):
            left, right, tab = (run.column(c)[0].as_py() for c in ("left", "right", "tab"))
            block = run.column("block").to_numpy()
            rep, size = run.column("rep").to_numpy(), run.column("size").to_numpy()
            x = np.stack([np.frombuffer(v.as_py(), np.float64) for v in run.column("vector")])
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            sigs = np.stack([np.asarray(s.as_py(), np.int64) for s in run.column("sigs")])
            rows = np.flatnonzero(block == left)
            cols = np.flatnonzero(block == right)
            links = np.zeros(len(rep), np.int64)
            ps, qs = [], []
            for at in range(0, len(rows), 128):
                part = rows[at:at + 128]
                i, j = np.nonzero(x[part] @ x[cols].T >= threshold)
                p, q = part[i], cols[j]
                if left == right:
                    p, q = p[p < q], q[p < q]
                first = (sigs[p] == sigs[q]).argmax(axis=1) == tab
                p, q = p[first], q[first]
                np.add.at(links, p, size[q])
                np.add.at(links, q, size[p])
                ps.append(p)
                qs.append(q)
            p, q = np.concatenate(ps), np.concatenate(qs)
            if not len(p):
                continue
            near = _labels(len(rep), p, q)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [run.column("k1").combine_chunks().take(pa.array(hit)),
                 run.column("k2").combine_chunks().take(pa.array(hit)),
                 pa.array(rep[hit]), pa.array(links[hit]), pa.array(rep[near[hit]])],
                names=["k1", "k2", "rep", "links", "near"])
    return compare


def link_embeddings(vectors: DataFrame, threshold: float = THRESHOLD, tables: int | None = None,
                    bits: int | None = None, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id) per row of (vec_id, embedding).

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, link with nothing.  Equal vectors are linked; repeated
    rows count as separate vectors; rows that share an id share its component.
    Vectors of different length are never compared.  Other columns are ignored.
    ``tables`` and ``bits`` follow from the number of different vectors unless given.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("e"))
    return settle(vectors.sparkSession, "embedding-links", lambda: _links(v, threshold, tables, bits, block))


def _links(v: DataFrame, threshold: float, tables: int | None, bits: int | None, block: int) -> DataFrame:
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = (F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False))
          & F.coalesce(F.exists("e", lambda x: x != 0), F.lit(False)))
    good = v.where(ok).select("vec_id", "e", *digest_pair(F.size("e"), "e"))
    classes = good.groupBy("k1", "k2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("size"),
                                           F.first("e").alias("e"))
    classes = stored(classes, "classes")
    most_tables, most_bits = hash_size(classes.count(), threshold)
    tables, bits = tables or most_tables, bits or most_bits
    signed = stored(classes.select("k1", "k2", "e", "rep", "size").mapInArrow(
        _signer(tables, bits),
        "k1 long, k2 long, vector binary, rep long, size long, sigs array<bigint>"), "signs")
    spread = signed.select("k1", "k2", F.octet_length("vector").alias("dim"), F.posexplode("sigs").alias("tab", "sig"))
    full = (spread.groupBy("dim", "tab", "sig").count().where("count > 1")
            .withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count"))
    placed = spread.join(full, ["dim", "tab", "sig"])
    placed = placed.withColumn("block", F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    placed = placed.select("*", other.alias("other"))
    placed = placed.select("k1", "k2", "dim", "tab", "sig", "block", F.least("block", "other").alias("left"),
                           F.greatest("block", "other").alias("right"))
    keys = ["tab", "sig", "dim", "left", "right"]
    work = placed.join(signed, ["k1", "k2"]).repartition(*keys).sortWithinPartitions(*keys)
    seen = stored(work.mapInArrow(_comparer(threshold), "k1 long, k2 long, rep long, links long, near long"),
                  "links")
    links = seen.groupBy("k1", "k2").agg(F.sum("links").alias("links"))
    # rows of one class, and of one id, belong together
    same = good.join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select(
        F.col("vec_id").alias("a"), F.col("rep").alias("b"))
    parts = connected_components(seen.select(F.col("rep").alias("a"), F.col("near").alias("b")).union(same))
    per_class = classes.select("k1", "k2", "size").join(links, ["k1", "k2"], "left").select(
        "k1", "k2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    linked = good.select("vec_id", "k1", "k2").join(per_class, ["k1", "k2"]).select("vec_id", "n_links")
    rest = v.where(~ok).select("vec_id", F.lit(0).cast("long").alias("n_links"))
    out = linked.union(rest).join(parts, F.col("vec_id") == F.col("node"), "left")
    return out.select("vec_id", "n_links", F.coalesce("component", "vec_id").alias("component_id"))


def op10_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = link_embeddings(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))

"""Mixing sources to target weights by a time-varying curriculum.

Every source has a weight schedule over training time ``x`` in [0, 1] (piecewise
linear).  Its integral, scaled to the source's token target, is the source's
cumulative demand; a document whose tokens lie at cumulative place ``c`` of its
source is trained at the ``x`` where the demand reaches ``c``.

Documents keep a fixed pseudo-random order inside their source (md5 of the id),
so reruns agree.  Prefix sums never pass a source through one task: the order is
cut into 4096 hash buckets per source, windows run inside a bucket, and only the
bucket totals (at most 4096 per source) are accumulated per source.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import WORD, row_digest, settle, stored, table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
# Weight schedules (time, weight) by position in WEIGHTS: early, steady, late sources.
SCHEDULES = (((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
             ((0.0, 1.0), (1.0, 1.0)),
             ((0.0, 0.5), (0.7, 0.8), (1.0, 2.0)))


def word_count(col: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP) -> DataFrame:
    """(source, source_size, kind, target) from per-document sizes.

    Sources ordered by code point, null last, take ``weights`` in turn.  The mix
    holds ``share`` times all sizes; a target stops at ``cap`` times its source
    and the rest is shared again by weight.  That water level follows from one
    pass over the sources sorted by cap per weight.  One row per source (not per
    document) goes through the un-partitioned windows.
    """
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    pick = F.array(*[F.lit(w) for w in weights])
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    s = by.withColumn("kind", ((rank - 1) % len(weights)).cast("int"))
    s = s.withColumn("weight", F.element_at(pick, F.col("kind") + 1))
    s = s.withColumn("most", F.col("source_size") * cap)
    order = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(W.currentRow, W.unboundedFollowing)
    whole = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumn("left", F.sum("source_size").over(whole) * F.lit(share)
                     - F.coalesce(F.sum("most").over(before), F.lit(0)))
    s = s.withColumn("level", F.col("left") / F.sum("weight").over(after))
    s = s.withColumn("free", F.col("most") >= F.col("level") * F.col("weight"))
    # the first level that leaves its own source below the cap; later ones are lower
    s = s.withColumn("water", F.max(F.when(F.col("free"), F.col("level"))).over(whole))
    target = F.least(F.col("most").cast("double"),
                     F.coalesce(F.col("water") * F.col("weight"), F.col("most").cast("double")))
    return s.select("source", "source_size", "kind", target.alias("target"))


def demand_time(c: Column, kind: Column, schedules=SCHEDULES) -> Column:
    """Invert the normalised integral of the schedule at ``c`` in [0, 1]."""
    out = F.lit(None).cast("double")
    for k, knots in enumerate(schedules):
        areas = [(x1 - x0) * (w0 + w1) / 2 for (x0, w0), (x1, w1) in zip(knots, knots[1:])]
        total, done = sum(areas), 0.0
        pieces = []
        for ((x0, w0), (x1, w1)), area in zip(zip(knots, knots[1:]), areas):
            slope = (w1 - w0) / (x1 - x0)
            a = F.greatest(c * total - done, F.lit(0.0))
            # w0*d + slope*d^2/2 = a, in the form that is stable for slope near 0
            d = 2 * a / (w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * a, F.lit(0.0))))
            done += area
            pieces.append((done / total, F.lit(x0) + d))
        time = pieces[-1][1]
        for bound, value in reversed(pieces[:-1]):
            time = F.when(c < bound, value).otherwise(time)
        out = F.when(kind == k, F.least(time, F.lit(1.0))).otherwise(out)
    return out


def mix_sources(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap=CAP, schedules=SCHEDULES,
                keys: tuple[str, ...] = ()) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, size, and ``keys`` passed through):
    source_size, target, copies, taken and the training ``positions`` of the copies
    (ascending).

    Whole documents are taken in source order, pass after pass, while they fit
    the target; one more document per source, the one whose size is nearest to
    what is left, closes the gap.  Null sizes count as 0; documents of size 0 are
    never taken; a null source is a source of its own; a null id is ordered like
    an empty one; equal rows are interchangeable.  An empty table gives no rows.
    """
    d = docs.select("doc_id", "source", F.coalesce("size", F.lit(0)).cast("long").alias("size"), *keys)
    d = d.withColumn("h", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    d = d.withColumn("bucket", F.substring("h", 1, 3))
    src = stored(source_targets(d, weights, share, cap), "mix-sources")
    buckets = d.groupBy("source", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = buckets.select("source", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0))
                             .alias("offset"))
    inside = (W.partitionBy("source", "bucket").orderBy("h", "doc_id", "size")
              .rowsBetween(W.unboundedPreceding, -1))
    d = d.withColumn("inner_start", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    d = _join(d, offsets, ["source", "bucket"])
    d = _join(d, src, ["source"])
    d = d.withColumn("start", F.col("offset") + F.col("inner_start"))
    passes = math.ceil(cap)
    fits = [F.when((F.col("size") > 0)
                   & (F.col("source_size") * e + F.col("start") + F.col("size") <= F.col("target")), 1)
            .otherwise(0) for e in range(passes)]
    d = d.withColumn("copies", sum(fits[1:], fits[0]))
    d = stored(d.drop("offset", "inner_start", "bucket"), "mix-order")
    # what is left of each source's target, and the unused copy that fits it best
    left = d.groupBy("source").agg((F.first("target") - F.sum(F.col("size") * F.col("copies"))).alias("left"),
                                   F.min(F.when(F.col("size") > 0, F.col("copies"))).alias("done"))
    free = _join(d, left, ["source"]).where((F.col("copies") == F.col("done")) & (F.col("copies") < cap)
                                            & (F.col("size") > 0) & (F.col("size") < 2 * F.col("left")))
    best = free.groupBy("source").agg(
        F.min(F.struct(F.abs(F.col("size") - F.col("left")).alias("gap"), "h", "start")).alias("best"))
    d = _join(d, best, ["source"], "left")
    extra = (F.col("best").isNotNull() & (F.col("h") == F.col("best.h"))
             & (F.col("start") == F.col("best.start")) & (F.col("size") > 0))
    d = d.withColumn("copies", F.col("copies") + F.when(extra, 1).otherwise(0))
    d = d.withColumn("taken", F.col("size") * F.col("copies"))
    place = lambda e: F.least((F.col("source_size") * e + F.col("start") + F.col("size") / 2)
                              / F.col("target"), F.lit(1.0))
    at = F.transform(F.sequence(F.lit(0), F.lit(passes - 1)),
                     lambda e: F.when(e < F.col("copies"), demand_time(place(e), F.col("kind"), schedules)))
    positions = F.when(F.col("copies") > 0, F.array_compact(at)).otherwise(F.array().cast("array<double>"))
    return d.select("doc_id", "source", "size", "source_size", "target", "copies", "taken",
                    positions.alias("positions"), "h", *keys)


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on null-safe keys, keeping the left key columns."""
    r = right.select(*[F.col(k).alias(f"r_{k}") if k in keys else F.col(k) for k in right.columns])
    on = [left[k].eqNullSafe(r[f"r_{k}"]) for k in keys]
    return left.join(r, on, how).drop(*[f"r_{k}" for k in keys])


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per taken copy, range-sorted by training position."""
    copies = mixed.select("*", F.explode("positions").alias("position"))
    return copies.repartitionByRange("position", "h").sortWithinPartitions("position", "h")


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with every document as often as the mix
    takes it, range-sorted by training position; the columns stay as they are.
    Rows equal in id and text are as many documents to the mix."""
    others = [docs[c] for c in docs.columns]
    keyed = docs.select(F.struct(*others).alias("row"), *row_digest(docs))

    def plan() -> DataFrame:
        sized = docs.select("doc_id", "source", word_count("text").alias("size"), *row_digest(docs))
        mixed = mix_sources(stored(sized, "mix-sizes"), keys=("k1", "k2"), **options).where("copies > 0")
        return mixed.groupBy("k1", "k2").agg(F.flatten(F.collect_list("positions")).alias("positions"),
                                             F.count("*").alias("rows"))

    wanted = settle(docs.sparkSession, "mix-positions", plan)
    d = keyed.join(wanted, ["k1", "k2"])
    # equal rows share one list of positions: one of them carries it
    d = d.where("rows = 1").union(d.where("rows > 1").dropDuplicates(["k1", "k2"]))
    d = d.select("row", "k1", F.explode("positions").alias("position"))
    d = d.repartitionByRange("position", "k1").sortWithinPartitions("position", "k1")
    return d.select("row.*")


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    sized = stored(docs.select("doc_id", "source", word_count("text").alias("size")), "mix-sizes")
    mixed = mix_sources(sized)
    first = F.try_element_at("positions", F.lit(1))
    out = mixed.select("doc_id", "size", "source_size", "target", "taken", first.alias("first_position"))
    out = out.repartitionByRange("first_position", "doc_id").sortWithinPartitions("first_position", "doc_id")
    return out.drop("first_position")

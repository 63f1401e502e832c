"""Document fingerprints: threshold-scaled sketches of word shingles.

A fingerprint keeps every shingle hash below a fixed fraction of the hash range
(and always the smallest one, so that short texts have a fingerprint).  Because
the bound is the same for all texts, sketches can be merged by set union and
compared between texts of very unequal length: the share of the smaller sketch
that the larger one holds estimates containment.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from reelframe.llm.common import row_digest, stored, table

SHINGLE = 5
SCALE = 3  # one shingle hash in three is kept


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")


def sketch(text: Column, shingle: int = SHINGLE, scale: int = SCALE) -> Column:
    """Ascending distinct kept hashes.  Fewer words than ``shingle``: the whole
    sequence is the one shingle; no words: an empty sketch."""
    bound = -(1 << 63) + (1 << 64) // scale
    codes = F.transform(words(text), lambda w: F.xxhash64(w))
    # a one-element transform names the word hashes once for the steps below
    hashes = F.transform(F.array(codes), lambda c: F.when(F.size(c) == 0, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.greatest(F.size(c) - shingle, F.lit(0))),
                    lambda i: F.xxhash64(*[F.get(c, i + j) for j in range(shingle)]))))  # skips words that are not there
    kept = F.transform(hashes, lambda h: F.when(F.array_min(h) >= bound, F.array(F.array_min(h)))
                       .otherwise(F.filter(h, lambda x: x < bound)))
    return F.sort_array(F.array_distinct(F.coalesce(F.element_at(kept, 1), F.array().cast("array<bigint>"))))


def render(s: Column) -> Column:
    return F.lower(F.array_join(F.transform(s, lambda h: F.lpad(F.hex(h), 16, "0")), " "))


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """Sketch of the union of two shingle sets: the hashes below the bound, or the
    smallest one if there are none."""
    bound = -(1 << 63) + (1 << 64) // scale
    both = F.sort_array(F.array_union(a, b))
    below = F.filter(both, lambda h: h < bound)
    return F.when(F.size(below) > 0, below).otherwise(F.slice(both, 1, 1))


def containment(small: Column, large: Column) -> Column:
    """Estimated share of the first text's shingles that the second one has."""
    return F.when(F.size(small) == 0, F.lit(1.0)).otherwise(
        F.size(F.array_intersect(small, large)) / F.size(small))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity; two empty sketches are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / (F.size(a) + F.size(b) - both))


def fingerprint_documents(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``docs`` with an array column ``sketch`` (replacing one of that name); a
    null text counts as empty, and equal texts have equal sketches."""
    return docs.withColumn("sketch", sketch(F.coalesce("text", F.lit("")), shingle, scale))


def next_documents(keyed: DataFrame) -> DataFrame:
    """(k1, k2, n, n1, n2) -> each document's key, length and the key of the next
    one in descending doc_id, nulls last; the last is followed by the first.

    Rows equal in id and text are one document.  Documents of equal id are
    ordered by key.  The order is cut into range partitions, windows run inside a
    partition, and only the first row of each partition meets the others.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("k1"), F.col("k2")]
    d = keyed.select("doc_id", "k1", "k2", "n").distinct()
    d = stored(d.repartitionByRange(*order).withColumn("pid", F.spark_partition_id()), "ordered")
    w = W.partitionBy("pid").orderBy(*order)
    d = d.withColumn("at", F.row_number().over(w)).withColumn("next", F.lead(F.struct("k1", "k2")).over(w))
    heads = d.where("at = 1").select("pid", F.struct("k1", "k2").alias("head"))
    cyclic = W.orderBy("pid")  # one row per partition
    follow = F.coalesce(F.lead("head").over(cyclic),
                        F.first("head").over(cyclic.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    heads = heads.select("pid", follow.alias("following"))
    d = d.join(heads, "pid").withColumn("next", F.coalesce("next", "following"))
    return d.select("k1", "k2", "n", F.col("next.k1").alias("n1"), F.col("next.k2").alias("n2"))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *row_digest(docs))
    order = stored(next_documents(keyed.withColumn("n", F.length("text"))), "next")
    before = order.select(F.col("n1").alias("k1"), F.col("n2").alias("k2"), F.col("k1").alias("p1"),
                          F.col("k2").alias("p2"), F.floor(F.col("n") / 3).cast("int").alias("take"))
    # both sides below use the same columns of this frame, so its one shuffle serves
    # both; sketches are taken behind it and only the next document's travels
    # what each document hands to the one before it: its first characters, sketch and id
    given = keyed.join(before, ["k1", "k2"]).select(
        F.col("p1").alias("k1"), F.col("p2").alias("k2"), F.expr("substring(text, 1, take)").alias("head"),
        sketch(F.col("text")).alias("next_sketch"), F.col("doc_id").alias("next_id")).dropDuplicates(["k1", "k2"])
    d = keyed.join(given, ["k1", "k2"]).withColumn("n", F.length("text"))
    cut = F.floor(F.col("n") / 3).cast("int")
    d = d.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n") - cut), "head"))
    d = d.withColumn("sketch", sketch(F.col("text"))).withColumn("edited_sketch", sketch(F.col("edited")))
    return d.select("doc_id", F.col("n").cast("long").alias("n_chars"),
                    F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
                    render(F.col("sketch")).alias("fingerprint"),
                    render(F.col("edited_sketch")).alias("edited_fingerprint"),
                    likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                    likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"), F.col("next_id"),
                    containment(F.col("sketch"), F.col("next_sketch")).alias("held_by_next"))

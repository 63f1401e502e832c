"""Sketches and bitmaps that merge, and the substring index."""

import random

import pytest
from pyspark.sql import functions as F

from reelframe import registry
from reelframe.functions import name_contains
from reelframe.functions.exprs import rank_of
from reelframe.operators import name_index, sketches


def test_merged_batches_equal_the_whole_within_the_bounds(spark):
    rnd = random.Random(6)
    rows = [(i, rnd.gauss(0, 1) if i % 9 else None, f"v{rnd.randrange(3000)}") for i in range(20_000)]
    df = spark.createDataFrame(rows, "id long, x double, s string")
    parts = [sketches.column_sketches("t", df.where(F.col("id") % 4 == i), f"b{i}") for i in range(4)]
    parts.append(sketches.column_sketches("t", df.limit(0), "empty"))
    all_parts = parts[0]
    for p in parts[1:]:
        all_parts = all_parts.union(p)
    got = {r.column_name: r for r in sketches.estimates(sketches.merge_sketches(all_parts), [0.1, 0.5, 0.9]).collect()}
    whole = {r.column_name: r for r in sketches.estimates(sketches.column_sketches("t", df)).collect()}
    values = sorted(x for _, x, _ in rows if x is not None)
    for c, distinct, missing in (("id", 20_000, 0), ("x", len(values), 20_000 - len(values)), ("s", len({r[2] for r in rows}), 0)):
        for r in (got[c], whole[c]):
            assert (r.total_rows, r.missing) == (20_000, missing)
            assert abs(r.unique_values - distinct) <= distinct * sketches.HLL_ERROR
        assert got[c].unique_values == whole[c].unique_values  # registers take the larger value: merging loses nothing
    for p, v in zip([0.1, 0.5, 0.9], got["x"].q):
        assert abs(sum(x <= v for x in values) / len(values) - p) <= sketches.RANK_ERROR
    assert got["s"].q is None
    nothing = sketches.estimates(sketches.merge_sketches(sketches.column_sketches("t", df.limit(0)))).collect()
    assert {(r.total_rows, r.missing, r.unique_values, r.q and tuple(r.q)) for r in nothing} == {(0, 0, 0, None)}


def test_bitmaps_count_ids_exactly(spark):
    ids = [-70_000, -1, 0, 0, 1, 32_767, 32_768, 32_769, 10 ** 12, 10 ** 12, None]
    parts = [sketches.bitmap_counts({"a": spark.createDataFrame([(i,) for i in part], "id long"),
                                     "b": spark.createDataFrame([(5,)], "id long")}, "id") for part in (ids[::2], ids[1::2])]
    out = sketches.distinct_ids(sketches.merge_bitmaps(parts[0].union(parts[1]))).collect()
    assert {r.name: r.ids for r in out} == {"a": 8, "b": 1}


def test_ranks_among_cuts(spark):
    cuts = [1.0, 1.0, 2.0, 5.0, 7.0, 7.5, 9.0]
    df = spark.createDataFrame([(float(v), cuts) for v in (0, 1, 1.5, 2, 6, 7, 8, 9, 10)], "v double, cuts array<double>")
    for r in df.select("v", rank_of(F.col("v"), F.col("cuts"), 3).alias("rank")).collect():
        assert r.rank == sum(c <= r.v for c in cuts)


@pytest.mark.parametrize("needle", ["ab", "abc", "ABCab", "abab", "x%y", "a_c", "%abc", "É", "éab", "zzz", "ß"])
def test_index_finds_what_the_filter_finds(spark, needle):
    rnd = random.Random(8)
    names = ["".join(rnd.choice("abcABCxyéÉß%_ ") for _ in range(rnd.randint(0, 12))) for _ in range(400)] + [None, "", "abc"] * 3
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string")
    root = registry.scratch(spark, "grams")
    name_index.write_postings(df, "id", "name", root)
    index = spark.read.parquet(root)
    found = name_index.find_names(df, index, "id", "name", needle)
    assert sorted(r.id for r in found.collect()) == sorted(r.id for r in df.where(name_contains("name", needle)).collect())
    if len(name_index.needle_grams(needle)) > 0:
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "LeftSemi" in plan


def test_postings_of_a_common_trigram_are_split(spark):
    df = spark.createDataFrame([(i, "the same name") for i in range(5000)], "id int, name string")
    rows = name_index.postings(df, "id", "name")
    parts = rows.repartitionByRange(6, "gram", "id").where("gram = 'sam'").groupBy(F.spark_partition_id()).count().collect()
    assert rows.count() == 5000 * 10 and len(parts) >= 1 and sum(r["count"] for r in parts) == 5000

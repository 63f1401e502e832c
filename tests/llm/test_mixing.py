import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from reelframe.llm import mixing as mx
from tests.llm.util import SF_MID, empty_docs, odd_docs


def water_fill(sizes, weights=(5, 2, 1), share=1.5, cap=2):
    """Brute force: stop sources at the cap and share the excess until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, rest = {}, share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in full]
        left = rest - sum(full.values())
        target = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if target[s] > cap * sizes[s]]
        if not over:
            return {**target, **full}
        full.update({s: cap * sizes[s] for s in over})


def test_targets_and_taken_words(spark):
    rows = mx.op5_mixing(spark, SF_MID).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", docs[r.doc_id].text or ""))
        sizes[docs[r.doc_id].source] += r.size
        taken[docs[r.doc_id].source] += r.taken
        assert 0 <= r.taken <= 2 * r.size
    want = water_fill(sizes)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))
    for r in rows:
        s = docs[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 0.01 * want[s] + 5
    again = {(r.doc_id, r.taken) for r in mx.op5_mixing(spark, SF_MID).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 1000}, {"a": 1, "b": 1, "c": 1000, None: 5},
                                   {"a": 5}, {"a": 0, "b": 0}, {"z": 3, "é": 900, "\U0001F600": 20, "a": 70}])
def test_water_level(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    got = {r.source: r.target for r in mx.source_targets(df).collect()}
    want = water_fill(sizes)
    assert got == {s: pytest.approx(t) for s, t in want.items()}


def test_demand_is_the_inverted_integral(spark):
    for kind, knots in enumerate(mx.SCHEDULES):
        def area(x):
            total = 0.0
            for (x0, w0), (x1, w1) in zip(knots, knots[1:]):
                h = min(max(x - x0, 0), x1 - x0)
                total += w0 * h + (w1 - w0) / (x1 - x0) * h * h / 2
            return total

        cs = [i / 50 for i in range(51)]
        rows = spark.createDataFrame([(c,) for c in cs], "c double").select(
            "c", mx.demand_time(F.col("c"), F.lit(kind)).alias("x")).collect()
        for r in rows:
            assert math.isclose(area(r.x) / area(1.0), r.c, abs_tol=1e-9)


def test_training_order_is_sorted_and_complete(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    sized = docs.select("doc_id", "source", mx.word_count("text").alias("size"))
    mixed = mx.mix_sources(sized).cache()
    order = [r.position for r in mx.training_order(mixed).collect()]
    assert order == sorted(order) and all(0 <= p <= 1 for p in order)
    assert len(order) == mixed.agg(F.sum("copies")).first()[0]
    # a source whose weight falls is trained earlier than one whose weight rises
    mean = {r.kind: r.p for r in mixed.withColumn("p", F.explode("positions")).join(
        mx.source_targets(sized).select("source", "kind"), "source").groupBy("kind").agg(F.avg("p").alias("p")).collect()}
    assert mean[0] < mean[1] < mean[2]


def test_documents_repeat_as_taken(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    out = mx.mix_documents(docs)
    assert out.columns == docs.columns
    want = {r.doc_id: r.taken // r.size for r in mx.op5_mixing(spark, SF_MID).collect() if r.taken}
    got = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert got == want


def test_odd_and_empty_tables(spark):
    odd = odd_docs(spark)
    out = mx.mix_documents(odd)
    assert out.columns == odd.columns
    words = odd.select(F.sum(mx.word_count("text"))).first()[0]
    assert abs(out.select(F.sum(mx.word_count("text"))).first()[0] - 1.5 * words) < 30_000
    assert out.where("text IS NULL OR trim(text) = ''").count() == 0
    assert mx.mix_documents(empty_docs(spark)).count() == 0


def test_blank_documents_do_not_hinder_the_closing_one(spark):
    sizes = [int(40 + 37 * i % 101) for i in range(300)]
    rows = [(i, "ab"[i % 2], n) for i, n in enumerate(sizes)]
    taken = {}
    for blanks in (0, 3):
        df = spark.createDataFrame(rows + [(1000 + i, s, 0) for s in "ab" for i in range(blanks)],
                                   "doc_id long, source string, size long")
        got = mx.mix_sources(df).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"))
        taken[blanks] = {r.source: r.taken for r in got.collect()}
        for r in got.collect():
            assert abs(r.taken - r.target) <= max(sizes)
    assert taken[0] == taken[3]

import os
import random

from reelframe.llm import common
from reelframe.llm.components import connected_components


def brute(edges):
    comp = {}

    def find(x):
        comp.setdefault(x, x)
        while comp[x] != x:
            x = comp[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        comp[y] = x
    return {x: find(x) for x in comp}


def test_components_of_chains_hubs_and_random_graphs(spark):
    rnd = random.Random(1)
    chain = list(range(1, 60))
    rnd.shuffle(chain)
    cases = [[(a, b) for a, b in zip(chain, chain[1:])], [(1000, i) for i in range(300)], [(5, 5), (7, 7)],
             [(rnd.randrange(200), rnd.randrange(200)) for _ in range(150)], [(2, 1), (1, 2), (2, 1)]]
    for edges in cases:
        got = {r.node: r.component for r in connected_components(
            spark.createDataFrame(edges, "a long, b long")).collect()}
        want = {x: c for x, c in brute(edges).items() if x != c}
        assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_settle_keeps_the_result_and_removes_the_rest(spark):
    seen = []

    def build():
        inner = common.settle(spark, "inner", lambda: common.stored(spark.range(5).toDF("x"), "deep"))
        seen.extend(common._scopes[-1])
        return common.stored(inner.selectExpr("x + 1 AS x"), "middle")

    df = common.settle(spark, "outer", build)
    assert sorted(r.x for r in df.collect()) == [1, 2, 3, 4, 5]
    assert seen and not any(os.path.exists(p.removeprefix("file:")) for p in seen)
    assert not common._scopes


def test_join_checked_gives_the_same_rows_both_ways(spark, monkeypatch):
    big, small = spark.range(50).toDF("x"), spark.range(0, 50, 5).toDF("x")
    want = sorted(r.x for r in common.join_checked(big, small, "x").collect())
    monkeypatch.setattr(common, "BROADCAST_ROWS", 0)
    assert sorted(r.x for r in common.join_checked(big, small, "x").collect()) == want == list(range(0, 50, 5))

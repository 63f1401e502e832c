import numpy as np

from reelframe.llm import embeddings as em
from tests.llm.util import SF_MID


def brute(ids, vectors, threshold=0.95):
    n = len(ids)
    links, comp = np.zeros(n, int), np.arange(n)
    unit = [np.asarray(v, float) / np.linalg.norm(v) for v in vectors]
    pairs = [(i, j) for i in range(n) for j in range(i) if len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= threshold]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
        a, b = comp[i], comp[j]
        comp[comp == a] = b
    first = {}
    for i in range(n):
        first[comp[i]] = min(first.get(comp[i], ids[i]), ids[i])
    return {ids[i]: (links[i], first[comp[i]]) for i in range(n)}


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF_MID}/embeddings.parquet").collect()
    want = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = em.op10_embeddings(spark, SF_MID).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == want[r.vec_id]
        assert r.kept == (r.vec_id == r.component_id)


def test_recall_at_the_threshold_and_small_blocks(spark):
    rng = np.random.default_rng(4)
    vectors = []
    for _ in range(150):  # pairs whose cosine lies just above and below 0.95
        a = rng.standard_normal(32)
        a /= np.linalg.norm(a)
        b = rng.standard_normal(32)
        b -= (b @ a) * a
        b /= np.linalg.norm(b)
        for c in (0.951, 0.949):
            vectors += [a * 3, (c * a + np.sqrt(1 - c * c) * b) * 0.5]
    base = rng.standard_normal(32)  # one large group of near copies
    vectors += [base + 0.02 * rng.standard_normal(32) for _ in range(200)]
    ids = list(range(len(vectors)))
    df = spark.createDataFrame([(i, [float(x) for x in v], 1) for i, v in zip(ids, vectors)],
                               "vec_id long, embedding array<double>, k1 int")
    want = brute(ids, vectors)
    got = {r.vec_id: r for r in em.link_embeddings(df, block=16).collect()}
    assert sum(r.n_links for r in got.values()) >= 0.99 * sum(n for n, _ in want.values())
    assert all(got[i].n_links <= want[i][0] for i in ids)  # none below the threshold
    assert all(got[i].n_links == want[i][0] and got[i].component_id == want[i][1] for i in ids[-200:])


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (2, [2.0, 4.0]), (3, [1.0, 2.0]), (3, [1.0, 2.0]), (4, None), (5, []), (6, [0.0, 0.0]),
            (7, [1.0, None]), (8, [nan, 1.0]), (9, [inf, 1.0]), (None, [1.0, 2.0]), (10, [1.0, 2.0, 0.0]),
            (11, [-1.0, -2.0]), (12, [0.0, 0.0])]
    got = sorted(((r.vec_id or 0), r.n_links, r.component_id) for r in em.link_embeddings(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    assert got == [(0, 0, None), (1, 3, 1), (2, 3, 1), (3, 3, 1), (3, 3, 1), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 0, 7),
                   (8, 0, 8), (9, 0, 9), (10, 0, 10), (11, 0, 11), (12, 0, 12)]
    assert em.link_embeddings(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_extreme_magnitudes(spark):
    rows = [(1, [1e-200, 0.5e-200]), (2, [1e-200, 1.2e-200]), (3, [2e-200, 1e-200]), (4, [1e200, 2e200]),
            (5, [2e200, 4e200]), (6, [1e-320, 0.0]), (7, [3.0, 0.0]), (8, [1.7e308, -1.7e308]), (9, [1.0, -1.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in em.link_embeddings(
        spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    # (1, 1.2) and (1, 2) are at cosine 0.973, (1, 0.5) and (1, 1.2) at 0.92
    assert got == {1: (1, 1), 2: (2, 2), 3: (1, 1), 4: (2, 2), 5: (2, 2), 6: (1, 6), 7: (1, 6), 8: (1, 8), 9: (1, 8)}


def test_tables_and_bits_follow_the_number_of_vectors():
    last = (0, 0)
    for n in (0, 1, 500, 10_000, 1_000_000, 10 ** 10):
        tables, bits = em.hash_size(n)
        agree = (1 - np.arccos(0.95) / np.pi) ** bits
        assert (1 - agree) ** tables <= em.MISS and (tables, bits) >= last
        assert 2 ** bits * em.PER_BUCKET >= n
        last = tables, bits

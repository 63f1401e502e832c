import numpy as np
import pytest

from reelframe.llm import whitening as wh
from tests.llm.util import SF

SCHEMA = "vec_id long, embedding array<double>, x string, n string"


@pytest.mark.parametrize("kind", ["random", "repeated", "low rank", "diagonal", "close", "zero"])
def test_components_of_matrices(kind):
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 40):
        a = rng.standard_normal((n, n))
        q = np.linalg.qr(a)[0]
        a = {"random": a, "repeated": q @ np.diag(np.repeat([3.0, 1.0], [n // 2, n - n // 2])) @ q.T,
             "low rank": a[:, :max(1, n // 4)] @ a[:, :max(1, n // 4)].T, "diagonal": np.diag(np.arange(n) * 1.0),
             "close": q @ np.diag(1 + 1e-9 * np.arange(n)) @ q.T, "zero": np.zeros((n, n))}[kind]
        a = (a + a.T) / 2
        e, v = wh.components(a, n)
        scale = max(np.abs(a).max(), 1e-300)
        assert np.abs(e - np.linalg.eigvalsh(a)[::-1]).max() <= 1e-12 * scale * n
        assert np.abs(v.T @ v - np.eye(n)).max() < 1e-12
        assert np.abs(a @ v - v * e).max() <= 1e-12 * scale * n


def test_polar_factor_of_ill_conditioned_matrices():
    rng = np.random.default_rng(5)
    for cond in (1.0, 1e6, 1e14):
        q = np.linalg.qr(rng.standard_normal((30, 30)))[0]
        e = np.geomspace(1, 1 / cond, 30) * np.where(np.arange(30) % 2, 1, -1)
        u = wh.polar(q @ np.diag(e) @ q.T)
        assert np.abs(u @ u - np.eye(30)).max() < 1e-10
        if cond < 1e10:
            assert np.abs(u - q @ np.diag(np.sign(e)) @ q.T).max() < 1e-8


def brute(rows, wanted=16):
    """{vec_id: deviation}, matrix of whitened rows, shares; by numpy's own solver."""
    kept = [(i, e) for i, e in rows if e is not None and all(x is not None and np.isfinite(x) for x in e)]
    xs = np.array([[int(np.floor(64 * x)) + 1_000_000 for x in e] for _, e in kept])
    fit = np.unique(xs, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    v = np.cov(fit.T.astype(float), bias=True)
    e, p = np.linalg.eigh(v)
    e, p = e[::-1][:wanted], p[:, ::-1][:, :wanted]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(x, s)) for x in xs]
    return kept, n, deviation, (xs - s / n) @ p / np.sqrt(e), e / np.trace(v)


def check(rows, out):
    kept, n, deviation, whitened, shares = brute(rows)
    k = whitened.shape[1]
    assert len(out) == len(kept) * k and {r.n for r in out} == {n}
    got = {}
    for r in out:
        got.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    for c in range(1, k + 1):
        mine = np.array([got[i, d][c][0].whitened for (i, _), d in zip(kept, deviation)])
        assert min(np.abs(mine - s * whitened[:, c - 1]).max() for s in (1, -1)) < 1e-6
        assert abs(out[0].identity_error) < 1e-6
    assert all(abs(r.explained - shares[r.component - 1]) < 1e-9 for r in out)


def test_whole_table_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    check(rows, wh.op12_whitening(spark, SF).collect())


def test_dropped_repeated_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(x) for x in rng.standard_normal(5) * [9, 7, 5, 3, 1]]) for i in range(40)]
    rows = good + [(100 + i, good[0][1]) for i in range(60)] + [
        (None, good[1][1]), (200, None), (201, [None] + good[0][1][1:]), (202, [float("nan")] + good[0][1][1:]),
        (203, [float("inf")] + good[0][1][1:])]
    df = spark.createDataFrame([(i, e, "x", "n") for i, e in rows], SCHEMA)
    check(rows, wh.whiten(df).collect())
    # another length is whitened on its own; empty vectors and a lone one have no components
    more = [(300, [1.0, 2.0], "", ""), (301, [2.0, 5.0], "", ""), (302, [], "", ""), (303, [4.0], "", "")]
    out = wh.whiten(df.union(spark.createDataFrame(more, SCHEMA))).collect()
    pair = sorted((r.vec_id, r.component, round(abs(r.whitened), 9)) for r in out if (r.vec_id or 0) >= 300)
    assert pair == [(300, 1, 1.0), (301, 1, 1.0)]
    check(rows, [r for r in out if (r.vec_id or 0) < 300])


def test_huge_entries_equal_vectors_and_empty_tables(spark):
    df = spark.createDataFrame([(1, [1e300, 0.0]), (2, [-1e300, 0.0]), (3, [0.0, 0.0])], "vec_id long, embedding array<double>")
    out = wh.whiten(df).collect()
    assert len(out) == 3 and all(np.isfinite(r.whitened) for r in out)
    assert {r.vec_id: r.deviation for r in out}[1] is None
    same = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(4)], "vec_id long, embedding array<double>")
    assert wh.whiten(same).count() == 0
    empty = wh.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == wh.OUT

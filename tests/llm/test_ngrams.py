import random

import numpy as np

from reelframe.llm import ngrams as ng
from tests.llm.util import empty_docs, odd_docs


def shingles(text, k):
    w = text.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split()
    return {tuple(w[i:i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def brute(texts, k, num, den):
    sets = {i: shingles(t or "", k) for i, t in texts.items()}
    comp = {i: i for i in texts}

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                comp[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


def near_texts(rnd, n_groups=25):
    """Groups whose members lie close to the threshold, of many sizes, and chains."""
    texts = []
    for g in range(n_groups):
        size = rnd.choice([3, 5, 9, 12, 20, 40, 90, 200])
        base = [f"w{rnd.randrange(10 ** 6)}" for _ in range(size)]
        for _ in range(rnd.randint(1, 9)):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 1, 2, 3, max(1, size // 25)])):
                at = rnd.randrange(len(t))
                rnd.choice([lambda: t.pop(at) if len(t) > 1 else 0, lambda: t.insert(at, f"v{rnd.random()}"),
                            lambda: t.__setitem__(at, f"v{rnd.random()}")])()
            texts.append(" ".join(t))
            if rnd.random() < 0.3:
                base = t  # a chain
    return dict(enumerate(texts))


def test_components_equal_brute_force_on_near_copies(spark):
    texts = near_texts(random.Random(3))
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for k, num, den in ((3, 90, 100), (5, 80, 100)):
        want = brute(texts, k, num, den)
        assert len({c for _, c in want.values()}) < len(texts)
        for size in (256, 3):  # small blocks: loose members meet the other blocks
            got = {r.doc_id: (r.n_shingles, r.component_id) for r in
                   ng.jaccard_components(df, k, num, den, block_docs=size).collect()}
            assert got == want


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for num, den in ((90, 100), (80, 100), (50, 100)):
        scheme = ng.Scheme(num, den)
        for _ in range(1500):
            n = int(rng.choice([5, 9, 10, 11, 12, 18, 27, 45, 60, 150, 400]))
            a = np.unique(rng.integers(0, 2 ** 63, n, dtype=np.uint64))
            apart = scheme.most_apart(len(a))
            gone = int(rng.integers(0, apart + 1))
            b = np.unique(np.append(a[gone:], rng.integers(0, 2 ** 63, apart - gone, dtype=np.uint64)))
            both = len(np.intersect1d(a, b))
            if den * both >= num * (len(a) + len(b) - both) and len(a) == len(np.union1d(a, b)) - len(b) + both:
                if len(a) != len(b) or (a != b).any():
                    assert set(scheme.signatures(a)) & set(scheme.signatures(b)), (num, len(a), len(b))


def test_search_equals_counting():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2 ** 63, 120, dtype=np.uint64))
    sets = [np.unique(np.append(rng.choice(base, int(rng.integers(90, 120)), replace=False),
                                rng.integers(0, 2 ** 63, int(rng.integers(0, 15)), dtype=np.uint64))) for _ in range(60)]
    block = ng.Block(sets, 80, 100)
    for q in range(60):
        want = []
        for r in range(60):
            i = len(np.intersect1d(sets[q], sets[r]))
            if r != q and 100 * i >= 80 * (len(sets[q]) + len(sets[r]) - i):
                want.append(r)
        assert sorted(block.search(q).tolist()) == want


def test_odd_and_empty_tables(spark):
    got = sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in
                 ng.jaccard_components(odd_docs(spark), 5, 80, 100).collect())
    assert got == [(0, 0, None), (0, 1, None), (1, 2, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (4, 0, 4),
                   (5, 0, 5), (6, 29_996, 6), (7, 1, 7)]
    assert ng.jaccard_components(empty_docs(spark)).count() == 0


def test_signatures_are_written_once_and_shuffled_once(spark, monkeypatch):
    """They are most of the volume: the sets hold them, and one exchange by signature
    finds the stars; copies and repeated rows take no part."""
    seen = {}

    def stored(df, name):
        seen[name] = (df.columns, df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    kept = ng.stored
    monkeypatch.setattr(ng, "stored", stored)
    texts = {i: " ".join(f"w{j}" for j in range(30)) + f" end{i // 2}" for i in range(8)}
    rows = [*texts.items(), *texts.items(), (9, "a text of its own words")]
    got = {tuple(r) for r in ng.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [n for n, (columns, _) in seen.items() if "sigs" in columns] == ["sets"]
    assert seen["stars"][1].count("Exchange hashpartitioning(key#") == 1
    assert got == {(i, 27, 0) for i in texts} | {(9, 2, 9)}

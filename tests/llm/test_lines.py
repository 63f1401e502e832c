import random

from reelframe.llm import lines as ln
from tests.llm.util import empty_docs, odd_docs


def edit(a, b):
    """Word edit distance, by dynamic programming."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(docs, near=5):
    """Kept text of each document: a line goes if an earlier one equals it or is one
    word away."""
    seen, out = [], {}
    for i in sorted(docs):
        kept = []
        for line in docs[i].split("\n"):
            w = line.split()
            if w:
                drop = any(w == o or (min(len(w), len(o)) >= near and abs(len(w) - len(o)) <= 1 and edit(w, o) <= 1)
                           for o in seen)
                seen.append(w)
                if drop:
                    continue
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


def test_kept_lines_equal_brute_force(spark):
    rnd = random.Random(8)
    base = [[f"w{rnd.randrange(40)}" for _ in range(rnd.choice([1, 2, 3, 4, 5, 6, 8, 9, 12, 20]))] for _ in range(25)]
    docs = {}
    for i in range(60):
        text = []
        for _ in range(rnd.randint(0, 6)):
            t = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 0, 1, 1, 2])):
                at = rnd.randrange(len(t))
                rnd.choice([lambda: t.pop(at) if len(t) > 1 else 0, lambda: t.insert(at, f"v{rnd.randrange(5)}"),
                            lambda: t.__setitem__(at, f"v{rnd.randrange(5)}")])()
            text.append(rnd.choice([" ", "  ", "\t"]).join(t))
        docs[i] = "\n".join(text)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    rows = ln.dedup_lines(df).collect()
    want = brute(docs)
    assert {r.doc_id: r.text for r in rows} == want
    assert sum(r.n_near for r in rows) > 10 and sum(r.n_exact for r in rows) > 10
    for r in rows:
        assert r.n_lines - r.n_exact - r.n_near == (len(r.text.split("\n")) if r.text else
                                                    r.n_lines - r.n_exact - r.n_near)


def test_each_kind_of_edit_and_a_hot_neighbourhood(spark):
    w = [f"w{i}" for i in range(12)]
    rows = [(0, " ".join(w)), (1, " ".join(w[:5] + ["x"] + w[6:])), (2, " ".join(w[:11])), (3, " ".join(["new"] + w)),
            (4, " ".join(w[:5] + ["y"] + w[6:] + ["z"])), (5, " ".join(w[::-1])), (6, "one two"), (7, "one two")]
    rows += [(100 + i, " ".join(["hot"] * 9 + [f"n{i}"])) for i in range(300)]
    out = {r.doc_id: r for r in ln.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # line 4 is two edits from lines 0, 1 and 3
    assert [i for i in range(8) if out[i].n_near or out[i].n_exact] == [1, 2, 3, 7]
    assert [i for i in range(100, 400) if not out[i].n_near] == [100]


def test_very_long_line(spark):
    w = [f"w{i}" for i in range(40_000)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:20_001] + w[20_002:])), (3, " ".join(w[:100] + ["x"] + w[100:]) + " y")]
    out = {r.doc_id: r for r in ln.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [out[i].n_near for i in (1, 2, 3)] == [0, 1, 0]


def test_odd_and_empty_tables(spark):
    docs = odd_docs(spark)
    out = ln.dedup_lines(docs)
    assert out.columns == docs.columns + ["n_lines", "n_exact", "n_near"]
    got = sorted((r.doc_id or 0, r.n_lines, r.n_exact, (r.text or "")[:11]) for r in out.collect())
    assert got == [(0, 0, 0, ""), (0, 1, 0, "alpha beta"), (1, 1, 0, "alpha beta "), (1, 1, 0, "alpha beta "),
                   (1, 1, 0, "another tex"), (2, 1, 1, ""), (3, 0, 0, ""), (4, 1, 0, ""), (5, 2, 0, " \t\n "),
                   (6, 1, 0, "w0 w1 w2 w3"), (7, 1, 0, "xxxxxxxxxxx")]
    clash = docs.withColumnRenamed("k1", "n_near").withColumnRenamed("page_id", "row")
    assert ln.dedup_lines(clash).columns.count("n_near") == 1
    assert ln.dedup_lines(empty_docs(spark)).count() == 0


def test_bound_follows_the_length(spark):
    rows = [(1, "one"), (2, " one"), (3, "two"), (4, "a b c d"), (5, "a b c e"), (6, "a b c d f"), (7, "a b c d g"),
            (8, "a b x c d g"), (9, "a b c d"), (10, " \n\t"), (11, " \n\t")]
    out = {r.doc_id: r for r in ln.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sorted(i for i in out if out[i].n_exact) == [2, 9]
    # four words: 4, 5 and 6 stay; 8 is one word from 7, which goes itself
    assert sorted(i for i in out if out[i].n_near) == [7, 8]
    assert out[10].text == out[11].text == " \n\t"

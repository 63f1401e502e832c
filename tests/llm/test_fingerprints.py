import random

import hashlib

from pyspark.sql import functions as F

from reelframe.llm import fingerprints as fp
from tests.llm.util import SF, empty_docs, odd_docs


def test_edited_texts_and_likeness(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    rows = {r.doc_id: r for r in fp.op9_fingerprints(spark, SF).collect()}
    assert len(rows) == len(docs)
    prints = {}
    for at, i in enumerate(ids):
        text, follow = docs[i], docs[ids[(at + 1) % len(ids)]]
        m = len(text) // 3
        edited = text[:len(text) - m] + follow[:m]
        r = rows[i]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        a, b, c = (set(x.split()) for x in (r.fingerprint, r.edited_fingerprint,
                                            rows[ids[(at + 1) % len(ids)]].fingerprint))
        near = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        assert abs(r.near_edited - near(a, b)) < 1e-12 and abs(r.near_next - near(a, c)) < 1e-12


def _hashes(spark, text):
    """All shingle hashes of a text, by brute force."""
    w = text.split()
    codes = [r.h for r in spark.createDataFrame([(i, x) for i, x in enumerate(w)], "i int, w string")
             .select("i", F.xxhash64("w").alias("h")).orderBy("i").collect()]
    groups = [codes[i:i + 5] for i in range(max(len(codes) - 4, 1))]
    return {r.h for r in spark.createDataFrame([(g,) for g in groups], "g array<long>")
            .select(F.xxhash64("g").alias("h")).collect()}


def test_sketch_keeps_every_hash_below_the_bound(spark):
    text = " ".join(f"w{i % 97}x{i % 13}" for i in range(500))
    every = _hashes(spark, text)
    bound = -(1 << 63) + (1 << 64) // fp.SCALE
    row = spark.createDataFrame([(text, "one two", "", " \n")], "a string, b string, c string, d string").select(
        fp.sketch(F.col("a")).alias("a"), fp.sketch(F.col("b")).alias("b"), fp.sketch(F.col("c")).alias("c"),
        fp.sketch(F.col("d")).alias("d")).first()
    assert row.a == sorted(h for h in every if h < bound)
    assert row.b == list(_hashes(spark, "one two"))  # fewer words than a shingle
    assert row.c == [] and row.d == []


def test_containment_between_unequal_texts_and_merge(spark):
    large = " ".join(f"w{i}" for i in range(8000))
    small = " ".join(f"w{i}" for i in range(2000, 4000))
    other = " ".join(f"v{i}" for i in range(2000))
    s = spark.createDataFrame([(large, small, other)], "l string, s string, o string").select(
        *[fp.sketch(F.col(c)).alias(c) for c in "lso"])
    r = s.select(fp.containment(F.col("s"), F.col("l")).alias("in"), fp.containment(F.col("o"), F.col("l")).alias("out"),
                 fp.containment(F.col("o"), fp.merge(F.col("l"), F.col("o"))).alias("merged")).first()
    assert r["in"] == 1.0 and r["out"] == 0.0 and r["merged"] == 1.0


def test_odd_and_empty_tables(spark, tmp_path):
    rows = fp.fingerprint_documents(odd_docs(spark)).collect()
    assert len(rows) == 11
    by = {}
    for r in rows:
        assert by.setdefault(r.text or "", r.sketch) == r.sketch
    odd_docs(spark).write.parquet(str(tmp_path / "a/documents.parquet"))
    out = fp.op9_fingerprints(spark, str(tmp_path / "a")).collect()
    assert len(out) == 11
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    empty_docs(spark).write.parquet(str(tmp_path / "b/documents.parquet"))
    assert fp.op9_fingerprints(spark, str(tmp_path / "b")).count() == 0


def test_merge_is_the_sketch_of_the_union(spark):
    rnd = random.Random(11)
    rows = []
    for _ in range(60):
        a, b = ([f"{w}" for w in rnd.sample(range(60), rnd.randint(0, 12))] for _ in range(2))
        rows.append((" ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "a string, b string").select(
        fp.sketch(F.col("a"), 1).alias("x"), fp.sketch(F.col("b"), 1).alias("y"),
        fp.sketch(F.concat_ws(" ", "a", "b"), 1).alias("both"))
    for r in df.select(fp.merge(F.col("x"), F.col("y")).alias("merged"), "both").collect():
        assert r.merged == r.both


def test_error_against_exact_likeness_short_texts_too(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        a = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([10, 16, 23, 40, 53, 200, 600]))]
        b = list(a)
        for _ in range(rnd.randint(0, 4)):
            at = rnd.randrange(len(b))
            b[at:at + rnd.randint(1, max(len(b) // 10, 1))] = [f"v{rnd.randrange(5000)}"]
        rows.append((i, " ".join(a), " ".join(b)))
    df = spark.createDataFrame(rows, "i int, a string, b string")
    shingles = lambda t: {tuple(t.split()[i:i + 5]) for i in range(max(len(t.split()) - 4, 1))}
    errors = {}
    for r in df.select("i", fp.likeness(fp.sketch(F.col("a")), fp.sketch(F.col("b"))).alias("near")).collect():
        x, y = shingles(rows[r.i][1]), shingles(rows[r.i][2])
        errors.setdefault(len(x) < 20, []).append(abs(r.near - len(x & y) / len(x | y)))
    short, long = errors[True], errors[False]
    assert len(short) > 200 and sum(short) / len(short) < 0.16
    assert sum(e > 0.3 for e in short) < 0.12 * len(short)
    assert sum(long) / len(long) < 0.07 and sum(e > 0.3 for e in long) < 0.01 * len(long)

import math

import zstandard

from reelframe.llm import quality as q
from tests.llm.util import SF_MID, empty_docs, held_out, odd_docs

LARGE = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{LARGE}/labels.parquet").collect()}
    rows = q.op2_quality(spark, LARGE).collect()
    assert len(rows) == spark.read.parquet(f"{LARGE}/documents.parquet").count()
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    test = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good = [s for s, y in test if y == 1]
    bad = [s for s, y in test if y == 0]
    assert len(good) > 300 and len(bad) > 50
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.98
    assert sum(s >= 0.3 for s in good) >= 0.99 * len(good)
    assert sum(s < 0.3 for s in bad) >= 0.8 * len(bad)
    # calibrated: the mean score is near the share of good texts
    assert abs(sum(s for s, _ in test) / len(test) - len(good) / len(test)) < 0.05


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    a = q.train(docs, labels)
    flipped = labels.select("doc_id", q.F.when(q.held_out(), 1 - q.F.col("quality")).otherwise(q.F.col("quality"))
                            .cast("int").alias("quality"))
    assert q.train(docs, flipped) == a


def test_odd_rows(spark):
    docs = odd_docs(spark)
    model = q.train(spark.read.parquet(f"{SF_MID}/documents.parquet"), spark.read.parquet(f"{SF_MID}/labels.parquet"))
    rows = q.score_texts(docs, model).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if not r.text}) == 1
    assert q.score_texts(docs.withColumnRenamed("k1", "score"), model).columns.count("score") == 1
    assert q.score_texts(empty_docs(spark), model).count() == 0
    none = spark.createDataFrame([(None, 1), (1, None), (2, 1)], "doc_id long, quality int")
    assert {r.score for r in q.score_texts(docs, q.train(docs, none)).collect()} == {0.5}


def test_scores_equal_plain_compression(spark):
    """Sizes with and without blocks of each whole text, by zstandard alone."""
    docs, labels = (spark.read.parquet(f"{SF_MID}/{t}.parquet") for t in ("documents", "labels"))
    model = q.train(docs, labels)

    def size(raw, data):
        made = zstandard.ZstdCompressor(level=q.LEVEL, dict_data=zstandard.ZstdCompressionDict(raw),
                                        write_content_size=False, write_checksum=False, write_dict_id=False)
        return sum(len(made.compress(data[i:i + q.BLOCK])) for i in range(0, len(data), q.BLOCK))

    for r in q.score_texts(docs, model).collect()[::10]:
        data = (r.text or "").encode()
        g, b = size(model.good, data), size(model.bad, data)
        f = [(b - g) / (b + g) if data else 0.0, min(g, b) / len(data) if data else 1.0, math.log1p(len(data))]
        f = [min(max(x, low), high) for x, low, high in zip(f, model.low, model.high)]
        d, c, n = f[0] * 10, min(f[1], 1.5) * 3, f[2] / 5
        terms = [1, d, c, n, d * d, c * c, n * n, d * c, d * n, c * n]
        z = sum(w * t for w, t in zip(model.weights, terms))
        assert abs(r.score - 1 / (1 + math.exp(-z))) < 1e-9


def test_few_labels(spark):
    ids = [i for i in range(40) if not held_out(i)]
    text = lambda i: " ".join(f"good{j % 7} prose{i}" for j in range(40)) if i % 2 else "zq#9 " * 60
    docs = spark.createDataFrame([(i, text(i)) for i in ids], "doc_id long, text string")
    good, bad = [i for i in ids if i % 2], [i for i in ids if not i % 2]
    for n in (2, 3):
        labels = spark.createDataFrame([(i, 1) for i in good[:n]] + [(i, 0) for i in bad[:n]], "doc_id long, quality int")
        rows = q.score_texts(docs, q.train(docs, labels)).collect()
        assert min(r.score for r in rows if r.doc_id in good) > max(r.score for r in rows if r.doc_id in bad)
    # the only bad text is halved: nothing good is rejected, bad texts score lower
    known = spark.read.parquet(f"{SF_MID}/labels.parquet")
    truth = {r.doc_id: r.quality for r in known.collect()}
    first = [sorted(i for i, y in truth.items() if y == y0 and not held_out(i))[:n] for y0, n in ((1, 9), (0, 1))]
    table = spark.read.parquet(f"{SF_MID}/documents.parquet")
    model = q.train(table, known.where(q.F.col("doc_id").isin(sum(first, []))))
    scores = {r.doc_id: r.score for r in q.score_texts(table, model).collect() if r.doc_id in truth}
    high, low = ([scores[i] for i, y in truth.items() if y == y0 and i in scores] for y0 in (1, 0))
    assert min(high) >= q.KEEP
    assert sum(a > b for a in high for b in low) > 0.7 * len(high) * len(low)
    for some in (good, bad):  # one class only
        labels = spark.createDataFrame([(i, int(some is good)) for i in some], "doc_id long, quality int")
        assert {r.score for r in q.score_texts(docs, q.train(docs, labels)).collect()} == {0.5}

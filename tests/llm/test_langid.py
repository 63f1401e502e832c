import math
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelframe.llm import langid as li
from tests.llm.util import SF_MID, empty_docs, odd_docs


def units(text):
    """Lower-case letters and marks, blanks between; by characters (no astral ones)."""
    out = ""
    for c in text:
        c = (c.lower() if len(c.lower()) == 1 else c) if unicodedata.category(c)[0] in "LM" else " "
        if c != " " or (out and out[-1] != " "):
            out += c
    return out


class Brute:
    """Interpolated Kneser-Ney over strings, by dictionaries."""

    def __init__(self, texts, n_units):
        c = Counter()
        for t in texts:
            u = "   " + units(t)
            c.update(u[i - 3:i + 1] for i in range(3, len(u)))
        self.counts = {4: c}
        for k in (3, 2, 1):
            self.counts[k] = Counter(g[1:] for g in self.counts[k + 1])
        self.d, self.ctx = {}, {}
        for k, counts in self.counts.items():
            n1, n2 = (sum(v == x for v in counts.values()) for x in (1, 2))
            self.d[k] = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 + n2 else 0.1))
            self.ctx[k] = defaultdict(list)
            for g, v in counts.items():
                self.ctx[k][g[:-1]].append(v)
        self.n_units = n_units

    def p(self, g):
        k = len(g)
        if not k:
            return 1 / self.n_units
        ctx = self.ctx[k].get(g[:-1])
        if not ctx:
            return self.p(g[1:])
        seen = self.counts[k].get(g, 0)
        return max(seen - self.d[k], 0) / sum(ctx) + self.d[k] * len(ctx) / sum(ctx) * self.p(g[1:])

    def entropy(self, text):
        u = "   " + units(text)
        return -sum(math.log(self.p(u[i - 3:i + 1])) for i in range(3, len(u))) / max(len(u) - 3, 1)


TEXTS = [("xx", "Aba caba DABA aba!"), ("xx", "caba 12 aba cad́"), ("xx", "aab"), ("yy", "Zeze Üzeb ezz zeb"),
         ("yy", "beze-zeb ZUZE"), ("zz", "aba zeze"), ("zz", "")]
PROBES = ["aba", "zeb zuze aba", "Q", "üzeb ... caba", "aba" * 50, "", "  9 ", "xyz aba"]


@pytest.mark.parametrize("per_pass, segment", [(8, 1 << 20), (1, 1 << 20), (2, 1000)])
def test_cross_entropies_equal_brute_force(spark, per_pass, segment):
    rows = spark.createDataFrame(TEXTS, "lang string, text string")
    fitted = li.fit(rows, per_pass=per_pass, segment=segment)
    assert [x for m in fitted for x in m.langs] == ["xx", "yy", "zz"]
    n_units = len({c for _, t in TEXTS for c in units(t)}) + 1
    brute = {lang: Brute([t for x, t in TEXTS if x == lang], n_units) for lang in ("xx", "yy", "zz")}
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(PROBES)], "id int, text string")
    for r in li.score_languages(docs, fitted, segment).collect():
        want = sorted((b.entropy(PROBES[r.row.id]), lang) for lang, b in brute.items())
        assert r.first == pytest.approx(want[0][0], rel=1e-5) and r.second == pytest.approx(want[1][0], rel=1e-5)
        if r.units:
            assert r.lang == want[0][1]


def test_probabilities_sum_to_one(spark):
    rows = spark.createDataFrame(TEXTS, "lang string, text string")
    (m,) = li.fit(rows)
    letters = sorted({c for _, t in TEXTS for c in units(t)})
    for ctx in ("aba", "  z", "qqq", "xab"):
        keys = [sum(ord(c) << 16 * (3 - i) for i, c in enumerate(ctx + x)) for x in [*letters, "一"]]
        total = np.exp(m.log_probability(np.array(keys, np.int64))).sum(axis=0)
        assert np.abs(total - 1).max() < 1e-4


def test_folding_of_texts():
    tables = li.fold_tables()
    keys, text, letters = li.fold_texts(["Äb1 ", "", "\U00010400\U0001F600x", "42", "İ"], *tables)
    last = [int(k) & 0xFFFF for k in keys]
    assert text.tolist() == [0, 0, 0, 2, 2, 2, 2, 4]
    assert last == [0xE4, 0x62, 0x20, 0xD801, 0xDC00, 0x20, 0x78, 0x130]
    assert letters.tolist() == [True, False, True, False, True]
    assert int(keys[0]) & 0xFFFFFFFF == 0x2000E4


def test_held_out_accuracy_and_calibration(spark):
    rows = li.op13_langid(spark, SF_MID).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    import zlib
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    test = [r for r in rows if r.held_out]
    right = sum(r.lang_pred == docs[r.doc_id].lang for r in test) / len(test)
    assert len(test) > 200 and right >= 0.99
    assert abs(sum(r.score for r in test) / len(test) - right) < 0.02
    assert sum(r.accepted for r in test) >= 0.95 * len(test)
    junk = spark.createDataFrame([(1, "qxzjw kvvqx zzxqj wwqkx vjjqz " * 20, "en")], "doc_id long, text string, lang string")
    whole = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang")
    learn = ~li.held_out() & (li.F.col("doc_id") != 1)
    out = li.identify_languages(whole.where("doc_id <> 1").union(junk), learn)
    assert not out.where("doc_id = 1").first().accepted


def test_labels_of_the_held_out_fold_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text", "lang").limit(120)
    other = docs.withColumn("lang", li.F.when(li.held_out(), li.F.lit("qq")).otherwise(li.F.col("lang")))
    a, b = (sorted((r.doc_id, r.lang_pred, round(r.score, 6)) for r in li.identify_languages(d, ~li.held_out()).collect())
            for d in (docs, other))
    assert a == b and "qq" not in {x[1] for x in b}


def test_odd_rows_and_empty_tables(spark):
    docs = odd_docs(spark).withColumnRenamed("k1", "score").withColumnRenamed("size", "row")
    out = li.identify_languages(docs, ~li.held_out())
    assert out.columns == [c for c in docs.columns if c not in ("text", "score")] + [
        "lang_pred", "score", "cross_entropy", "accepted"]
    rows = out.collect()
    assert len(rows) == 11 and all((r.lang_pred == "und") == (r.score == 0) for r in rows)
    assert sum(r.lang_pred == "und" for r in rows) == 4
    assert li.identify_languages(empty_docs(spark), ~li.held_out()).count() == 0
    nothing = li.identify_languages(odd_docs(spark), li.F.lit(None).cast("boolean")).collect()
    assert {(r.lang_pred, r.score, r.accepted) for r in nothing} == {("und", 0.0, False)}

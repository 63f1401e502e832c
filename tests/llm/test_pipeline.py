import sentencepiece

import corpus_pipeline as cp
from reelframe.llm.common import stored, table
from reelframe.llm.tokenizing import piece_model
from tests.llm.test_lines import brute as brute_lines
from tests.llm.test_ngrams import brute as brute_groups
from tests.llm.util import SF, SF_MID, empty_docs, odd_docs


def test_stages_equal_brute_force(spark):
    docs = table(spark, SF, "documents")
    kept = stored(cp.quality(spark, docs, SF), "t")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    good = {i for i, y in labels.items() if y == 1}
    assert {r.doc_id for r in kept.collect()} >= good  # clean documents stay
    lined = stored(dict(cp.STAGES)["line_dedup"](spark, kept, SF), "t")
    want = brute_lines({r.doc_id: r.text for r in kept.collect()})
    before = {r.doc_id: r.text for r in kept.collect()}
    assert {r.doc_id: r.text for r in lined.collect()} == {i: t for i, t in want.items() if t.split() or t == before[i]}
    assert all(r.n_chars == len(r.text) for r in lined.collect())
    single = stored(cp.near_duplicates(spark, lined, SF), "t")
    groups = brute_groups({r.doc_id: r.text for r in lined.collect()}, 5, 80, 100)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in groups.items() if i == c}
    mixed = stored(cp.mixing(spark, single, SF), "t")
    assert mixed.columns == docs.columns and mixed.count() > 0
    lib = sentencepiece.SentencePieceProcessor(model_proto=piece_model())
    texts = {r.doc_id: r.text for r in single.collect()}
    rows = cp.tokenize(spark, mixed, SF).collect()
    assert len(rows) == mixed.count()
    for r in rows[:100]:
        assert r.ids == lib.encode(texts[r.doc_id], add_eos=True) and r.n_tokens == len(r.ids)


def test_near_copies_go_and_run_gives_all_rows(spark):
    base = [f"w{i}" for i in range(100)]
    rows = [(5, " ".join(base), "en", "a", 1), (2, " ".join(base[:50] + ["x"] + base[51:]), "en", "a", 1),
            (7, " ".join(base[:70]), "en", "a", 1), (8, "quite another text of some words", "en", "a", 1),
            (9, "quite another text of some words", "en", "a", 1), (2, " ".join(base[:50] + ["x"] + base[51:]), "en", "a", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in cp.near_duplicates(spark, docs, SF).collect()) == [2, 7, 8]
    out = cp.run(spark, SF_MID)
    assert out.count() > 500 and "ids" in out.columns


def test_stages_on_odd_and_empty_tables(spark):
    for docs in (odd_docs(spark), empty_docs(spark)):
        for name, stage in cp.STAGES:
            out = stored(stage(spark, docs, SF), "odd")
            if name == "tokenize":
                assert "ids" in out.columns
            else:
                assert out.dtypes == docs.dtypes
            assert (out.count() > 0) == bool(docs.count())


def test_copies_lose_lines_of_any_length_and_new_lines_stay(spark):
    body = "\n".join(" ".join(f"w{i}x{j}" for j in range(10)) for i in range(6))
    near = body.replace("w2x3", "other")
    poem = "\n".join(f"verse{i} end{i}" for i in range(20))
    foot = "all rights are reserved"
    rows = [(1, "Heading\n" + body), (2, "Heading\n" + body), (3, "Copy.\n" + body), (4, "Near copy\n" + near),
            (5, "Opening\n" + foot), (6, poem + "\n" + foot), (7, "two words\nOpening"), (8, poem + "\n" + foot),
            (9, "Heading\nand a line of its own\n" + body), (10, ""), (11, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'a' AS source", "int(length(text)) AS n_chars")
    lined = {r.doc_id: r.text for r in dict(cp.STAGES)["line_dedup"](spark, docs, SF).collect()}
    # 2 and 8 repeat every line; what no earlier document has stays
    assert sorted(lined) == [1, 3, 4, 5, 6, 7, 9, 10, 11]
    assert lined[1] == "Heading\n" + body and lined[6] == poem and lined[7] == "two words"
    assert lined[3] == "Copy." and lined[4] == "Near copy" and lined[9] == "and a line of its own"

import hashlib
import random

import pytest
import sentencepiece

from reelframe.llm import tokenizing as tk
from tests.llm.util import SF, empty_docs, odd_docs


@pytest.fixture(scope="module")
def both():
    model = tk.piece_model()
    return tk.PrefixTableEncoder(model), sentencepiece.SentencePieceProcessor(model_proto=model)


def test_ids_equal_the_library_on_random_texts(both):
    enc, lib = both
    rnd = random.Random(5)
    bits = ["a", "b", "e", "t", "h", "in", " ", "  ", "the", "▁", "\n", "\t", "é", "\U0001F600", "中", "10", "==",
            "____", "aaaa", "\0", "<s>", "</s>", "<0x41>", "ing", "́", "\r", "▁▁", " " * 17]
    pieces = list(enc.ids)
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rnd.choice(pieces) for _ in range(rnd.randint(1, 6))).replace("▁", " ") for _ in range(4000)]
    for text in texts:
        ids = enc.encode(text)
        assert ids == lib.encode(text, add_eos=True), repr(text)
        assert enc.decimals(ids) == " ".join(map(str, ids))


def test_pair_test_equals_merging(both):
    enc, _ = both
    rnd = random.Random(6)
    ids = list(enc.ids.values())
    for _ in range(20_000):
        a, b = rnd.choice(ids), rnd.choice(ids)
        ends = [enc.piece[a], enc.piece[b]]
        assert enc.compatible(a, b) == (enc._merge("".join(ends))[0] == ends)


def test_query_equals_the_library(spark, both):
    _, lib = both
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = tk.op8_sentencepiece(spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = lib.encode(texts[r.doc_id], add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(lib.decode(ids).encode()).hexdigest()


def test_odd_rows_and_round_trip(spark, both):
    docs = odd_docs(spark)
    encoded = tk.encode_texts(docs, tk.piece_model())
    assert encoded.columns == [c for c in docs.columns if c != "text"] + ["n_tokens", "ids"]
    back = tk.decode_ids(encoded, tk.piece_model()).collect()
    assert len(back) == 11
    texts = sorted(r.text or "" for r in docs.collect())
    assert sorted(r.text for r in back) == texts
    assert [r.ids for r in back if r.text == ""] == [[2]] * 3
    clash = docs.withColumnRenamed("page_id", "ids").withColumnRenamed("k1", "n_tokens")
    assert tk.encode_texts(clash, tk.piece_model()).count() == 11
    assert tk.encode_texts(empty_docs(spark), tk.piece_model()).count() == 0
    assert tk.decode_ids(tk.encode_texts(empty_docs(spark), tk.piece_model()), tk.piece_model()).count() == 0


def test_memo_generations_do_not_change_ids(both, monkeypatch):
    _, lib = both
    monkeypatch.setattr(tk, "MEMO_SEGMENTS", 3)
    monkeypatch.setattr(tk, "MEMO_PAIRS", 5)
    enc = tk.PrefixTableEncoder(tk.piece_model())
    text = "the quick brown fox jumps over the lazy dog the fox " * 3
    assert enc.encode(text) == lib.encode(text, add_eos=True)

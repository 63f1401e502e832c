"""Queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelframe.llm import (chat, embeddings, fingerprints, langid, lines, mixing, ngrams, quality,
                           secrets, sql, tokenizing, trie, warc, whitening)

Query = Callable[[SparkSession, str], DataFrame]


def llm_queries() -> dict[str, Query]:
    return {
        "op1_warc": warc.op1_warc,
        "op2_quality": quality.op2_quality,
        "op3_chat": chat.op3_chat,
        "op4_lines": lines.op4_lines,
        "op5_mixing": mixing.op5_mixing,
        "op6_ngram_jaccard": ngrams.op6_ngram_jaccard,
        "op7_secrets": secrets.op7_secrets,
        "op8_sentencepiece": tokenizing.op8_sentencepiece,
        "op9_fingerprints": fingerprints.op9_fingerprints,
        "op10_embeddings": embeddings.op10_embeddings,
        "op11_trie": trie.op11_trie,
        "op12_whitening": whitening.op12_whitening,
        "op13_langid": langid.op13_langid,
    }


def llm_oracle() -> dict[str, str]:
    return {"op1_warc": sql.OP1, "op3_chat": sql.OP3, "op4_lines": sql.OP4, "op5_mixing": sql.OP5,
            "op6_ngram_jaccard": sql.OP6, "op10_embeddings": sql.OP10,
            "op11_trie": sql.OP11}

"""The registered queries of this subpackage and the DuckDB SQL each must equal, where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wakeline.llm import (
    bpe, chat, embeddings, exact, ngram, packing, quality, search, secrets, substring, toxicity, warc, whiten,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": bpe.op1,
        "op2_toxicity": toxicity.op2,
        "op3_secret_scan": secrets.op3,
        "op4_exact_dedup": exact.op4,
        "op5_ngram_join": ngram.op5,
        "op6_quality": quality.op6,
        "op7_web_archives": warc.op7,
        "op8_embedding_pairs": embeddings.op8,
        "op9_chat_windows": chat.op9,
        "op10_packing": packing.op10,
        "op11_substring_dedup": substring.op11,
        "op12_whitening": whiten.op12,
        "op13_lexical_search": search.op13,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_secret_scan": secrets.OP3_SQL,
        "op4_exact_dedup": exact.OP4_SQL,
        "op7_web_archives": warc.OP7_SQL,
        "op9_chat_windows": chat.OP9_SQL,
        "op11_substring_dedup": substring.OP11_SQL,
        "op13_lexical_search": search.OP13_SQL,
    }

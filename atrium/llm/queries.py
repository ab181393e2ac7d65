"""The registered queries of the corpus operators and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from atrium.llm import q_bpe, q_chat, q_ctw, q_langid, q_licenses, q_media, q_neardup, q_packing, q_quality, q_tokenfile, q_toxicity, q_trie, q_variants


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_chat_format": q_chat.op1_chat_format,
        "op2_toxicity": q_toxicity.op2_toxicity,
        "op3_license_scan": q_licenses.op3_license_scan,
        "op4_near_dedup": q_neardup.op4_near_dedup,
        "op5_bpe": q_bpe.op5_bpe,
        "op6_media": q_media.op6_media,
        "op7_lm_score": q_ctw.op7_lm_score,
        "op8_packing": q_packing.op8_packing,
        "op9_quality": q_quality.op9_quality,
        "op10_token_files": q_tokenfile.op10_token_files,
        "op11_language_id": q_langid.op11_language_id,
        "op12_spelling_variants": q_variants.op12_spelling_variants,
        "op13_prefix_trie": q_trie.op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_format": q_chat.OP1_SQL, "op4_near_dedup": q_neardup.OP4_SQL, "op9_quality": q_quality.OP9_SQL, "op12_spelling_variants": q_variants.OP12_SQL, "op13_prefix_trie": q_trie.OP13_SQL}

"""The registered queries of this package and the same in SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bitslice, fm_index, jaccard, langid, merkle, mixing, repair, sentences, sharding, simhash, sql, suffix_array, tokens, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_bit_sliced_top_k": bitslice.op1,
        "op2_token_counts": tokens.op2,
        "op3_simhash_near_dedup": simhash.op3,
        "op4_rendezvous_sharding": sharding.op4,
        "op5_sentence_span_dedup": sentences.op5,
        "op6_pfair_mixing": mixing.op6,
        "op7_warc_round_trip": warc.op7,
        "op8_fm_index_decontamination": fm_index.op8,
        "op9_language_id": langid.op9,
        "op10_suffix_array_dedup": suffix_array.op10,
        "op11_merkle_manifest": merkle.op11,
        "op12_ngram_jaccard": jaccard.op12,
        "op13_conversation_repair": repair.op13,
        "language_id_of_pages": langid.pages,
    }


def oracle_sql() -> dict[str, str]:
    return sql.statements()

"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from vellum.llm import alignment, bpe, embeddings, infilling, licenses, minhash, nearest, packing, pii, quality, topk, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity_nbsvm": toxicity.op1_toxicity_nbsvm,
        "op2_pii_feistel": pii.op2_pii_feistel,
        "op3_best_fit_packing": packing.op3_best_fit_packing,
        "op4_byte_bpe": bpe.op4_byte_bpe,
        "op5_embedding_dedup": embeddings.op5_embedding_dedup,
        "op6_arc_to_warc": warc.op6_arc_to_warc,
        "op7_quality_rules": quality.op7_quality_rules,
        "op8_exact_topk": topk.op8_exact_topk,
        "op9_minhash_forest": minhash.op9_minhash_forest,
        "op10_license_scan": licenses.op10_license_scan,
        "op11_block_matrix_join": nearest.op11_block_matrix_join,
        "op12_fill_in_middle": infilling.op12_fill_in_middle,
        "op13_tokenizer_alignment": alignment.op13_tokenizer_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op5_embedding_dedup": embeddings.ORACLE_SQL,
        "op6_arc_to_warc": warc.ORACLE_SQL,
        "op8_exact_topk": topk.ORACLE_SQL,
        "op9_minhash_forest": minhash.ORACLE_SQL,
        "op10_license_scan": licenses.ORACLE_SQL,
        "op11_block_matrix_join": nearest.ORACLE_SQL,
        "op12_fill_in_middle": infilling.ORACLE_SQL,
    }

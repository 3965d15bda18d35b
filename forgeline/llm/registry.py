"""Queries and SQL restatements of the corpus operators, for ``__spark_entry__``."""

from __future__ import annotations

import corpus_pipeline
from forgeline.llm import (byte_bpe, cover_tree, decontaminate, exact_dedup, filter_audit, html_text, langid, licenses, packing, simhash,
                           suffix_dedup, token_files, whitening)


def queries() -> dict:
    return {
        "op1_suffix_dedup": suffix_dedup.op1_suffix_dedup,
        "op2_cover_tree": cover_tree.op2_cover_tree,
        "op3_html_text": html_text.op3_html_text,
        "op4_licenses": licenses.op4_licenses,
        "op5_exact_dedup": exact_dedup.op5_exact_dedup,
        "op6_token_files": token_files.op6_token_files,
        "op7_language_id": langid.op7_language_id,
        "op8_packing": packing.op8_packing,
        "op9_simhash_dedup": simhash.op9_simhash_dedup,
        "op10_byte_bpe": byte_bpe.op10_byte_bpe,
        "op11_filter_audit": filter_audit.op11_filter_audit,
        "op12_decontaminate": decontaminate.op12_decontaminate,
        "op13_whitening": whitening.op13_whitening,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_cover_tree": cover_tree.OP2_SQL,
        "op5_exact_dedup": exact_dedup.OP5_SQL,
        "op11_filter_audit": filter_audit.OP11_SQL,
        "op12_decontaminate": decontaminate.OP12_SQL,
    }

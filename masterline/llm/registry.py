"""Queries of this subpackage and their DuckDB counterparts."""

from __future__ import annotations

from masterline.llm import class_lm, importance, line_dedup, mixing, packing, quality, secrets, sharding, simhash, spelling, token_counts, warc, winnowing


def queries() -> dict:
    return {
        "op1_best_fit_packing": packing.op1_best_fit_packing,
        "op2_secret_scans": secrets.op2_secret_scans,
        "op3_quality_rules": quality.op3_quality_rules,
        "op4_warc": warc.op4_warc,
        "op5_class_lm": class_lm.op5_class_lm,
        "op6_simhash": simhash.op6_simhash,
        "op7_mixing": mixing.op7_mixing,
        "op8_sharding": sharding.op8_sharding,
        "op9_token_counts": token_counts.op9_token_counts,
        "op10_fingerprints": winnowing.op10_fingerprints,
        "op11_importance": importance.op11_importance,
        "op12_line_dedup": line_dedup.op12_line_dedup,
        "op13_spelling": spelling.op13_spelling,
    }


def oracle_sql() -> dict:
    return {
        "op2_secret_scans": secrets.SQL,
        "op3_quality_rules": quality.SQL,
        "op4_warc": warc.SQL,
        "op7_mixing": mixing.SQL,
        "op11_importance": importance.SQL,
        "op12_line_dedup": line_dedup.SQL,
        "op13_spelling": spelling.SQL,
    }

"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

from . import alignment, decontaminate, hard_negatives, langid, licenses, ngram_join, packing, pii, pitman_yor, quality, sharding, substring_dedup, topk
from .session import table


def _on(op, *tables):
    def query(spark, sf_dir):
        return op(spark, *[table(spark, sf_dir, t) for t in tables])

    return query


QUERIES = {
    "op1_sharding": _on(sharding.op1_sharding, "documents"),
    "op2_language_id": _on(langid.op2_language_id, "documents"),
    "op3_quality": _on(quality.op3_quality, "documents", "labels"),
    "op4_decontamination": _on(decontaminate.op4_decontamination, "documents", "benchmark"),
    "op5_license_scan": _on(licenses.op5_license_scan, "documents"),
    "op6_exact_topk": _on(topk.op6_exact_topk, "embeddings"),
    "op7_ngram_jaccard": _on(ngram_join.op7_ngram_jaccard, "documents"),
    "op8_suffix_dedup": _on(substring_dedup.op8_suffix_dedup, "documents"),
    "op9_packing": _on(packing.op9_packing, "documents"),
    "op10_pii": _on(pii.op10_pii, "documents"),
    "op11_lm_scoring": _on(pitman_yor.op11_lm_scoring, "documents"),
    "op12_hard_negatives": _on(hard_negatives.op12_hard_negatives, "embeddings"),
    "op13_alignment": _on(alignment.op13_alignment, "documents"),
}

ORACLE_SQL = {"op6_exact_topk": topk.ORACLE, "op7_ngram_jaccard": ngram_join.ORACLE, "op12_hard_negatives": hard_negatives.ORACLE}

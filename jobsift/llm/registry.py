"""Queries of the training-data operators and their SQL, read by ``__spark_entry__``."""

from __future__ import annotations

from jobsift.llm import (
    collocations,
    conversation_repair,
    decontaminate,
    exact_dedup,
    html_text,
    language,
    license_scan,
    mixing,
    packing,
    quality_classifier,
    quality_rules,
    simhash,
    token_counts,
)

QUERIES = {
    "op1_simhash_dedup": simhash.op1_simhash_dedup,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_html_text": html_text.op3_html_text,
    "op4_packing": packing.op4_packing,
    "op5_language": language.op5_language,
    "op6_quality_rules": quality_rules.op6_quality_rules,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_token_counts": token_counts.op9_token_counts,
    "op10_mixing": mixing.op10_mixing,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_collocations": collocations.op12_collocations,
    "op13_decontamination": decontaminate.op13_decontamination,
}

# the others depend on tokenizers, fitted models, hashes or coins; tests hold them against brute force
ORACLES = {
    "op8_exact_dedup": exact_dedup.ORACLE,
    "op11_conversation_repair": conversation_repair.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_decontamination": decontaminate.ORACLE,
}

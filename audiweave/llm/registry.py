"""Queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from audiweave.llm import centroids, chat, decontaminate, jaccard_join, language, licenses, minhash, packing, pii, quality, resample, rules, urls

QUERIES = {
    "op1_chat_format": chat.op1_chat_format,
    "op8_license_scan": licenses.op8_license_scan,
    "op6_url_filters": urls.op6_url_filters,
    "op7_quality_rules": rules.op7_quality_rules,
    "op2_quality_classifier": quality.op2_quality_classifier,
    "op9_language_id": language.op9_language_id,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_jaccard_join": jaccard_join.op4_jaccard_join,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op10_personal_data": pii.op10_personal_data,
    "op11_minhash_dedup": minhash.op11_minhash_dedup,
    "op12_centroid_clusters": centroids.op12_centroid_clusters,
    "op13_importance_resampling": resample.op13_importance_resampling,
}

ORACLES = {
    "op4_jaccard_join": jaccard_join.ORACLE,
    "op5_decontaminate": decontaminate.ORACLE,
    "op11_minhash_dedup": minhash.ORACLE,
    "op12_centroid_clusters": centroids.ORACLE,
}

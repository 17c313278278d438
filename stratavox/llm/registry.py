"""The corpus operators' queries and, where SQL can express them, their oracles."""

from __future__ import annotations

from . import bpe, centroids, html, licenses, media, mixing, negatives, packing, pii, quality, simhash, toxicity, urls

QUERIES = {
    "op1_simhash_components": simhash.query,
    "op2_boosted_toxicity": toxicity.query,
    "op3_license_scan": licenses.query,
    "op4_ngram_quality": quality.query,
    "op5_chunked_media": media.query,
    "op6_best_fit_packing": packing.query,
    "op7_crf_pii": pii.query,
    "op8_url_filter": urls.query,
    "op9_html_text": html.query,
    "op10_byte_bpe": bpe.query,
    "op11_centroid_tables": centroids.query,
    "op12_source_schedule": mixing.query,
    "op13_angular_negatives": negatives.query,
}
ORACLE_SQL: dict[str, str] = {
    "op8_url_filter": urls.ORACLE_SQL,
    "op11_centroid_tables": centroids.ORACLE_SQL,
    "op12_source_schedule": mixing.ORACLE_SQL,
    "op13_angular_negatives": negatives.ORACLE_SQL,
}

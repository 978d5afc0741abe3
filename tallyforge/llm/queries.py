"""The subpackage's queries, and their SQL where it can express them."""

from __future__ import annotations

from . import centroids, jaccard, language, media, mixture, pieces, quality, repeats, replies, resample, shards, token_count, url_filter

QUERIES = {
    "op1_sentencepiece": pieces.op1_sentencepiece,
    "op10_jaccard_join": jaccard.op10_jaccard_join,
    "op11_importance_resampling": resample.op11_importance_resampling,
    "op12_centroids": centroids.op12_centroids,
    "op13_chat_formatting": replies.op13_chat_formatting,
    "op2_media_columns": media.op2_media_columns,
    "op3_url_filters": url_filter.op3_url_filters,
    "op4_language_id": language.op4_language_id,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_suffix_dedup": repeats.op6_suffix_dedup,
    "op7_sharding": shards.op7_sharding,
    "op8_mixing": mixture.op8_mixing,
    "op9_token_counts": token_count.op9_token_counts,
}

SQL = {"op3_url_filters": url_filter.SQL, "op8_mixing": mixture.SQL, "op12_centroids": centroids.SQL, "op13_chat_formatting": replies.SQL}

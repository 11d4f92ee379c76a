"""Queries of the operators and the pipeline, and their SQL twins."""

from __future__ import annotations

import corpus_pipeline
from tickloom.llm import (
    classifier,
    copies,
    fertility,
    jaccard,
    lines,
    mixing,
    negatives,
    packing,
    pii,
    secrets,
    tokens,
    topk,
    whitening,
)

QUERIES = {
    "op1_norm_buckets": topk.query,
    "op2_pii_spans": pii.query,
    "op3_chosen_path_join": jaccard.query,
    "op4_line_dedup": lines.query,
    "op5_token_fertility": fertility.query,
    "op6_secret_ledger": secrets.query,
    "op7_quality_score": classifier.query,
    "op8_source_schedule": mixing.query,
    "op9_length_buckets": packing.query,
    "op10_wavelet_shards": tokens.query,
    "op11_threshold_negatives": negatives.query,
    "op12_bloom_dedup": copies.query,
    "op13_lanczos_whitening": whitening.query,
    "pipeline": corpus_pipeline.run,
}
ORACLE = {
    "op1_norm_buckets": topk.SQL,
    "op4_line_dedup": lines.SQL,
    "op6_secret_ledger": secrets.SQL,
    "op8_source_schedule": mixing.SQL,
    "op11_threshold_negatives": negatives.SQL,
    "op12_bloom_dedup": copies.SQL,
}

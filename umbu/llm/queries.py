"""The queries of the operators, each with SQL for the same rows where SQL can say it."""

from __future__ import annotations

from umbu.llm import (
    alignment,
    decontamination,
    divergence,
    language_id,
    line_dedup,
    maxscore,
    near_duplicates,
    neighbours,
    packing,
    quality,
    secrets,
    sharding,
    warc,
)
from umbu.queries.registry import Query

QUERIES: dict[str, Query] = {
    "op1_language_id": Query(language_id.op1_language_id, None),
    "language_id_pages": Query(language_id.language_id_pages, None),
    "op2_best_fit_packing": Query(packing.op2_best_fit_packing, None),
    "op3_simhash_near_dedup": Query(near_duplicates.op3_simhash_near_dedup, None),
    "op4_kd_sharding": Query(sharding.op4_kd_sharding, None),
    "op5_nn_descent": Query(neighbours.op5_nn_descent, None),
    "op6_warc_zstd": Query(warc.op6_warc_zstd, warc.SQL),
    "op7_line_dedup": Query(line_dedup.op7_line_dedup, None),
    "op8_quality_embeddings": Query(quality.op8_quality_embeddings, None),
    "op9_secret_scan": Query(secrets.op9_secret_scan, secrets.SQL),
    "op10_benchmark_decontamination": Query(
        decontamination.op10_benchmark_decontamination, decontamination.SQL
    ),
    "op11_source_divergence": Query(divergence.op11_source_divergence, divergence.SQL),
    "op12_tokenizer_alignment": Query(alignment.op12_tokenizer_alignment, None),
    "op13_maxscore_topk": Query(maxscore.op13_maxscore_topk, maxscore.SQL),
}

"""The queries of the training-data operators, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from . import decontaminate, language_id, licenses, mixing, mpeg_audio, ngram_join, pii, sharding, toxicity, url_filter

QUERIES = {
    "op1_histogram_sharding": sharding.op1_histogram_sharding,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_license_scan": licenses.op3_license_scan,
    "op4_mpeg_audio": mpeg_audio.op4_mpeg_audio,
    "op5_language_id": language_id.op5_language_id,
    "op6_ngram_jaccard_join": ngram_join.op6_ngram_jaccard_join,
    "op7_source_mixing": mixing.op7_source_mixing,
    "op8_pii": pii.op8_pii,
    "op9_benchmark_decontamination": decontaminate.op9_benchmark_decontamination,
    "op10_url_filter": url_filter.op10_url_filter,
}

ORACLE_SQL = {**ngram_join.ORACLE_SQL, **decontaminate.ORACLE_SQL, **url_filter.ORACLE_SQL}

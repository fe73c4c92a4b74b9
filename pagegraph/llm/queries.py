"""The registered queries of the operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pagegraph.llm import (
    bpe,
    clustering,
    extraction,
    fingerprint,
    katz,
    langid,
    licenses,
    mixing,
    neardup,
    quality,
    sharding,
    toxicity,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": mixing.op1_mix_sources,
    "op2_fingerprint_multiset": fingerprint.op2_fingerprint_multiset,
    "op3_shard_jump": sharding.op3_shard_jump,
    "op4_katz_scores": katz.op4_katz_scores,
    "op5_license_scan": licenses.op5_license_scan,
    "op6_language_id": langid.op6_language_id,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_quality_ledger": quality.op8_quality_ledger,
    "op9_bpe_digests": bpe.op9_bpe_digests,
    "op10_simhash_components": neardup.op10_simhash_components,
    "op11_lanczos_whitening": whitening.op11_lanczos_whitening,
    "op12_lloyd_shards": clustering.op12_lloyd_shards,
    "op13_nearest_url_text": extraction.op13_nearest_url_text,
}

ORACLES: dict[str, str] = {
    "op1_mix_sources": mixing.OP1_SQL,
    "op8_quality_ledger": quality.OP8_SQL,
    "op12_lloyd_shards": clustering.OP12_SQL,
}

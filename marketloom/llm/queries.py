"""The operators of this subpackage as registered queries, with their SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import (
    decontamination,
    licenses,
    linededup,
    lmscore,
    mixing,
    neardup,
    quality,
    search,
    sharding,
    spelling,
    toxicity,
    urlfilter,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _on(operator: Callable[..., DataFrame], *names: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: operator(*(table(spark, folder, n) for n in names))


def _pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_near_dedup": _on(neardup.near_duplicates, "documents"),
    "op2_license_scan": _on(licenses.license_digest, "documents"),
    "op3_decontamination": _on(decontamination.contaminated, "documents", "benchmark"),
    "op4_quality_rules": _on(quality.quality_digest, "documents"),
    "op5_url_filter": _on(urlfilter.url_digest, "pages"),
    "op6_lm_scoring": _on(lmscore.score_documents, "documents"),
    "op7_sharding": _on(sharding.shard_digest, "documents"),
    "op8_mixing": _on(mixing.mix_digest, "documents"),
    "op9_toxicity": _on(toxicity.toxicity_digest, "documents", "labels"),
    "op10_line_dedup": _on(linededup.dedup_lines, "documents"),
    "op11_spelling_variants": _on(spelling.variant_groups, "documents"),
    "op12_ranked_search": _on(search.search_digest, "documents", "benchmark"),
    "op13_warc": _on(warc.warc_digest, "pages"),
    "pipeline": _pipeline,
}
ORACLES: dict[str, str] = {
    "op1_minhash_near_dedup": neardup.digest_sql(),
    "op2_license_scan": licenses.digest_sql(),
    "op4_quality_rules": quality.digest_sql(),
    "op5_url_filter": urlfilter.digest_sql(),
    "op7_sharding": sharding.digest_sql(),
    "op8_mixing": mixing.digest_sql(),
    "op11_spelling_variants": spelling.digest_sql(),
    "op12_ranked_search": search.digest_sql(),
    "op13_warc": warc.digest_sql(),
}

"""The registered queries of the corpus operators, with production parameters.

Each reads whole tables. ``ORACLE`` (module ``oracle``) has the SQL of those that
SQL can express; the others are tested against brute force in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from fieldrank.llm import collocations, decontamination, language, licenses, mixing, packing, prefix_trie, quality, sharding, simhash, token_counts, warc, wrappers
from fieldrank.llm.common import table

N_SHARDS = 24
MIX_SHARDS = 8


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.contamination(docs, items).drop("spans")


def op2_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_sequences(table(spark, sf_dir, "documents"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scanned(table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolved_pages(table(spark, sf_dir, "pages"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.clustered(table(spark, sf_dir, "documents"))


def op6_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrappers.extracted(table(spark, sf_dir, "pages"))


def op7_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"), [1.0] * N_SHARDS)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.report(table(spark, sf_dir, "documents"))


def op9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"), MIX_SHARDS)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_pack": op2_pack,
    "op3_licenses": op3_licenses,
    "op4_warc": op4_warc,
    "op5_simhash": op5_simhash,
    "op6_extract": op6_extract,
    "op7_shard": op7_shard,
    "op8_quality": op8_quality,
    "op9_mix": op9_mix,
    "op10_language": op10_language,
    "op11_collocations": op11_collocations,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}

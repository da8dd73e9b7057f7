"""Registered queries of the training-data operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from listmill.llm import bpe, counts, decontaminate, embeddings, langid, lexical, licenses, lm, mixing, ngram_join, pii, sharding, variants

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_sharding(spark, sf):
    return sharding.report(table(spark, sf, "documents"), shards=8)


@query
def op2_embedding_near_dup(spark, sf):
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


@query
def op3_language_id(spark, sf):
    return langid.identify(table(spark, sf, "documents"))


@query
def op4_license_scan(spark, sf):
    return licenses.report(table(spark, sf, "documents"))


@query
def op5_personal_data(spark, sf):
    return pii.report(table(spark, sf, "documents"))


@query
def op6_ngram_jaccard(spark, sf):
    return ngram_join.jaccard_components(table(spark, sf, "documents"), n=4, percent=85)


@query
def op7_byte_bpe(spark, sf):
    return bpe.digests(spark, table(spark, sf, "documents"), RANKS)


@query
def op8_lm_scores(spark, sf):
    return lm.scores(table(spark, sf, "documents"), RANKS)


@query
def op9_benchmark_decontamination(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


ORACLES["op9_benchmark_decontamination"] = decontaminate.SQL


@query
def op10_token_counts(spark, sf):
    return counts.token_counts(table(spark, sf, "documents"), VOCABULARY, limit=1024)


@query
def op11_curriculum_mix(spark, sf):
    return mixing.report(table(spark, sf, "documents"))


ORACLES["op11_curriculum_mix"] = mixing.SQL


@query
def op12_spelling_variants(spark, sf):
    return variants.groups(table(spark, sf, "documents"))


@query
def op13_ranked_search(spark, sf):
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=50)


ORACLES["op13_ranked_search"] = lexical.SQL

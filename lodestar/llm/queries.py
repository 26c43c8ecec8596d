"""Queries of the llm operators: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.llm import (cube_mix, lexical_search, lookup_kmeans, pattern_packing, pq_dedup, revisit, secret_scan, simhash_vp, site_quality,
                          string_tiling, token_scan, toxicity, url_rules)
from lodestar.llm.common import table


def word_tokenizer() -> str:
    """The public word-level BPE vocabulary that the packing contract names."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document of flat token files written from ``documents``."""
    import public_tokenizers
    folder = token_scan.scratch(spark, "flat-tokens")
    token_scan.write_flat(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.tiktoken"), separator=50256)
    found = token_scan.count_tokens(spark, folder, separator=50256)
    return found.select(F.regexp_extract("file", r"part-(\d+)", 1).cast("long").alias("part"), "doc", "start", "tokens", "ended")


def op2_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_scan.scan(docs, secret_scan.fit(docs))


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 304 among the captures made from ``pages``; headers as ``name: value`` lines."""
    found = revisit.resolve(revisit.captures(table(spark, sf_dir, "pages")))
    lines = F.array_join(F.transform("headers", lambda e: F.concat(e["name"], F.lit(": "), e["value"])), "\n")
    return found.withColumn("headers", lines)


def op4_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``source`` is the host, ``lang`` the path."""
    return site_quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op6_product_quantisation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op7_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return string_tiling.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_url_association_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op9_simhash_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_vp.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op10_pattern_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pattern_packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


def op11_pipelined_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_lookup_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_kmeans.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, salt="3")


def op13_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cube_mix.mix(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_separator_scan,
    op2_secret_scans,
    op3_warc_revisits,
    op4_site_quality,
    op5_toxicity_ordinal,
    op6_product_quantisation,
    op7_string_tiling,
    op8_url_association_rules,
    op9_simhash_vp_trees,
    op10_pattern_packing,
    op11_pipelined_terms,
    op12_lookup_kmeans,
    op13_cube_mix,
)}

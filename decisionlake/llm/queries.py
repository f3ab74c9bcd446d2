"""Registered queries of the operators: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.llm import ann_scan, chain_dedup, conversation_repair, fair_mix, lattice_lm, minhash_tensor, robust_quality, run_index, token_links, token_orc, toxicity, warc_index, winnowing
from decisionlake.sources.storage import table_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Where a file of the public tokenizers is, on the driver and on every executor alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op3_token_orc(spark, sf_dir):
    path = table_path(spark, "tokens-orc", uuid.uuid4())
    token_orc.write_tokens(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"))
    return token_orc.token_digests(spark, path)


@query
def op4_fair_mix(spark, sf_dir):
    return fair_mix.per_row(fair_mix.fair_mix(table(spark, sf_dir, "documents")))


@query
def op8_warc_index(spark, sf_dir):
    folder = table_path(spark, "warc", uuid.uuid4())
    index = warc_index.write_warc(table(spark, sf_dir, "pages"), folder)
    return warc_index.read_records(index, folder).drop("url")


@query
def op6_winnowing(spark, sf_dir):
    found = winnowing.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("digest")


@query
def op2_minhash_tensor(spark, sf_dir):
    return minhash_tensor.near_duplicates(table(spark, sf_dir, "documents")).drop("digest")


@query
def op10_toxicity(spark, sf_dir):
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_lattice_lm(spark, sf_dir):
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lattice_lm.score(table(spark, sf_dir, "documents"), held_out, vocabulary("piece_bpe_32k.model"))


@query
def op5_ann_scan(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return ann_scan.search(ann_scan.build(vectors), vectors.filter("vec_id % 20 = 0"))


@query
def op9_run_index(spark, sf_dir):
    return run_index.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op7_chain_dedup(spark, sf_dir):
    return chain_dedup.remove_chained(table(spark, sf_dir, "documents"))


@query
def op13_token_links(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return token_links.token_links(docs, vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


@query
def op11_conversation_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_robust_quality(spark, sf_dir):
    return robust_quality.robust_quality(table(spark, sf_dir, "documents")).drop("distance")

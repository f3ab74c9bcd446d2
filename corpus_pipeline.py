"""A corpus made ready for training: reject, deduplicate, decontaminate, mix, encode.

Each stage takes what the one before has kept, as written and read again, and calls one operator.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from decisionlake.llm import fair_mix, minhash_tensor, token_orc, toxicity, winnowing
from decisionlake.llm.queries import table, vocabulary
from decisionlake.sources.storage import cut, table_path


def _unused(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name = "_" + name
    return name


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model scores below one half."""
    score = _unused(docs, "_toxicity")
    scored = toxicity.scored(docs, table(spark, sf_dir, "labels"), score)
    return scored.filter(F.col(score) < 0.5).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near-duplicates the document with the smallest id; of repeated rows one."""
    found = minhash_tensor.near_duplicates(docs)
    group = [F.col("component_id"), F.col("n_shingles") == 0, F.when(F.col("component_id").isNull(), F.col("digest"))]
    kept = found.groupBy(*group).agg(F.min(F.struct("doc_id", "digest")).alias("k")).select("k.doc_id", "k.digest")
    kept = cut(kept, "kept").withColumnsRenamed({"doc_id": "_kept_id", "digest": "_kept_digest"})
    digest = _unused(docs, "_digest")
    rows = docs.withColumn(digest, F.xxhash64(F.coalesce("text", F.lit(""))))
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col("_kept_id")) & (F.col(digest) == F.col("_kept_digest"))
    return rows.join(kept, same, "left_semi").dropDuplicates(["doc_id", digest]).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    found = winnowing.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    hit = found.filter("contaminated").select(F.col("digest").alias("_hit")).distinct()
    return docs.join(hit, F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("_hit"), "left_anti")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix, each as often as it is taken."""
    return fair_mix.mixed_documents(docs)


def write_token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of the documents, and what is read back from them per document."""
    path = table_path(spark, "pipeline-tokens", uuid.uuid4())
    token_orc.write_tokens(docs, path, vocabulary("word_bpe_49k.json"))
    return token_orc.token_digests(spark, path)


STAGES = [
    ("toxicity", reject_toxic),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token ids", write_token_ids),
]

#: The toxicity model is fitted, which SQL cannot express; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)

"""A training-data pipeline: toxicity, exact dedup, near dedup, decontamination, packing. Each stage's result is written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqloom.llm import decontam, exact, minhash, packing, toxicity
from seqloom.llm._shared import Workspace, scratch


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects the documents that a model of ``labels`` predicts as toxic. A document without a doc_id stays."""
    model = toxicity.learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    toxic = toxicity.score(docs, model, spans=False).filter("predicted = 1").select("doc_id")
    return docs.join(toxic, "doc_id", "left_anti").select(docs.columns)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.drop_exact(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays that five-word shingles link at a similarity of 0.8.

    Five words, as for every stage on shingles that has no contract of its own; op4's query takes two by its contract and so
    links more.
    """
    return minhash.drop_near(docs, width=5, percent=80)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontam.leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_digest(docs, public_tokenizers.path("byte_bpe_50k.json"), "byte", end_id=2, capacity=1024)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("exact dedup", without_copies),
    ("MinHash near-dedup", without_near_copies),
    ("benchmark decontamination", without_leaks),
    ("best-fit packing", packed),
]

#: No SQL: toxicity is a trained model and packing an iterative placement. tests/llm compares stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        with scratch():  # what a stage has written besides its result goes when the result is there
            docs = ws.save(stage(spark, docs, sf_dir), f"stage-{k}")
        if k:
            ws.drop(f"stage-{k - 1}")
    return docs

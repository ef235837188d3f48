"""The corpus pipeline: toxic documents go, bad ones go, one of each near-duplicate group stays, personal data is masked, the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of the documents, whatever
else they are called.  Each is written and read again, so a lost executor costs one stage's tasks at most.

Cases: null ids pass through every stage and are packed like others (near-duplicates are only looked for among rows that have one); a null or empty text has
no words and goes with the quality rules; very long texts are judged, compared, masked and cut whole; rows that repeat an id
and text are judged alike and stay or go together, of documents with equal or near-equal texts the smallest id stays; an empty
table passes every stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiloom.llm import near_dedup, packing, pii, quality, toxicity
from lexiloom.session import written

#: Trained, masked and packed rows can't be expressed in SQL; tests/llm/test_pipeline.py holds each stage against brute force.
ORACLE_SQL = None


def stage_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger, trained on the labels outside the held-out fold, doesn't call toxic."""
    tagger = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.not_toxic(docs, tagger)


def stage_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose posterior quality the voting rules find good, short ones too."""
    return quality.good_documents(docs)


def stage_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each near-duplicate group (five-word shingles, similarity 0.8)."""
    found = written(near_dedup.near_duplicates(docs, width=5, percent=80), "groups")
    gone = found.filter("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")


def stage_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in their texts."""
    return pii.redacted(docs)


def stage_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their places in sequences of 1024."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", stage_toxicity),
    ("quality rules", stage_quality),
    ("MinHash near-dedup", stage_near_dedup),
    ("PII", stage_pii),
    ("best-fit packing", stage_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name.split()[0]}")
    return STAGES[-1][1](spark, docs, sf_dir)

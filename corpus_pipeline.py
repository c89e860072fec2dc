"""The corpus pipeline: documents to token ids, in five stages.

Each stage works on all documents that the one before kept; its result is written as
Parquet and read again. All but the last return the columns of `documents`.
"""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline.llm import byte_bpe, common, decontaminate, line_dedup, simhash, toxicity
from tramline.session import materialise

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
# The labels of one fold are left to check the classifier with.
FOLDS, HELD_OUT = 4, 2
TOXIC_FROM = 0.3


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score as toxic."""
    labels = common.table(spark, sf_dir, "labels").filter(common.fold("doc_id", FOLDS) != HELD_OUT)
    sample = common.labelled_sample(docs, labels, "toxic", toxicity.SAMPLE_ROWS, toxicity.SEED)
    return toxicity.reject(docs, toxicity.fit(sample), TOXIC_FROM)


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out lines of which the corpus has a near copy further up; documents stay, even empty."""
    kept = line_dedup.deduplicate(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of near copies."""
    return simhash.keep_one(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that contain a benchmark item."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with digests of the ids and of the bytes they decode to."""
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    coded = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path, pattern)
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("ids", "decoded")]
    return coded.select("doc_id", "n_tokens", *digests)


STAGES = [
    ("toxicity", toxic),
    ("line_dedup", repeated_lines),
    ("simhash_dedup", near_copies),
    ("decontamination", benchmark_leaks),
    ("byte_bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# Trained scores, MinHash and byte-pair merges are beyond SQL; tests compare plain versions.
ORACLE_SQL = None

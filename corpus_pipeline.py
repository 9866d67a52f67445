"""The training-corpus pipeline: each stage's rows are written as Parquet and read by the next.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame. All
but the last return the columns of ``documents``; a stage works on all that its predecessor kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tessera.llm.bpe import bpe_encode, digest
from tessera.llm.decontaminate import drop_contaminated
from tessera.llm.near_dups import keep_one
from tessera.llm.quality import keep_good
from tessera.llm.secrets import redact
from tessera.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    return keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the secrets in its text are replaced by a mark and n_chars counted anew."""
    return redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of every document, as counts and digests."""
    return digest(bpe_encode(docs))


STAGES = [
    ("quality", quality),
    ("near duplicates", near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", secrets),
    ("bpe", encode),
]

#: Near-duplicate components and BPE merging aren't expressible in SQL; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for k, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{k}-{name.replace(' ', '_')}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

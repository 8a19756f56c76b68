"""The corpus pipeline: quality, boilerplate lines, near duplicates, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.llm.common import table, unused
from verity.llm.line_dedup import line_dedup
from verity.llm.ngram_join import keep_one
from verity.llm.packing import pack_documents
from verity.llm.quality import keep_good
from verity.session import ensure_checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without cross-site boilerplate lines; a document that had nothing else goes."""
    added = tuple(unused(docs.columns, x) for x in ("n_lines", "n_removed", "words_left"))
    cleaned = line_dedup(docs, added=added).filter(F.col(added[2]))
    if "n_chars" in docs.columns:
        chars = F.when(F.col(added[1]) > 0, F.length("text")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", chars.cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents left, in training sequences."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("packing", packing)]

#: The classifier and the tokenizer are not expressible in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; what passes between them lies in spark.checkpoint.dir."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

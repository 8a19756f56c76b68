"""Table scans.

A table is a parquet directory/file under a root folder.  Reads never select
``*`` beyond what the caller projects: Catalyst prunes columns and pushes
filters into the parquet scan, so callers just select what they need.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")


def utc(c) -> F.Column:
    """TIMESTAMP_NTZ columns from parquet as instants (session time zone UTC)."""
    return F.col(c).cast("timestamp")


def question_documents(documents: DataFrame) -> DataFrame:
    """Question documents with the projection the generator asks for (S2).

    Only ``_id``, ``question_title``, ``question_content`` and ``best_answer``
    are read; with parquet/orc the pruning reaches the file scan.
    """
    return documents.select(F.col("_id").cast("string").alias("_id"), "question_title",
                            "question_content", "best_answer")


def scan_questions(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``question_documents`` of a stored collection."""
    return question_documents(spark.read.format(fmt).load(path))

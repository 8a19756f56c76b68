"""Exact deduplication by sorting content.

Texts are normalised (each run of white space becomes one space) and range-partitioned by sampled
splitters, sorted within partitions by the external sort, and compared in full with their
neighbours, so equal texts form runs.  The splitters see a short head of the text, a hash of the
whole and a salt, never whole texts: equal heads and long common beginnings spread, and a run is
cut into as many pieces as there are salts, so no task gets a hot group.  The pieces of a run, one
narrow row each, meet by digest; the smallest identifier stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from verity.session import checkpoint

SPACES = r"[\x20\x09-\x0D]+"
#: The same replacement, matching only where it changes something.
CHANGED = r"[\x20\x09-\x0D]{2,}|[\x09-\x0D]"
HEAD = 32

ORACLE = f"""
SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '{SPACES}', ' ', 'g') AS t FROM documents)
"""


def exact_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per row of ``docs`` (columns doc_id, text).

    A null text counts as empty.  Rows that repeat a doc_id are separate; of those with the smallest
    one of a group, one is kept.  A null doc_id never beats another; a group of nulls alone keeps
    one row, its keep_id null.  An empty table gives no rows.
    """
    salts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), CHANGED, " ")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("t")).select(
        "doc_id", "t", F.substring("t", 1, HEAD).alias("head"), F.xxhash64("t").alias("hash"),
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"),
    )
    run = Window.partitionBy("head", "hash", "t", "salt").orderBy(F.col("doc_id").asc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    pieces = checkpoint(
        rows.repartitionByRange("head", "hash", "salt").select(
            "doc_id", "salt", F.sha2("t", 256).alias("text_sha256"), F.row_number().over(run).alias("place"),
            F.min("doc_id").over(whole).alias("least"), F.count(F.lit(1)).over(whole).alias("size"),
        )
    )
    by_piece = pieces.groupBy("text_sha256", "salt").agg(F.min("least").alias("least"), F.min("size").alias("size"))
    by_text = by_piece.groupBy("text_sha256").agg(F.min("least").alias("keep_id"), F.sum("size").alias("group_size"))
    named = by_piece.select("text_sha256", "salt").join(by_text, "text_sha256")
    return pieces.join(named, ["text_sha256", "salt"]).select(
        "doc_id", "keep_id", "group_size",
        ((F.col("place") == 1) & F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"), "text_sha256",
    )

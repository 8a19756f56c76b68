"""WARC archives: writing with revisit records, and reading verified record by record.

Writing: pages with equal payloads of at least ``REVISIT_BYTES`` are stored once, by the smallest
page_id; the others become revisit records that refer to it.  Spark's text writer writes the
records, its line separator being the two line ends that close a record.

Reading: Spark's text reader splits the files at the version line, so any file splits over tasks
and no task holds one whole.  What it returns are candidates: a payload may hold a version line
too.  From the pieces' lengths each candidate's offset follows (running sums per split, then over
the splits of a file), and from its header the offset of its successor.  Within a split, tasks
follow successors to where the chain leaves the split; over splits, pointer jumping from offset 0
doubles the distance each round.  Only candidates that the chain from the file's start reaches are
records; the others are parts of the record before them, and are put back into it.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verity.session import checkpoint, ensure_checkpoint_dir

MAGIC = "WARC/1.1\r\n"
RECORD_END = "\r\n\r\n"
REVISIT_BYTES = 100
#: So many narrow rows (revisits, pieces that are not whole records; about 150 bytes each) are broadcast at most.
BROADCAST_ROWS = 200_000
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: What ``round_trip`` returns, for DuckDB.
ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes, sha256(html) AS payload_digest FROM p),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS least FROM s)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= {REVISIT_BYTES} AND page_id <> least THEN least END AS refers_to
FROM g
"""


def _few(rows: DataFrame) -> DataFrame:
    """``rows`` (materialised and narrow), to be broadcast if there are at most ``BROADCAST_ROWS``."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def plan_records(pages: DataFrame) -> DataFrame:
    """page_id, url, html ('' for null), digest, refers_to (null: a response) per row of ``pages``.

    Rows that share a group's smallest page_id are all responses; a null page_id is never the
    smallest, and a group of nulls alone has responses only.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("digest", F.sha2("html", 256))
    long = rows.select("page_id", "digest", F.octet_length("html").alias("size")).filter(F.col("size") >= REVISIT_BYTES)
    first = long.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).filter("copies > 1 AND refers_to IS NOT NULL")
    again = (
        long.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("refers_to")))
        .select(F.col("page_id").alias("again_id"), F.col("digest").alias("again_digest"), "refers_to").distinct()
    )
    again = _few(checkpoint(again))
    return rows.join(again, rows.page_id.eqNullSafe(again.again_id) & (rows.digest == again.again_digest), "left").drop("again_id", "again_digest")


def write_warc(pages: DataFrame, folder: str) -> None:
    """Write one record per row of ``pages`` (page_id, url, html) as uncompressed WARC files.

    The record id is ``urn:page:<page_id>`` (empty after the colon for a null).  Line ends in a url are
    written percent-encoded; a null url has no target header.
    """
    rows = plan_records(pages)
    revisit = F.col("refers_to").isNotNull()
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    key = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(">\r\n"))
    head = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), key("page_id"), F.lit(f"WARC-Date: {DATE}\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), url, F.lit("\r\n")), F.lit("")),
        F.lit("WARC-Payload-Digest: sha256:"), "digest", F.lit("\r\n"),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), key("refers_to"))).otherwise(""),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, 0).otherwise(F.octet_length("html")).cast("string"), F.lit(RECORD_END),
    )
    rows.select(F.concat(head, F.when(revisit, "").otherwise(F.col("html"))).alias("value")).write.option("lineSep", RECORD_END).text(folder)


def _header(name: str) -> F.Column:
    """A header's value; names go without case, white space around the value does not count."""
    return F.regexp_extract("header", rf"(?i)(?:\A|\r\n){name}:[ \t]*([^\r\n]*?)[ \t]*(?:\r\n|\z)", 1)


def _pinned(spark: SparkSession) -> SparkSession:
    """A session like ``spark`` whose file splits no longer change.

    The archives are scanned twice, for the chain and for the data, and rows are known by their split and
    place in it.  By default Spark sizes splits by the executors there are when a scan is planned, so one
    that is lost or gained in between would shift them.
    """
    own = spark.newSession()
    for name, value in dict(spark.conf.getAll).items():
        if name.startswith("spark.sql.") and spark.conf.isModifiable(name):
            own.conf.set(name, value)
    if not own.conf.get("spark.sql.files.minPartitionNum", None):
        own.conf.set("spark.sql.files.minPartitionNum", str(spark.sparkContext.defaultParallelism))
    return own


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """The parts between version lines, in file order by (block, at)."""
    rows = spark.read.option("lineSep", MAGIC).text(folder)
    data = F.col("value").cast("binary")
    end = F.instr("value", RECORD_END)
    return rows.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        data.alias("data"), F.octet_length("value").cast("bigint").alias("size"), F.when(end > 0, F.substring("value", F.lit(1), end - 1)).alias("header"),
    )


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """For each candidate of a split, where its chain leaves the split."""
    group = group.sort_values("offset", kind="stable")
    offset, successor = group["offset"].to_numpy(), group["successor"].to_numpy()
    place = np.searchsorted(offset, successor)
    inside = (place < len(offset)) & (offset[np.minimum(place, len(offset) - 1)] == successor) & (successor > offset)
    leaves = successor.copy()
    for i in range(len(offset) - 1, -1, -1):
        if inside[i]:
            leaves[i] = leaves[place[i]]
    return pd.DataFrame({"file": group["file"], "offset": offset, "successor": leaves})


def _walked(group: pd.DataFrame) -> pd.DataFrame:
    """The pieces of a split with the record that owns each (-1: one that began in an earlier split)."""
    group = group.sort_values("offset", kind="stable")
    offset, successor = group["offset"].to_numpy(), group["successor"].to_numpy()
    reached = np.zeros(len(group), bool)
    for i in np.flatnonzero(group["entry"].to_numpy()):
        while i < len(offset) and not reached[i]:
            reached[i] = True
            if successor[i] <= offset[i]:
                break
            j = int(np.searchsorted(offset, successor[i]))
            if j >= len(offset) or offset[j] != successor[i]:
                break
            i = j
    owner = np.maximum.accumulate(np.where(reached, offset, -1))
    return pd.DataFrame({"file": group["file"], "block": group["block"], "at": group["at"], "offset": offset, "owner": owner, "size": group["size"]})


def verified_pieces(pieces: DataFrame) -> DataFrame:
    """file, block, at, offset, owner of each piece: owner is the offset of its record, -1 if that began
    in an earlier split (or there is none)."""
    header_bytes = F.octet_length("header") + len(RECORD_END)
    length = F.expr(r"try_cast(regexp_extract(header, '(?i)(?:\\A|\r\n)Content-Length:[ \t]*([0-9]{1,15})[ \t]*(?:\r\n|\\z)', 1) as bigint)")
    parts = checkpoint(pieces.select("file", "block", "at", "size", (header_bytes + length + len(RECORD_END) + len(MAGIC)).alias("step")))
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    blocks = parts.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("total"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = blocks.select("file", "block", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    placed = (
        parts.withColumn("run", F.coalesce(F.sum(F.col("size") + len(MAGIC)).over(before), F.lit(0)))
        .join(base, ["file", "block"])
        .withColumn("offset", F.col("base") + F.col("run") - len(MAGIC))
        .withColumn("successor", F.col("offset") + F.coalesce("step", F.lit(0)))
        .select("file", "block", "at", "offset", "successor", "size")
    )
    placed = checkpoint(placed)

    chain = placed.filter((F.col("offset") >= 0) & (F.col("successor") > F.col("offset")))
    leaves = checkpoint(chain.groupBy("file", "block").applyInPandas(_exits, "file string, offset bigint, successor bigint"))
    # Splits' possible entries: the files' starts, and candidates where a chain from another split arrives.
    arrivals = leaves.select("file", F.col("successor").alias("offset")).distinct()
    nodes = checkpoint(leaves.filter("offset > 0").join(arrivals, ["file", "offset"], "left_semi").unionByName(leaves.filter("offset = 0")))
    known = nodes.select("file", F.col("offset").alias("successor"))
    jump = checkpoint(nodes.join(known, ["file", "successor"], "left_semi").select("file", "offset", "successor"))
    entries = nodes.filter("offset = 0").select("file", "offset")
    while jump.head(1):
        reached = entries.join(jump, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        entries = checkpoint(entries.unionByName(reached).distinct())
        onward = jump.select("file", F.col("offset").alias("successor"), F.col("successor").alias("onward"))
        jump = checkpoint(jump.join(onward, ["file", "successor"]).select("file", "offset", F.col("onward").alias("successor")))

    marked = placed.join(entries.withColumn("entry", F.lit(True)), ["file", "offset"], "left").withColumn("entry", F.coalesce("entry", F.lit(False)))
    kind = "file string, block bigint, at bigint, offset bigint, owner bigint, size bigint"
    return checkpoint(marked.groupBy("file", "block").applyInPandas(_walked, kind))


def read_warc(spark: SparkSession, folder: str) -> DataFrame:
    """record_type, page_id, url, digest, refers_to, payload (binary), problem of every record in ``folder``.

    Header names go without case.  Bytes that no chain from a file's start reaches as a record (a broken
    header, a tail cut off) belong to the record before them, whose payload is cut to its stated length.
    A record that states no length is returned with all bytes up to the next known record as payload and
    problem ``no length``; bytes before a file's first record with problem ``no record`` and nothing else
    but the payload.  problem is null for all others.  An empty file gives no rows.
    """
    pieces = _pieces(_pinned(spark), folder)
    found = verified_pieces(pieces)
    # A record that crosses splits: its later pieces look up the last record of the splits before.
    last = found.filter("owner >= 0").groupBy("file", "block").agg(F.max("owner").alias("own"))
    blocks = found.select("file", "block").distinct().join(last, ["file", "block"], "left")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("file", "block", F.last("own", ignorenulls=True).over(earlier).alias("carried"))
    owned = checkpoint(
        found.join(carried, ["file", "block"])
        .withColumn("owner", F.when(F.col("owner") >= 0, F.col("owner")).otherwise(F.col("carried")))
        .select("file", "at", "offset", "owner", "size")
    )
    # All but a few pieces are whole records: those that are not are looked up, so payloads stay where
    # they are read.  The few are broadcast up to a checked count, and joined by a shuffle beyond it.
    in_parts = owned.filter("owner IS NOT NULL AND offset <> owner").select("file", "owner").distinct()
    parts = checkpoint(owned.join(in_parts, ["file", "owner"]).select("file", "at", "offset", "owner"))
    rest = checkpoint(parts.select("file", "at").unionByName(owned.filter("owner IS NULL").select("file", "at")))
    data = pieces.select("file", "at", "data")
    joined = (
        data.join(_few(parts), ["file", "at"]).groupBy("file", "owner")
        .agg(F.array_sort(F.collect_list(F.struct("offset", "data"))).alias("all"))
        .select(F.expr(f"aggregate(slice(all, 2, size(all)), all[0].data, (x, y) -> concat(x, cast('{MAGIC.strip()}\r\n' as binary), y.data))").alias("data"))
    )
    records = data.join(_few(rest), ["file", "at"], "left_anti").select("data").unionByName(joined)
    end = F.instr(F.col("data").cast("string"), RECORD_END)
    stated = F.expr("try_cast(length as int)")
    rows = records.withColumn("header", F.substring(F.col("data").cast("string"), F.lit(1), end - 1))
    number = lambda name: F.expr(f"try_cast(regexp_extract({name}, '^<urn:page:(-?[0-9]+)>$', 1) as bigint)")
    body = (F.octet_length("header") + len(RECORD_END) + 1).cast("int")
    told = (
        rows.withColumn("length", _header("Content-Length")).select(
            _header("WARC-Type").alias("record_type"), _header("WARC-Record-ID").alias("key"), _header("WARC-Target-URI").alias("url"),
            F.regexp_extract("header", r"(?i)(?:\A|\r\n)WARC-Payload-Digest:[ \t]*sha256:([0-9a-f]{64})", 1).alias("digest"), _header("WARC-Refers-To").alias("refers"),
            F.when(stated.isNull(), F.substring(F.col("data"), body, F.octet_length("data"))).otherwise(F.substring(F.col("data"), body, stated)).alias("payload"),
            F.when(stated.isNull(), "no length").alias("problem"),
        )
        .select("record_type", number("key").alias("page_id"), "url", "digest", number("refers").alias("refers_to"), "payload", "problem")
    )
    lost = checkpoint(owned.filter("owner IS NULL AND size > 0").select("file", "at"))
    if not lost.head(1):
        return told
    none = [F.lit(None).cast(told.schema[c].dataType).alias(c) for c in told.columns[:-2]]
    return told.unionByName(data.join(_few(lost), ["file", "at"]).select(*none, F.col("data").alias("payload"), F.lit("no record").alias("problem")))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` to archives in spark.checkpoint.dir and read them back: page_id, payload_bytes,
    payload_digest, record_type, refers_to per row.

    Digest and length of a response come from its payload as read, those of a revisit from the
    response it refers to.  Nulls, repeats and empty payloads as in ``plan_records``; an empty table
    gives no rows.
    """
    spark = pages.sparkSession
    folder = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    write_warc(pages, folder)
    read = read_warc(spark, folder).select(
        "page_id", "record_type", "refers_to", "digest", F.octet_length("payload").cast("bigint").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest")
    )
    read = checkpoint(read)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)  # read whole, and kept in the checkpoint
    responses = read.filter("record_type = 'response'").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    stored = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    revisits = (
        read.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", F.col("digest").alias("payload_digest"))
        .join(stored, ["refers_to", "payload_digest"]).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )
    return responses.unionByName(revisits)

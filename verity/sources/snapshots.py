"""Versioned tables for upserts without a MERGE-capable table format.

A table is a folder of deltas ``v=<n>`` (one per micro-batch, zero-padded) and
bases ``base=<n>`` (everything up to batch ``n``), each a complete parquet
folder with ``_SUCCESS``.  Its content is the newest base and the deltas after
it, to be combined by the caller's mergeable aggregation.  A delta is written with
``overwrite``, so a replayed micro-batch rewrites the same delta.  Compaction
writes a base and then drops what the base before it already covers, so a
reader that started before keeps its files for one more compaction.  Only
folder names are listed on the driver (at most the deltas between two
compactions and two bases); rows never pass through it.

With ``key`` the rows of a delta or base lie in folders ``_bucket=<b>`` by a hash of that column, so a
reader that knows which keys it needs reads the folders of their buckets alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKET = "_bucket"
#: Buckets of a keyed table.  A delta has a file per bucket that its rows fall into.
BUCKETS = 32
_DELTA, _BASE = "v=", "base="
_WIDTH = 12


def _path(root: str, kind: str, version: int) -> str:
    return f"{root.rstrip('/')}/{kind}{int(version):0{_WIDTH}d}"


def version_path(root: str, version: int) -> str:
    return _path(root, _DELTA, version)


def _listed(spark: SparkSession, root: str, kind: str) -> list[int]:
    """Complete versions of a kind, ascending."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(kind) and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[len(kind):]))
    return sorted(out)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Complete deltas, ascending."""
    return _listed(spark, root, _DELTA)


def bucket_of(key: str) -> Column:
    """The bucket of a row (a NULL key has one too)."""
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(BUCKETS)).cast("int")


def buckets_of(ids: DataFrame, key: str) -> list[int]:
    """The buckets that the keys of ``ids`` fall into: at most ``BUCKETS`` numbers."""
    return sorted(r[0] for r in ids.select(bucket_of(key)).distinct().collect())


def _write(df: DataFrame, path: str, key: str | None) -> None:
    if key is None:
        df.write.mode("overwrite").parquet(path)
    else:
        rows = df.withColumn(BUCKET, bucket_of(key)).repartition(BUCKET)
        rows.write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def write_delta(df: DataFrame, root: str, version: int, key: str | None = None) -> None:
    """Write delta ``version``; one that a base covers already is left alone."""
    bases = _listed(df.sparkSession, root, _BASE)
    if not bases or bases[-1] < version:
        _write(df, version_path(root, version), key)


def current_parts(spark: SparkSession, root: str, upto: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
    """The rows of the newest base and of the deltas after it (up to ``upto``), to be combined;
    of a table written by key, only those of ``buckets`` if given."""
    bases = [b for b in _listed(spark, root, _BASE) if upto is None or b <= upto]
    first = bases[-1] if bases else -1
    paths = [_path(root, _BASE, first)] if bases else []
    paths += [version_path(root, v) for v in versions(spark, root) if v > first and (upto is None or v <= upto)]
    if not paths:
        return None
    # A part without rows may have no file, so no columns to read.
    held = {p: found for p in paths if (found := _content(spark, p))}
    if not held:
        return None
    rows = spark.read.option("recursiveFileLookup", True)
    if buckets is None or any(not x.startswith(f"{BUCKET}=") for found in held.values() for x in found):
        return rows.parquet(*held)
    wanted = {f"{BUCKET}={b}" for b in buckets}
    folders = [f"{p}/{x}" for p, found in held.items() for x in found if x in wanted]
    return rows.parquet(*folders) if folders else rows.parquet(next(iter(held))).filter("false")


def _content(spark: SparkSession, path: str) -> list[str]:
    """Names of the files or bucket folders of a part."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [st.getPath().getName() for st in p.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(p)]
    return [x for x in names if not x.startswith((".", "_")) or x.startswith(f"{BUCKET}=")]


def compact(spark: SparkSession, root: str, upto: int, combine: Callable[[DataFrame], DataFrame], key: str | None = None) -> None:
    """Fold everything up to delta ``upto`` into a base; drop what the base before it covers."""
    before = [b for b in _listed(spark, root, _BASE) if b < upto]
    parts = current_parts(spark, root, upto)
    if parts is None or upto in _listed(spark, root, _BASE):
        return
    _write(combine(parts), _path(root, _BASE, upto), key)
    if not before:
        return
    fs = spark._jvm.org.apache.hadoop.fs.Path(root).getFileSystem(spark._jsc.hadoopConfiguration())
    old = [_path(root, _BASE, b) for b in before[:-1]]
    old += [version_path(root, v) for v in versions(spark, root) if v <= before[-1]]
    for path in old:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(path), True)

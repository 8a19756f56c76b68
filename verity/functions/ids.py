"""Message ids and creation times as column expressions.

A new message gets a random 32-hex-digit id (the hex form of a version-4
UUID) and the current UTC time in ISO-8601 with a ``Z``.  Jobs that must give
the same ids when replayed derive them from source keys instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from verity.sources.schemas import ISO_FORMAT


def new_id() -> Column:
    """Random id: a version-4 UUID without dashes (not replay-safe)."""
    return F.regexp_replace(F.expr("uuid()"), "-", "")


def derived_id(*cols: Column | str, namespace: str = "") -> Column:
    """Deterministic 32-hex-digit id from source keys: the same input row gets
    the same id on every run and after a replayed micro-batch."""
    parts = [F.lit(namespace)] + [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"),
                                             F.lit("\u0000")) for c in cols]
    return F.substring(F.sha2(F.concat_ws("\u001f", *parts), 256), 1, 32)


def iso_utc(ts: Column | str) -> Column:
    """Timestamp -> ISO-8601 UTC string with microseconds and ``Z`` (session time zone UTC)."""
    return F.date_format(F.col(ts) if isinstance(ts, str) else ts, ISO_FORMAT)


def now_iso() -> Column:
    return iso_utc(F.current_timestamp())

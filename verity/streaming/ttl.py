"""Reuse with a time to live as keyed state (``transformWithState`` on RocksDB).

A key's state is one value, the time its entry was filled.  Two clocks:

* ``event``: the times of the requests, as in the batch operator ``reuse.ttl_hits``.  An event-time
  timer removes an entry once the watermark has passed its end.  Every row that can still come is then
  later than that and would fill the entry anew, so dropping it changes no result, however fast or slow
  the stream runs.
* ``processing``: the clock on the wall, by the state store's own time to live.  An entry that exists
  answers; an expired one is gone, and the next request fills it.  Such a query always asks for another batch, so
  a run until the input's end (``availableNow``) needs ``spark.sql.streaming.noDataMicroBatches.enabled`` off.

State holds the keys with a live entry only.  Only the key, order and id columns enter it; the rows of a
key in one micro-batch are put in order in its task, so ``max_per_trigger`` of the source bounds what a hot
key brings there.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from verity.operators.reuse import CACHE_TTL_SECONDS
from verity.streaming.analytics import WATERMARK_DELAY

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def entry_step(stored: int | None, times: list[int | None], ttl_us: int) -> tuple[int | None, list[bool]]:
    """(time of the entry after, hit per row) for the ordered request times of one key.

    A request without a time leaves a filled entry as it is and fills none that lasts; ``ttl_us <= 0``: entries
    never expire."""
    hits = []
    for at in times:
        hit = at is not None and stored is not None and (ttl_us <= 0 or at - stored <= ttl_us)
        if not hit and at is not None:
            stored = at
        hits.append(hit)
    return stored, hits


class _EventClock(StatefulProcessor):
    def __init__(self, ttl_us: int):
        self.ttl_us = ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.entry = handle.getValueState("entry", "stored_us bigint")

    def _end_ms(self, stored: int) -> int:
        return -(-(stored + self.ttl_us) // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        asked = sorted(rows, key=lambda r: (r.us is not None, r.us or 0, r.tie is not None, r.tie or ""))
        before = self.entry.get()[0] if self.entry.exists() else None
        after, hits = entry_step(before, [r.us for r in asked], self.ttl_us)
        if after != before:
            self.entry.update((after,))
            if self.ttl_us > 0:
                if before is not None:
                    self.handle.deleteTimer(self._end_ms(before))
                self.handle.registerTimer(self._end_ms(after))
        for row, hit in zip(asked, hits, strict=True):
            yield Row(id=row.id, hit=hit)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.entry.clear()
        return iter(())


class _WallClock(StatefulProcessor):
    def __init__(self, ttl_us: int):
        self.ttl_ms = -(-ttl_us // 1000) if ttl_us > 0 else None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.entry = handle.getValueState("entry", "filled boolean", self.ttl_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        filled = self.entry.exists()
        if not filled:
            self.entry.update((True,))
        for row in sorted(rows, key=lambda r: (r.us is not None, r.us or 0, r.tie is not None, r.tie or "")):
            yield Row(id=row.id, hit=filled)
            filled = True


def stream_ttl_hits(requests: DataFrame, ttl_seconds: float = CACHE_TTL_SECONDS, key: str = "question_id",
                    ts: str = "ts", tiebreak: str = "event_id", id_col: str = "message_id", clock: str = "event",
                    delay: str = WATERMARK_DELAY) -> DataFrame:
    """Stream of (``id_col``, hit): whether the entry stored by an earlier request of the key answers.

    Rows of a key are taken micro-batch by micro-batch, inside one by (``ts``, ``tiebreak`` as text).  A NULL key is a key.
    With the ``event`` clock rows later than ``delay`` behind the newest are dropped, as by any watermark, and a request
    without a time is no hit.  The session's state store must be RocksDB (``rocksdb_state``)."""
    if clock not in ("event", "processing"):
        raise ValueError(f"clock is 'event' or 'processing', not {clock!r}")
    name = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("n"))
    at = F.col(ts).cast("timestamp")
    rows = requests.select(name.alias("k"), at.alias("at"), F.unix_micros(at).alias("us"),
                           F.col(tiebreak).cast("string").alias("tie"), F.col(id_col).alias("id"))
    out = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("hit", T.BooleanType())])
    ttl_us = int(round(ttl_seconds * 1_000_000))
    if clock == "event":
        hits = rows.withWatermark("at", delay).groupBy("k").transformWithState(_EventClock(ttl_us), out, "Append", "EventTime")
    else:
        hits = rows.groupBy("k").transformWithState(_WallClock(ttl_us), out, "Append", "ProcessingTime")
    return hits.withColumnRenamed("id", id_col)


class rocksdb_state:
    """Queries started inside keep their state in RocksDB; the session's setting comes back afterwards."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self) -> None:
        self.before = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *exc) -> None:
        if self.before is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.before)

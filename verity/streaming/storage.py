"""Streaming storage: validated responses -> results upsert + global metrics.

Each micro-batch ``n`` is reduced to one mergeable row per question
(``results_state``) and written as delta ``n``: work and bytes per trigger follow the batch,
not the table.  Every ``compact_every`` batches the deltas are folded into a
base version; the table is the newest base and the deltas after it, combined
by one aggregation (``current_results``).  A replayed micro-batch rewrites the
same delta from the same rows, so counters are not applied twice.

Messages that do not decode, or lack a required field, go to the quarantine.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from verity.functions.json import decode, split_valid
from verity.operators.store import (METRIC_COLUMNS, RESULT_COLUMNS, combine_metrics, combine_states,
                                    metrics_partial, results_state)
from verity.sources import snapshots as snap
from verity.sources.streams import delivered_once, read_topic
from verity.streaming.sinks import QUARANTINE, BatchSinks, start

COMPACT_EVERY = 64


#: The column that the stored results are bucketed by.
RESULT_KEY = "id_pregunta"


def current_results(spark: SparkSession, root: str, state: bool = False, ids: DataFrame | None = None) -> DataFrame | None:
    """The stored results (with the order key if ``state``); None before the first batch.

    With ``ids`` (column ``id_pregunta``), those of these questions: only the files of their buckets
    are read, and other questions' rows are dropped before any is combined."""
    buckets = None if ids is None else snap.buckets_of(ids, RESULT_KEY)
    parts = snap.current_parts(spark, root, buckets=buckets)
    if parts is None:
        return None
    if ids is not None:
        parts = parts.join(ids.select(RESULT_KEY).distinct(), RESULT_KEY, "left_semi")
    combined = combine_states(parts)
    return combined if state else combined.select(*RESULT_COLUMNS)


def current_metrics(spark: SparkSession, root: str) -> DataFrame | None:
    parts = snap.current_parts(spark, root)
    return None if parts is None else combine_metrics(parts).select(*METRIC_COLUMNS)


def apply_batch(batch: DataFrame, batch_id: int, results_root: str, metrics_root: str,
                compact_every: int = COMPACT_EVERY) -> None:
    """Add one batch of validated records to the stored results and metrics."""
    snap.write_delta(results_state(batch), results_root, batch_id, RESULT_KEY)
    snap.write_delta(metrics_partial(batch).coalesce(1), metrics_root, batch_id)
    if compact_every and (batch_id + 1) % compact_every == 0:
        snap.compact(batch.sparkSession, results_root, batch_id, combine_states, RESULT_KEY)
        snap.compact(batch.sparkSession, metrics_root, batch_id, lambda rows: combine_metrics(rows).coalesce(1))


def start_storage(spark: SparkSession, validated: str, results_root: str, metrics_root: str, checkpoint: str,
                  quarantine: str | None = None, max_per_trigger: int | None = None, fmt: str = "files",
                  available_now: bool = True, compact_every: int = COMPACT_EVERY, kafka_servers: str | None = None,
                  kafka_options: Mapping[str, str] | None = None, once_within: str | None = None):
    """Start the storage query over a validated topic (a folder, or a Kafka topic).

    Without ``quarantine``, undecodable messages go to ``<results_root>_quarantine``.  ``once_within``: records that the
    producer's replay delivers again in that time are counted once (``sources.streams.delivered_once``)."""
    sinks = BatchSinks({QUARANTINE: quarantine or f"{results_root.rstrip('/')}_quarantine"}, checkpoint, fmt,
                       kafka_servers, kafka_options)
    raw = read_topic(spark, validated, fmt, validated, max_per_trigger, kafka_servers, kafka_options)
    decoded = decode(delivered_once(raw, once_within), "validated", keep=("key", "value"), stamp=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            good, bad = split_valid(batch)
            apply_batch(good.drop("key"), batch_id, results_root, metrics_root, compact_every)
            sinks.write(batch_id, {QUARANTINE: (None, bad)})
        finally:
            batch.unpersist()

    return start(decoded, sink, checkpoint, available_now)

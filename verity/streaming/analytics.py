"""Streaming forms of the log analytics: windowed throughput, message latency and its quantiles.

All bound their state with event-time watermarks: a throughput window is
emitted once the watermark passes its end and its state is dropped; the
latency join keeps each side only as long as the other side can still match
(``decided`` within ``max_delay`` after ``created``); a window of the quantiles
holds one sketch of bounded size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.operators.analytics import SKETCH_K, THROUGHPUT_WINDOW, sketch_quantiles, sketch_windows

# Our choice of lateness bound (the reference assigns watermarks but never uses them).
WATERMARK_DELAY = "10 minutes"


def stream_throughput(log: DataFrame, ts: str = "timestamp", size: str = THROUGHPUT_WINDOW,
                      delay: str = WATERMARK_DELAY) -> DataFrame:
    """Messages per tumbling window of a log stream (append mode: final counts only)."""
    t = F.col(ts).cast("timestamp")
    w = log.withColumn("_t", t).withWatermark("_t", delay) \
        .groupBy(F.window("_t", size).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n")


def _correlated(created: DataFrame, decided: DataFrame, key: str, created_ts: str, decided_ts: str, delay: str,
                max_delay: str) -> DataFrame:
    """(_ck, _c, _d): the times of both stages of a message, joined within ``max_delay``."""
    c = created.select(F.col(key).alias("_ck"), F.col(created_ts).cast("timestamp").alias("_c")) \
        .withWatermark("_c", delay)
    d = decided.select(F.col(key).alias("_dk"), F.col(decided_ts).cast("timestamp").alias("_d")) \
        .withWatermark("_d", delay)
    cond = (F.col("_ck") == F.col("_dk")) & (F.col("_d") >= F.col("_c")) \
        & (F.col("_d") <= F.col("_c") + F.expr(f"INTERVAL {max_delay}"))
    return c.join(d, cond, "inner")


def _latency_ms() -> Column:
    return ((F.unix_micros("_d") - F.unix_micros("_c")) / 1000).cast("long")


def stream_message_latency(created: DataFrame, decided: DataFrame, key: str = "message_id",
                           created_ts: str = "created_ts", decided_ts: str = "decided_ts",
                           delay: str = WATERMARK_DELAY, *, max_delay: str) -> DataFrame:
    """Stream-stream inner join of two pipeline stages on the message key, with
    watermarks on both sides and a time bound so join state is purged."""
    j = _correlated(created, decided, key, created_ts, decided_ts, delay, max_delay)
    return j.select(F.col("_ck").alias(key), _latency_ms().alias("latency_ms"))


def stream_latency_quantiles(created: DataFrame, decided: DataFrame, probs: Sequence[float] = (0.5, 0.95),
                             key: str = "message_id", created_ts: str = "created_ts", decided_ts: str = "decided_ts",
                             size: str = THROUGHPUT_WINDOW, delay: str = WATERMARK_DELAY, k: int = SKETCH_K,
                             *, max_delay: str) -> DataFrame:
    """Latency per window of the decision time: count, least, largest and quantiles of a KLL sketch.

    Append mode: a window comes out once, when the watermark has passed its end and what the join may still add."""
    j = _correlated(created, decided, key, created_ts, decided_ts, delay, max_delay)
    return sketch_quantiles(sketch_windows(j.withColumn("latency_ms", _latency_ms()), "latency_ms", "_d", size, k), probs)

"""Analytics over logs, decisions and correlated stages.

All of it is aggregation with map-side partial aggregation (counts, sums,
min/max), so hot keys or hot windows never put their rows in one task.  Exact
percentiles place counted values by a range-partitioned running sum.  Results
are not rounded here; the registered queries round what they compare.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.functions.text import sanitize_fragment
from verity.operators.sequence import keyed_scan
from verity.session import checkpoint

# Thresholds of the sweep (the three defaults of the reference
# and a grid around them), retry backoff defaults, window size.
SWEEP_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.65, 0.7, 0.8, 0.9)
BACKOFF_BASE_SECONDS = 1.0
BACKOFF_JITTER_SECONDS = 0.5
THROUGHPUT_WINDOW = "1 hour"
#: Size of a quantile sketch: the rank of a quantile it gives is off by less than SKETCH_ERROR of the rows (a normalised
#: rank error of 2.3 / k^0.97 = 0.27 % holds for 99 %; SKETCH_ERROR allows for three times that).
SKETCH_K = 1024
SKETCH_ERROR = 0.01
#: About 3,000 years; times end with the year 9999.
LONGEST_DELAY_SECONDS = 1e11


def status_counts(log: DataFrame, status: str = "status") -> DataFrame:
    """Messages per status, sorted by status."""
    return log.groupBy(status).agg(F.count(F.lit(1)).alias("n")).orderBy(status)


def threshold_sweep(scored: DataFrame, score: str = "score",
                    thresholds: Sequence[float] = SWEEP_THRESHOLDS) -> DataFrame:
    """Acceptance and regeneration per candidate threshold.

    One pass: a single global aggregate with one conditional count/sum per
    threshold (partial aggregation per task), unpivoted to one row per
    threshold.  No join and no duplication of the scored rows.
    """
    s = F.col(score)
    aggs = []
    for i, t in enumerate(thresholds):
        acc = F.coalesce(s >= F.lit(t), F.lit(False))
        aggs += [F.count_if(acc).alias(f"a{i}"), F.count_if(~acc).alias(f"r{i}"),
                 F.sum(F.when(acc, s)).alias(f"s{i}")]
    row = scored.agg(F.count(F.lit(1)).alias("n"), *aggs)
    structs = [F.struct(F.lit(float(t)).alias("threshold"), F.col(f"a{i}").alias("accepted"),
                        F.col(f"r{i}").alias("regenerated"), F.col(f"s{i}").alias("_s"))
               for i, t in enumerate(thresholds)]
    out = row.select("n", F.inline(F.array(*structs)))
    return out.select(
        "threshold", "accepted", "regenerated",
        (F.col("regenerated") / F.col("n")).alias("regeneration_rate"),
        F.when(F.col("accepted") > 0, F.col("_s") / F.col("accepted")).alias("accepted_mean_score"))


def message_latency(created: DataFrame, decided: DataFrame, key: str = "message_id",
                    created_ts: str = "created_ts", decided_ts: str = "decided_ts",
                    keep: Sequence[str] = ()) -> DataFrame:
    """Correlate two pipeline stages on the message key: latency in ms
    (a stream-stream join with watermarks on both sides when streaming)."""
    j = created.select(key, created_ts).join(decided.select(key, decided_ts, *keep), key)
    ms = (F.unix_micros(F.col(decided_ts).cast("timestamp"))
          - F.unix_micros(F.col(created_ts).cast("timestamp"))) / 1000
    return j.select(key, *keep, ms.cast("long").alias("latency_ms"))


def exact_quantiles(df: DataFrame, col: str, probs: Sequence[float]) -> DataFrame:
    """One row of exact linear-interpolation quantiles (as ``percentile`` / ``quantile_cont``), columns q0, q1, ...

    Rows are counted per distinct value (map-side partials), and a running sum
    of the counts over sampled value ranges places every value's ranks; the
    values that hold a wanted rank are picked by a conditional maximum.  No
    value reaches the driver (the row count does), and no task holds the
    column.  NULLs are ignored; NaN is the largest value.  Without rows all
    quantiles are NULL.
    """
    counts = checkpoint(df.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
                        .groupBy("x").agg(F.count(F.lit(1)).alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    placed = keyed_scan(counts, [], ["x"], cumsum="n").withColumn("_to", F.col("_csum") + F.col("n"))
    picks, out = [], []
    for i, p in enumerate(probs):
        h = max(total - 1, 0) * p
        lo, hi = math.floor(h), math.ceil(h)
        for name, rank in ((f"lo{i}", lo), (f"hi{i}", hi)):
            inside = (F.col("_csum") <= F.lit(rank)) & (F.lit(rank) < F.col("_to"))
            picks.append(F.max(F.when(inside, F.col("x"))).alias(name))
        gap = F.lit(h - lo) * (F.col(f"hi{i}") - F.col(f"lo{i}"))
        out.append(F.when(F.col(f"lo{i}") == F.col(f"hi{i}"), F.col(f"lo{i}")).otherwise(F.col(f"lo{i}") + gap).alias(f"q{i}"))
    return placed.agg(*picks).select(*out)


def latency_summary(latency: DataFrame, col: str = "latency_ms") -> DataFrame:
    """Count, mean, max and exact p50 / p95 of message latency (unrounded)."""
    values = checkpoint(latency.select(F.col(col).cast("double").alias("x")))
    stats = values.agg(F.count("x").alias("n"), F.avg("x").alias("mean_ms"), F.max("x").alias("max_ms"))
    ranks = exact_quantiles(values, "x", (0.5, 0.95))
    # Two one-row frames, joined on a constant.
    return stats.withColumn("_k", F.lit(1)).join(ranks.withColumn("_k", F.lit(1)), "_k") \
        .select("n", "mean_ms", "max_ms", F.col("q0").alias("p50_ms"), F.col("q1").alias("p95_ms"))


def sketch_windows(rows: DataFrame, value: str, ts: str, size: str = THROUGHPUT_WINDOW, k: int = SKETCH_K) -> DataFrame:
    """(w, n, lo, hi, sketch) per tumbling window of ``ts``: a mergeable KLL sketch of the values.

    Sketches are built map-side and merge in the shuffle, so a window costs one of a few kB per task; their size does not
    depend on its rows.  NULL and NaN values, and rows without a time, take no part.  Add ``withWatermark`` upstream when
    streaming: a window's state is then its sketch."""
    x = F.col(value).cast("double")
    used = rows.select(F.col(ts).alias("_t"), x.alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x") & F.col("_t").isNotNull())
    return used.groupBy(F.window("_t", size).alias("w")).agg(
        F.count("_x").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.kll_sketch_agg_double("_x", F.lit(k)).alias("sketch"))


def merge_sketches(windows: DataFrame, size: str, k: int = SKETCH_K) -> DataFrame:
    """The same for longer windows, out of ``sketch_windows`` rows alone (``size`` a multiple of theirs)."""
    return windows.groupBy(F.window(F.col("w.start"), size).alias("w")).agg(
        F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))


def sketch_quantiles(windows: DataFrame, probs: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """window_start, n, lo, hi and q0, q1, ...: values whose rank is within ``SKETCH_ERROR`` of the wanted one."""
    return windows.select(F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "n", "lo", "hi",
                          *[F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias(f"q{i}") for i, p in enumerate(probs)])


def throughput_windows(log: DataFrame, ts: str = "timestamp", size: str = THROUGHPUT_WINDOW) -> DataFrame:
    """Messages per tumbling window (add ``withWatermark`` upstream when streaming)."""
    w = F.window(F.col(ts).cast("timestamp"), size)
    return log.groupBy(w.alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        F.date_format("w.start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        F.date_format("w.end", "yyyy-MM-dd HH:mm:ss").alias("window_end"), "n")


def interarrival_stats(log: DataFrame, key: str = "question_id", ts: str = "timestamp") -> DataFrame:
    """Per key: requests, mean gap between consecutive requests and the fitted
    Poisson rate 1 / mean gap.  The sum of consecutive gaps telescopes to
    (last - first), so no ordered window is needed: count/min/max aggregate
    map-side, whatever the key skew."""
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    g = log.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(us).alias("_f"), F.max(us).alias("_l"))
    mean = F.when(F.col("n") > 1, (F.col("_l") - F.col("_f")) / 1e6 / (F.col("n") - 1))
    return g.select(key, "n", mean.alias("mean_gap_s"), F.when(mean > 0, 1 / mean).alias("rate_per_s"))


def interarrival_gaps(log: DataFrame, key: str = "question_id", ts: str = "timestamp",
                      tiebreak: str = "message_id") -> DataFrame:
    """Per request: seconds since the previous request of the same key (NULL for the first
    and where either time is NULL).  The previous row comes from a range-partitioned scan,
    so a hot key spans many tasks."""
    d = log.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
    s = keyed_scan(d, [key], [ts, tiebreak], lag_cols=["_us"])
    gap = (F.col("_us") - F.col("_prev__us")) / 1e6
    return s.withColumn("gap_s", gap).drop("_us", "_prev__us", "_pos")


def error_backoff(errors: DataFrame, ts: str = "ts", attempts: str = "attempts",
                  base: float = BACKOFF_BASE_SECONDS, jitter: float = BACKOFF_JITTER_SECONDS,
                  seed: int = 7) -> DataFrame:
    """Error records with exponential backoff: delay = base * 2^(attempts-1) + U(0, jitter);
    ``retry_at`` is cut to whole seconds (UTC, ISO with Z).

    There is no cap on the attempts.  A delay of ``LONGEST_DELAY_SECONDS`` or more
    leads beyond the years a time can have: its ``retry_at`` is NULL (never)."""
    delay = F.lit(base) * F.pow(F.lit(2.0), F.col(attempts) - 1)
    if jitter > 0:
        delay = delay + F.rand(seed) * F.lit(jitter)
    ours = F.when(F.col("delay_s") < LONGEST_DELAY_SECONDS, F.col("delay_s"))
    retry_us = F.unix_micros(F.col(ts).cast("timestamp")) + (ours * 1_000_000).cast("long")
    return errors.withColumn("delay_s", delay).withColumn(
        "retry_at", F.date_format(F.timestamp_seconds(F.floor(retry_us / 1_000_000)), "yyyy-MM-dd'T'HH:mm:ss'Z'"))


def sample_questions(questions: DataFrame, n: int, seed: int = 42, order: str = "question_id") -> DataFrame:
    """``n`` draws with replacement: ``draw`` (0 to n - 1) and the question it picked.

    Draw i picks the row at position md5(seed, i) mod N in ``order``, so the
    same seed gives the same draws on any engine.  Without questions there are none.
    """
    placed = checkpoint(keyed_scan(questions, [], [order]))
    total = placed.count()
    if not total:
        return placed.select(F.lit(0).cast("long").alias("draw"), *questions.columns)
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col("draw").cast("string"))), 1, 15)
    draws = questions.sparkSession.range(n).select(F.col("id").alias("draw")).select(
        "draw", (F.conv(digits, 16, 10).cast("long") % F.lit(total) + 1).alias("_pos"))
    return draws.join(placed, "_pos").select("draw", *questions.columns)


def run_label(dist: Column, total: Column, params: Sequence[tuple[str, Column]]) -> Column:
    """``traffic_{dist}_n{total}_{name}{value}...`` with file-safe fragments."""
    parts = [F.lit("traffic"), dist, F.concat(F.lit("n"), total.cast("string"))]
    parts += [F.concat(F.lit(name), sanitize_fragment(v)) for name, v in params]
    return F.concat_ws("_", *parts)

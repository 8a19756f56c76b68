"""Watermarked streaming throughput and stream-stream latency join vs the batch operators."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from conftest import as_rows
from verity.operators.analytics import (SKETCH_ERROR, merge_sketches, message_latency, sketch_quantiles, sketch_windows,
                                        throughput_windows)
from verity.streaming.analytics import stream_latency_quantiles, stream_message_latency, stream_throughput

T0 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
ISO = "%Y-%m-%dT%H:%M:%S.%fZ"


def _write_json_files(folder, chunks, base=1_700_000_000):
    os.makedirs(folder, exist_ok=True)
    for i, chunk in enumerate(chunks):
        p = os.path.join(folder, f"part-{i:05d}.json")
        with open(p, "w") as h:
            for r in chunk:
                h.write(json.dumps(r) + "\n")
        os.utime(p, (base + 10 * i, base + 10 * i))


def _run(df, path, ck, mode="append"):
    q = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", ck) \
        .outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_throughput_matches_batch_for_closed_windows(spark, tmp_path):
    rnd = random.Random(1)
    rows = sorted(T0 + dt.timedelta(seconds=rnd.randint(0, 6 * 3600)) for _ in range(500))
    recs = [{"timestamp": t.strftime(ISO), "message_id": f"m{i}"} for i, t in enumerate(rows)]
    src = str(tmp_path / "log")
    _write_json_files(src, [recs[i:i + 100] for i in range(0, len(recs), 100)])
    schema = "timestamp string, message_id string"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    out = str(tmp_path / "out")
    _run(stream_throughput(stream), out, str(tmp_path / "ck"))
    got = spark.read.parquet(out)
    batch = throughput_windows(spark.read.schema(schema).json(src)).select("window_start", "n")
    closed_before = (rows[-1] - dt.timedelta(minutes=10)).replace(tzinfo=None)
    want = batch.filter(F.to_timestamp("window_start") + F.expr("INTERVAL 1 HOUR")
                        <= F.lit(closed_before))
    assert got.count() > 0
    assert as_rows(got.toPandas()) == as_rows(want.toPandas())


def test_stream_latency_join_matches_batch(spark, tmp_path):
    rnd = random.Random(2)
    created, decided = [], []
    for i in range(300):
        c = T0 + dt.timedelta(seconds=20 * i)
        created.append({"message_id": f"m{i}", "created_ts": c.strftime(ISO)})
        if i % 17 == 0:
            continue                                        # never decided
        delay = rnd.randint(0, 3000) if i % 23 else 2 * 86400   # a few beyond the time bound
        decided.append({"message_id": f"m{i}", "decided_ts": (c + dt.timedelta(seconds=delay)).strftime(ISO)})
    ci, di = str(tmp_path / "created"), str(tmp_path / "decided")
    _write_json_files(ci, [created[i:i + 60] for i in range(0, 300, 60)])
    by_msg = {r["message_id"]: r for r in decided}
    _write_json_files(di, [[by_msg[c["message_id"]] for c in created[i:i + 60] if c["message_id"] in by_msg]
                           for i in range(0, 300, 60)])
    cs = spark.readStream.schema("message_id string, created_ts timestamp").option("maxFilesPerTrigger", 1).json(ci)
    ds = spark.readStream.schema("message_id string, decided_ts timestamp").option("maxFilesPerTrigger", 1).json(di)
    out = str(tmp_path / "lat")
    _run(stream_message_latency(cs, ds, max_delay="1 day"), out, str(tmp_path / "ck"))
    got = spark.read.parquet(out)
    cb = spark.read.schema("message_id string, created_ts timestamp").json(ci)
    db = spark.read.schema("message_id string, decided_ts timestamp").json(di)
    want = message_latency(cb, db).filter(F.col("latency_ms") <= 86400 * 1000)
    assert got.count() == want.count() == 269      # 18 never decided, 14 beyond the bound, 1 both
    assert as_rows(got.toPandas()) == as_rows(want.toPandas())


def _rank_error(values, q, p):
    """Distance of ``p`` from the ranks that ``q`` has among ``values``, as a share of them."""
    below, upto = sum(v < q for v in values) / len(values), sum(v <= q for v in values) / len(values)
    return max(below - p, p - upto, 0)


def test_sketches_keep_the_stated_rank_error_and_merge(spark):
    n = 200_000
    rows = spark.range(n).select(
        (F.lit(T0) + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 86400)")).alias("ts"),
        F.when(F.col("id") % 997 == 0, F.lit(None)).when(F.col("id") % 998 == 0, F.lit(float("nan")))
        .otherwise(F.pow(F.lit(1.1), F.pmod(F.xxhash64("id"), F.lit(100)))).alias("x"))
    probs = (0.0, 0.01, 0.5, 0.95, 1.0)
    hours = sketch_windows(rows, "x", "ts", "1 hour")
    day = sketch_quantiles(merge_sketches(hours, "1 day"), probs).collect()
    assert len(day) == 1 and hours.count() == 24
    values = [r.x for r in rows.filter("x IS NOT NULL AND NOT isnan(x)").select("x").collect()]
    assert day[0].n == len(values) and (day[0].lo, day[0].hi) == (min(values), max(values))
    assert all(_rank_error(values, day[0][f"q{i}"], p) < SKETCH_ERROR for i, p in enumerate(probs))
    # The state of a window: bounded, whatever its rows.
    assert hours.agg(F.max(F.length("sketch"))).first()[0] < 40_000
    assert sketch_quantiles(sketch_windows(rows.limit(0), "x", "ts")).count() == 0


def test_stream_latency_quantiles(spark, tmp_path):
    rnd = random.Random(5)
    created, decided = [], []
    for i in range(600):
        c = T0 + dt.timedelta(seconds=30 * i)
        created.append({"message_id": f"m{i}", "created_ts": c.strftime(ISO)})
        decided.append({"message_id": f"m{i}", "decided_ts": (c + dt.timedelta(seconds=rnd.randint(0, 900))).strftime(ISO)})
    ci, di = str(tmp_path / "created"), str(tmp_path / "decided")
    _write_json_files(ci, [created[:300], created[300:]])
    _write_json_files(di, [decided[:300], decided[300:]])
    cs = spark.readStream.schema("message_id string, created_ts timestamp").option("maxFilesPerTrigger", 1).json(ci)
    ds = spark.readStream.schema("message_id string, decided_ts timestamp").option("maxFilesPerTrigger", 1).json(di)
    out = str(tmp_path / "q")
    _run(stream_latency_quantiles(cs, ds, max_delay="20 minutes"), out, str(tmp_path / "ck"))
    got = spark.read.parquet(out).collect()
    wanted = {}
    for c, d in zip(created, decided):
        at = dt.datetime.strptime(d["decided_ts"], ISO)
        ms = round((at - dt.datetime.strptime(c["created_ts"], ISO)).total_seconds() * 1000)
        wanted.setdefault(at.strftime("%Y-%m-%d %H:00:00"), []).append(ms)
    assert len(got) >= 3 and len(got) == len({r.window_start for r in got})
    for r in got:
        values = wanted[r.window_start]
        assert (r.n, r.lo, r.hi) == (len(values), min(values), max(values))
        assert all(_rank_error(values, q, p) < SKETCH_ERROR + 1 / len(values) for q, p in ((r.q0, 0.5), (r.q1, 0.95)))

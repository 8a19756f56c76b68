"""TTL reuse as keyed state: equal to the batch operator over restarts, and by the store's own time to live."""

from __future__ import annotations

import datetime as dt
import json
import os
import random
import time

import pytest

from verity.operators.reuse import ttl_hits
from verity.streaming.ttl import entry_step, rocksdb_state, stream_ttl_hits

T0 = dt.datetime(2024, 5, 1, tzinfo=dt.timezone.utc)
SCHEMA = "question_id string, ts timestamp, event_id long, message_id string"


def _rows(n, keys, seconds, seed):
    rnd = random.Random(seed)
    times = sorted(rnd.randint(0, seconds) for _ in range(n))
    return [{"question_id": None if rnd.random() < 0.05 else f"q{min(rnd.randrange(keys), rnd.randrange(keys))}", "event_id": i,
             "ts": (T0 + dt.timedelta(seconds=t)).strftime("%Y-%m-%dT%H:%M:%SZ"), "message_id": f"m{i}"} for i, t in enumerate(times)]


def _write(folder, rows, at):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, f"part-{at:05d}.json")
    with open(path, "w") as f:
        f.write("".join(json.dumps(r) + "\n" for r in rows))
    os.utime(path, (1_700_000_000 + 10 * at,) * 2)


def _run(spark, src, out, ck, **kw):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(src)
    settings = {"spark.sql.shuffle.partitions": "2", "spark.sql.streaming.noDataMicroBatches.enabled": str(kw.get("clock") != "processing").lower()}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    with rocksdb_state(spark):
        q = stream_ttl_hits(stream, **kw).writeStream.format("parquet").option("path", out) \
            .option("checkpointLocation", ck).outputMode("append").trigger(availableNow=True).start()
    for k, v in before.items():
        spark.conf.set(k, v)
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_entry_step():
    assert entry_step(None, [0, 10, 11, 21, 22], 10) == (22, [False, True, False, True, False])
    assert entry_step(5, [None, 3, 9], 10) == (5, [False, True, True])
    assert entry_step(None, [1, 10**12], 0) == (1, [False, True])
    assert entry_step(None, [], 10) == (None, [])


def test_event_clock_equals_the_batch_over_a_restart(spark, tmp_path):
    rows = _rows(400, 25, 6 * 3600, seed=4)
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    for i in range(2):
        _write(src, rows[i * 150:(i + 1) * 150], i)
    _run(spark, src, out, ck, ttl_seconds=900)
    _write(src, rows[300:], 3)
    q = _run(spark, src, out, ck, ttl_seconds=900)
    got = {r.message_id: r.hit for r in spark.read.parquet(out).collect()}
    want = {r.message_id: r.hit for r in ttl_hits(spark.read.schema(SCHEMA).json(src), 900).collect()}
    assert got == want and len(got) == 400 and 0 < sum(got.values()) < 400
    # Timers removed the entries that the watermark, ten minutes behind the newest request, has passed.
    with rocksdb_state(spark):
        entries = spark.read.format("statestore").option("stateVarName", "entry").load(ck).select("key.k", "value.stored_us").collect()
    newest = max(dt.datetime.fromisoformat(r["ts"]) for r in rows)
    oldest_end = (newest - dt.timedelta(minutes=10)).timestamp()
    assert 0 < len(entries) < len({r["question_id"] for r in rows})
    assert all(e.stored_us / 1e6 + 900 >= oldest_end for e in entries)


def test_processing_clock_uses_the_stores_ttl(spark, tmp_path):
    at = "2024-05-01T00:00:00Z"
    row = lambda i, k: {"question_id": k, "ts": at, "event_id": i, "message_id": f"m{i}"}
    src, out, ck = (str(tmp_path / x) for x in ("src", "out", "ck"))
    _write(src, [row(0, "a"), row(1, "a"), row(2, "b")], 0)
    _run(spark, src, out, ck, ttl_seconds=3, clock="processing")
    time.sleep(4)
    _write(src, [row(3, "a"), row(4, "a"), row(5, "c")], 1)
    _run(spark, src, out, ck, ttl_seconds=3, clock="processing")
    got = {r.message_id: r.hit for r in spark.read.parquet(out).collect()}
    assert got == {"m0": False, "m1": True, "m2": False, "m3": False, "m4": True, "m5": False}


def test_other_clocks_are_refused(spark):
    with pytest.raises(ValueError):
        stream_ttl_hits(spark.createDataFrame([], SCHEMA), clock="moon")

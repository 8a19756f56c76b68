"""Streaming scorer and storage: parity with the batch operators, restart, replay."""

from __future__ import annotations

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import as_rows
from verity.functions.json import decode
from verity.operators.decide import attempt_decisions, regeneration_loop, split_decisions
from verity.operators.score import score_pairs
from verity.operators.store import METRIC_COLUMNS, combine_states, metrics_partial, results_upsert
from verity.session import ensure_checkpoint_dir
from verity.sources import snapshots as snap
from verity.sources.streams import kafka_sink_options, kafka_source_options, read_topic_batch
from verity.streaming.router import start_router, start_worker
from verity.streaming.scorer import start_scorer
from verity.streaming.storage import RESULT_KEY, apply_batch, current_metrics, current_results, start_storage

WORDS = "alpha beta gamma delta epsilon zeta eta theta".split()
T0 = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)


def _responses(n_keys=25, seed=3):
    rnd = random.Random(seed)
    out = []
    for k in range(n_keys):
        for i in range(rnd.randint(1, 9)):
            ts = T0 + dt.timedelta(seconds=len(out) * 7 + rnd.random())
            out.append({
                "message_id": f"m{k}", "trace_id": f"t{k}", "question_id": f"q{k % 7}",
                "title": f"title {k}", "content": f"content {k}", "prompt": f"title {k}\n\ncontent {k}",
                "llm_answer": " ".join(rnd.sample(WORDS, rnd.randint(1, 6))),
                "best_answer": "alpha beta gamma delta", "latency_ms": 1.5, "attempts": 1,
                "produced_at": ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ"),
            })
    out.sort(key=lambda r: r["produced_at"])
    return out


def _write_files(folder, records, n_files, start_index=0):
    os.makedirs(folder, exist_ok=True)
    size = -(-len(records) // n_files)
    base = 1_700_000_000
    for f in range(n_files):
        chunk = records[f * size:(f + 1) * size]
        if not chunk:
            continue
        idx = start_index + f
        p = os.path.join(folder, f"part-{idx:05d}.json")
        with open(p, "w", encoding="utf-8") as h:
            for r in chunk:
                h.write(json.dumps(r, ensure_ascii=False) + "\n")
        os.utime(p, (base + idx * 10, base + idx * 10))   # pick-up order = time order


def _batch_expected(spark, records):
    df = spark.createDataFrame([json.dumps(r) for r in records], "string").toDF("value")
    resp = decode(df.withColumn("key", F.lit(None).cast("string")), "llm_response").drop("valid", "reason", "key")
    scored = score_pairs(resp, digits=None) \
        .withColumn("ts", F.to_timestamp("produced_at")).withColumn("event_id", F.lit(0))
    decided = attempt_decisions(scored, order=("ts", "event_id"), threshold=0.65, max_attempts=3) \
        .drop("ts", "event_id")
    return split_decisions(decided)


def _read_kind(spark, root, kind):
    return decode(read_topic_batch(spark, kind, f"{root}/*"), kind).drop("valid", "reason", "key")


def _same(a, b, cols):
    ca, ra = as_rows(a.select(*cols).toPandas())
    cb, rb = as_rows(b.select(*cols).toPandas())
    assert ca == cb
    assert ra == rb


VCOLS = ["message_id", "question_id", "llm_answer", "score", "accepted", "attempts", "decided_at", "content"]
RCOLS = ["message_id", "question_id", "prompt", "attempts"]


def test_scorer_stream_matches_batch_with_restart(spark, tmp_path):
    records = _responses()
    half = len(records) // 2
    src, ck = str(tmp_path / "responses"), str(tmp_path / "ck")
    vroot, rroot = str(tmp_path / "validated"), str(tmp_path / "regen")
    _write_files(src, records[:half], 3)
    q = start_scorer(spark, src, vroot, rroot, ck, max_per_trigger=1, decided_at=F.col("produced_at"))
    q.awaitTermination(300)
    assert q.exception() is None
    _write_files(src, records[half:], 3, start_index=3)           # new files after the restart
    q = start_scorer(spark, src, vroot, rroot, ck, max_per_trigger=1, decided_at=F.col("produced_at"))
    q.awaitTermination(300)
    assert q.exception() is None

    want_v, want_r = _batch_expected(spark, records)
    got_v, got_r = _read_kind(spark, vroot, "validated"), _read_kind(spark, rroot, "regeneration")
    _same(got_v, want_v, VCOLS)
    _same(got_r, want_r, RCOLS)
    assert got_v.filter("attempts > 3").count() == 0


def test_storage_stream_matches_batch_upsert_and_replay_is_idempotent(spark, tmp_path):
    records = _responses(seed=11)
    src, ck = str(tmp_path / "responses"), str(tmp_path / "ck")
    vroot, rroot = str(tmp_path / "validated"), str(tmp_path / "regen")
    _write_files(src, records, 4)
    q = start_scorer(spark, src, vroot, rroot, ck, max_per_trigger=1)
    q.awaitTermination(300)

    results, metrics = str(tmp_path / "results"), str(tmp_path / "metrics")
    q2 = start_storage(spark, vroot, results, metrics, str(tmp_path / "ck2"), max_per_trigger=1, compact_every=2)
    q2.awaitTermination(300)
    assert q2.exception() is None

    validated = _read_kind(spark, vroot, "validated")
    want = results_upsert(validated)
    _same(current_results(spark, results), want, want.columns)
    wm = metrics_partial(validated).select(*METRIC_COLUMNS)
    _same(current_metrics(spark, metrics), wm, wm.columns)
    assert len(os.listdir(results)) <= 5                          # compacted, old deltas dropped

    # Replaying a micro-batch rewrites the same delta, before and after compaction.
    parts = validated.randomSplit([0.5, 0.5], seed=7)
    parts = [p.persist() for p in parts]
    r2, m2 = str(tmp_path / "results2"), str(tmp_path / "metrics2")
    apply_batch(parts[0], 0, r2, m2)
    apply_batch(parts[1], 1, r2, m2)
    apply_batch(parts[1], 1, r2, m2)
    _same(current_results(spark, r2), want, want.columns)
    snap.compact(spark, r2, 1, combine_states, RESULT_KEY)
    apply_batch(parts[1], 1, r2, m2)
    _same(current_results(spark, r2), want, want.columns)
    _same(current_metrics(spark, m2), wm, wm.columns)


def _lines(folder):
    """All messages below a folder of JSON-lines files."""
    out = []
    for root, _, names in os.walk(folder):
        for n in names:
            if n.startswith("part-"):
                with open(os.path.join(root, n), encoding="utf-8") as f:
                    out += [json.loads(x) for x in f if x.strip()]
    return out


def _run(q):
    q.awaitTermination(300)
    assert q.exception() is None
    return q


def test_nothing_is_lost_in_the_scorer_and_storage(spark, tmp_path):
    """Malformed, loosely typed, id-less, time-less and empty input: each message is in one output."""
    src = tmp_path / "responses"
    src.mkdir()
    good = _responses(3, seed=5)[:2]
    good[0]["llm_answer"] = good[0]["best_answer"]
    good[1].update(message_id="rejected", llm_answer="zeta")
    loose = dict(good[0], message_id="loose", attempts="1")
    timeless = {k: v for k, v in dict(good[0], message_id="timeless").items() if k != "produced_at"}
    empty_time = dict(good[0], message_id="emptytime", produced_at="")
    idless = [{k: v for k, v in dict(good[0], title=str(i)).items() if k != "message_id"} for i in range(2)]
    wrong = dict(good[0], message_id="wrong", attempts="many")
    lines = [json.dumps(x) for x in [*good, loose, timeless, empty_time, *idless, wrong]] + ["{bad", "[1]", "7"]
    (src / "a.json").write_text("\n".join(lines) + "\n")
    v, r, ck = (str(tmp_path / x) for x in ("validated", "regen", "ck"))
    q = _run(start_scorer(spark, str(src), v, r, ck))
    accepted, again, refused = _lines(v), _lines(r), _lines(f"{r}_quarantine")
    assert accepted and [x["message_id"] for x in again] == ["rejected"]
    assert len(accepted) + len(again) + len(refused) == len(lines)
    assert sorted(x["reason"] for x in refused) == ["bad attempts"] + ["missing message_id"] * 2 + ["not a JSON object"] * 3
    assert {x["value"] for x in refused} >= {"{bad", "[1]", "7"}
    assert all(x["decided_at"].endswith("Z") for x in accepted)
    seen = q.lastProgress.observedMetrics["decisions"]
    assert seen.accepted + seen.forced == len(accepted) and (seen.regenerated, seen.quarantined) == (len(again), 6)

    (tmp_path / "validated" / "bad.json").write_text('{"message_id": "x"}\n')
    _run(start_storage(spark, v, str(tmp_path / "results"), str(tmp_path / "metrics"), str(tmp_path / "ck2")))
    stored = current_results(spark, str(tmp_path / "results"))
    assert stored.agg(F.sum("contador_consultas")).first()[0] == len(accepted)
    assert [x["reason"] for x in _lines(str(tmp_path / "results_quarantine"))] == ["missing trace_id"]


def test_replayed_batch_is_consumed_and_not_emitted_twice(spark, tmp_path):
    records = _responses(8, seed=2)
    src, v, r, ck = (str(tmp_path / x) for x in ("responses", "validated", "regen", "ck"))
    _write_files(src, records[:20], 2)
    _run(start_scorer(spark, src, v, r, ck, max_per_trigger=1))
    before = sorted(map(json.dumps, _lines(v) + _lines(r)))
    commits = sorted((n for n in os.listdir(f"{ck}/commits") if n.isdigit()), key=int)
    os.remove(f"{ck}/commits/{commits[-1]}")
    if os.path.exists(f"{ck}/commits/.{commits[-1]}.crc"):
        os.remove(f"{ck}/commits/.{commits[-1]}.crc")
    _run(start_scorer(spark, src, v, r, ck, max_per_trigger=1))
    assert sorted(map(json.dumps, _lines(v) + _lines(r))) == before
    _write_files(src, records[20:], 1, start_index=5)
    _run(start_scorer(spark, src, v, r, ck, max_per_trigger=1))
    assert len(_lines(v) + _lines(r)) == len(records)
    # Another query over the same outputs has folders of its own.
    _run(start_scorer(spark, src, v, r, str(tmp_path / "other")))
    assert len(_lines(v) + _lines(r)) == 2 * len(records)


def test_records_delivered_again_count_once(spark, tmp_path):
    """A producer's replay emits the records of a batch again, with other times and in another order."""
    def record(i, attempts, at):
        return {"message_id": f"m{i}", "trace_id": f"t{i}", "question_id": f"q{i % 3}", "title": "t", "content": "c", "llm_answer": "a",
                "best_answer": "b", "score": 0.5, "accepted": True, "source": "llm", "attempts": attempts,
                "decided_at": (T0 + dt.timedelta(seconds=at)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")}

    first = [record(i, 1, i) for i in range(9)]
    again = [record(i, 1, 100 + i) for i in reversed(range(4, 9))] + [record(2, 2, 120)]
    src, root, ck = str(tmp_path / "validated"), str(tmp_path / "results"), str(tmp_path / "ck")
    broken = [{"message_id": "m90"}, {"trace_id": "lost"}]
    _write_files(src, first + broken, 1)
    _run(start_storage(spark, src, root, str(tmp_path / "m"), ck, once_within="1 hour"))
    _write_files(src, again + broken, 1, start_index=1)
    _run(start_storage(spark, src, root, str(tmp_path / "m"), ck, once_within="1 hour"))  # state outlives the restart
    assert current_metrics(spark, str(tmp_path / "m")).first()["procesadas"] == 10       # the second attempt is a record of its own
    assert current_results(spark, root).agg(F.sum("contador_consultas")).first()[0] == 10
    assert len(_lines(f"{root}_quarantine")) == 2
    # Without it all that is delivered counts.
    _run(start_storage(spark, src, str(tmp_path / "r2"), str(tmp_path / "m2"), str(tmp_path / "ck2")))
    assert current_metrics(spark, str(tmp_path / "m2")).first()["procesadas"] == 15


def test_scorer_scores_a_response_delivered_again_once(spark, tmp_path):
    at = lambda i: (T0 + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    response = lambda k, n, sec: {"message_id": f"m{k}", "trace_id": "t", "question_id": "q", "llm_answer": "nothing alike",
                                  "best_answer": "alpha beta", "attempts": n, "produced_at": at(sec)}
    src, v, r, ck = (str(tmp_path / x) for x in ("responses", "validated", "regen", "ck"))
    _write_files(src, [response(k, 0, k) for k in range(4)], 1)
    _run(start_scorer(spark, src, v, r, ck, once_within="1 hour"))
    _write_files(src, [response(k, 0, 50 + k) for k in range(4)] + [response(0, 1, 60)], 1, start_index=1)
    _run(start_scorer(spark, src, v, r, ck, once_within="1 hour"))
    # Four first attempts and one second: no replay has used up an attempt.
    assert sorted((x["message_id"], x["attempts"]) for x in _lines(r)) == [("m0", 1), ("m0", 2), ("m1", 1), ("m2", 1), ("m3", 1)]
    assert _lines(v) == []


def test_the_whole_cycle_equals_the_batch(spark, tmp_path):
    """questions -> route -> answer -> score -> regenerate -> ... -> results, all as streams."""
    at = lambda i: (T0 + dt.timedelta(seconds=i)).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    asked = [{"message_id": f"m{i}", "trace_id": f"t{i}", "question_id": f"q{i}", "title": f"title {i}",
              "content": "alpha beta gamma " + WORDS[i % 8], "created_at": at(i),
              "best_answer": "title alpha beta gamma" if i % 2 else "entirely other words"} for i in range(12)]
    p = {x: str(tmp_path / x) for x in ("questions", "regen", "validated", "requests", "responses", "errors", "results", "metrics", "cache")}
    ck = lambda x: str(tmp_path / f"ck_{x}")
    _write_files(p["questions"], asked, 2)

    def turn():
        _run(start_router(spark, p["questions"], p["regen"], p["validated"], p["requests"], p["results"], p["cache"], ck("router")))
        _run(start_worker(spark, p["requests"], p["responses"], p["errors"], ck("worker")))
        _run(start_scorer(spark, p["responses"], p["validated"], p["regen"], ck("scorer"), threshold=0.3))

    for _ in range(3):
        turn()
    _run(start_storage(spark, p["validated"], p["results"], p["metrics"], ck("storage")))
    schema = "message_id string, trace_id string, question_id string, title string, content string, best_answer string, created_at string"
    questions = spark.createDataFrame([{k: a[k] for k in a} for a in asked], schema).withColumn("attempts", F.lit(0))
    batch = regeneration_loop(questions, threshold=0.3)
    cols = ["id_pregunta", "pregunta", "contenido", "respuesta_dataset", "respuesta_llm", "score", "aceptado", "contador_consultas"]
    _same(current_results(spark, p["results"]), results_upsert(batch), cols)
    tries = {x["message_id"]: x["attempts"] for x in _lines(p["validated"])}
    assert {r.message_id: r.attempts for r in batch.collect()} == tries and set(tries.values()) == {1, 3}

    # Asked again: served from the stored results, within the ttl from the cache, also across micro-batches.
    again = [dict(a, message_id=f"again{i}{j}", created_at=at(100 + j)) for i, a in enumerate(asked[:4]) for j in range(2)]
    again += [dict(again[0]), dict(again[0])]                     # the very same message, three times in all
    _write_files(p["questions"], again, 1, start_index=7)
    spark.catalog.clearCache()
    folders = len(os.listdir(checkpoint_folder(spark)))
    _run(start_router(spark, p["questions"], p["regen"], p["validated"], p["requests"], p["results"], p["cache"], ck("router")))
    _write_files(p["questions"], [dict(a, message_id=f"late{i}", created_at=at(150 if i else 9000)) for i, a in enumerate(asked[:2])], 1, start_index=9)
    _run(start_router(spark, p["questions"], p["regen"], p["validated"], p["requests"], p["results"], p["cache"], ck("router")))
    # Micro-batches leave neither checkpoints nor cached blocks behind.
    assert len(os.listdir(checkpoint_folder(spark))) == folders
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().isEmpty()
    source = {x["message_id"]: x["source"] for x in _lines(p["validated"])}
    assert sorted(x["source"] for x in _lines(p["validated"]) if x["message_id"] == "again00") == ["cache", "cache", "storage"]
    assert all(source[f"again{i}0"] == "storage" for i in range(1, 4)) and all(source[f"again{i}1"] == "cache" for i in range(4))
    assert (source["late0"], source["late1"]) == ("storage", "cache")


def checkpoint_folder(spark):
    return ensure_checkpoint_dir(spark).removeprefix("file:")


def test_a_batch_reads_the_buckets_of_its_questions(spark, tmp_path):
    """Of a stored table with deltas and a base, only the bucket folders of the ids asked for are scanned."""
    root, metrics = str(tmp_path / "results"), str(tmp_path / "metrics")
    rows = lambda lo, hi: spark.createDataFrame([(f"m{i}", "t", f"q{i}" if i else None, "T", "C", "A", "B", 0.5, True, "scorer", 1,
                                                  f"2024-01-01T00:00:{i % 60:02d}Z") for i in range(lo, hi)],
                                                "message_id string, trace_id string, question_id string, title string, content string, llm_answer string, "
                                                "best_answer string, score double, accepted boolean, source string, attempts int, decided_at string")
    for n in range(4):
        apply_batch(rows(n * 40, n * 40 + 60), n, root, metrics, compact_every=3)
    ids = spark.createDataFrame([("q45",), ("q150",), ("nobody",), (None,)], f"{RESULT_KEY} string")
    got = current_results(spark, root, ids=ids)
    _same(got, current_results(spark, root).filter("id_pregunta IN ('q45', 'q150')"), got.columns)
    buckets = snap.buckets_of(ids, RESULT_KEY)
    parts = snap.current_parts(spark, root, buckets=buckets)
    read = parts.inputFiles()
    assert read and {f.split("/")[-2] for f in read} <= {f"{snap.BUCKET}={b}" for b in buckets}
    every = [f for *_, files in os.walk(root) for f in files if f.endswith(".parquet")]
    assert len(read) < len(every) / 4
    assert set(got.inputFiles()) >= set(read) and not set(got.inputFiles()) & (set(snap.current_parts(spark, root).inputFiles()) - set(read))


def test_worker_reports_failures_and_retries(spark, tmp_path):
    requests = [{"message_id": f"m{i}", "trace_id": "t", "question_id": "q", "title": "T", "content": "C", "prompt": p,
                 "best_answer": "b", "attempts": 3} for i, p in enumerate(["good", "boom"])] + [{"message_id": "m2"}]
    src, out, err = (str(tmp_path / x) for x in ("requests", "responses", "errors"))
    _write_files(src, requests, 1)
    failing = F.when(F.col("prompt") == "boom", F.lit("timeout"))
    _run(start_worker(spark, src, out, err, str(tmp_path / "ck"), error=failing))
    answers = {x["message_id"]: x for x in _lines(out)}
    assert set(answers) == {"m0", "m1"} and "timeout" in answers["m1"]["llm_answer"]
    (e,) = _lines(err)
    late = dt.datetime.fromisoformat(e["retry_at"]) - dt.datetime.fromisoformat(e["produced_at"])
    assert (e["error_type"], e["error_detail"], e["attempts"]) == ("GenerationError", "timeout", 3) and 2.9 < late.total_seconds() < 4.6
    assert [x["reason"] for x in _lines(f"{out}_quarantine")] == ["missing trace_id"]


def test_kafka_options():
    read = kafka_source_options("t", "h:1", 500, {"kafka.security.protocol": "SSL"})
    assert read == {"kafka.bootstrap.servers": "h:1", "subscribe": "t", "startingOffsets": "earliest",
                    "maxOffsetsPerTrigger": "500", "kafka.security.protocol": "SSL"}
    assert "maxOffsetsPerTrigger" not in kafka_source_options("t", "h:1")
    write = kafka_sink_options("t", "h:1", {"kafka.acks": "1"})
    assert write == {"kafka.bootstrap.servers": "h:1", "topic": "t", "kafka.acks": "1", "kafka.enable.idempotence": "true"}
    for make in (kafka_source_options, kafka_sink_options):
        with pytest.raises(ValueError):
            make("t", None)


def test_stream_counter_on_fixture_events_matches_batch(spark, tmp_path):
    """W1 over the driver's events (v_attempts at sf0.001), streamed in time order."""
    from conftest import SMOKE_DIR
    from verity.sources import fixtures as fx
    from verity.streaming.scorer import stream_attempt_decisions

    rows = fx.v_attempts(spark, SMOKE_DIR).select("message_id", "ts", "event_id", "score") \
        .orderBy("ts", "event_id").collect()
    recs = [{"message_id": r.message_id, "ts": r.ts.strftime("%Y-%m-%dT%H:%M:%S.%f"),
             "event_id": r.event_id, "score": r.score} for r in rows]
    src = str(tmp_path / "events")
    _write_files(src, recs, 4)
    schema = "message_id string, ts timestamp, event_id long, score double"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(src)
    decided = stream_attempt_decisions(stream, order=("ts", "event_id"), threshold=0.65, max_attempts=3)
    out = str(tmp_path / "decided")
    q = decided.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    got = spark.read.parquet(out).select("event_id", "attempts", "accepted", "forced")
    want = attempt_decisions(spark.read.schema(schema).json(src), order=("ts", "event_id"),
                             threshold=0.65, max_attempts=3).select("event_id", "attempts", "accepted", "forced")
    assert got.count() == len(recs)
    assert as_rows(got.toPandas()) == as_rows(want.toPandas())

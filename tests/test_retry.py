"""Error records: what is sent again and when, on tables and as a stream."""

from __future__ import annotations

import datetime as dt
import json
import os
import time

from pyspark.sql import functions as F

from verity.operators.retry import due_requests, retry_states
from verity.streaming.retries import AGAIN, retry_step, start_retries

AT = "2024-03-01T00:01:00Z"
IDS = {"trace_id": "t", "question_id": "q", "title": "T", "content": "C", "prompt": "P", "best_answer": "B"}


def _frames(spark):
    errors = [("due", 1, "2024-03-01T00:00:59Z"), ("due", 1, "2024-03-01T00:00:59Z"), ("late", 1, "2024-03-01T00:01:01Z"),
              ("newest", 1, "2024-03-01T00:00:01Z"), ("newest", 2, "2024-03-01T00:02:00Z"), ("used up", 3, "2024-03-01T00:00:01Z"),
              ("never", 1, None), ("garbled", 1, "soon"), ("unknown", 1, "2024-03-01T00:00:01Z"), ("sent", 1, "2024-03-01T00:00:01Z"),
              (None, 1, "2024-03-01T00:00:01Z"), ("uncounted", None, "2024-03-01T00:00:01Z")]
    requests = [(m, n, f"{m}{n}") for m, n in [("due", 1), ("late", 1), ("newest", 1), ("newest", 2), ("used up", 3), ("never", 1),
                                              ("garbled", 1), ("sent", 1), ("sent", 2), ("uncounted", None), ("fine", 1)]]
    return (spark.createDataFrame(errors, "message_id string, attempts int, retry_at string"),
            spark.createDataFrame(requests, "message_id string, attempts int, prompt string"))


def test_states_of_failed_messages(spark):
    errors, requests = _frames(spark)
    at = F.to_timestamp(F.lit(AT))
    got = {r.message_id: (r.state, r.attempts, r.prompt) for r in retry_states(errors, requests, at, 3).collect()}
    assert got == {"due": ("due", 2, "due1"), "late": ("waiting", 2, "late1"), "newest": ("waiting", 3, "newest2"),
                   "used up": ("exhausted", 4, "used up3"), "never": ("exhausted", 2, "never1"), "garbled": ("exhausted", 2, "garbled1"),
                   "unknown": ("no request", 2, None), "sent": ("retried", 2, "sent2"), "uncounted": ("due", 1, "uncountedNone")}
    again = due_requests(errors, requests, at, 3)
    assert again.columns == requests.columns
    assert sorted(map(tuple, again.collect())) == [("due", 2, "due1"), ("uncounted", 1, "uncountedNone")]
    assert retry_states(errors.limit(0), requests, at).count() == 0
    assert {r.state for r in retry_states(errors, requests.limit(0), at, 9).collect()} == {"no request", "exhausted"}


def test_steps_of_a_key_with_a_fixed_clock():
    def run(*steps, most=3):
        state, sent = (None, None, 0, 0, -1, 1000), []
        for now, requests, errors in steps:
            state, out = retry_step(state or (None, None, 0, 0, -1, now + 1000), requests, errors, now, 1000, most)
            sent.append(out)
        return state, sent

    # Released when due, not before; the same error again changes nothing.
    state, sent = run((0, [(1, "r1")], []), (10, [], [(1, 500, "e1")]), (499, [], []), (500, [], []), (501, [], [(1, 500, "e1")]))
    assert sent == [[], [], [], [("r1", AGAIN, 2)], []] and state is not None
    # The next failure waits for its own time; at the bound nothing more is sent.
    state, sent = run((0, [(1, "r1")], [(1, 5, "e1")]), (6, [], []), (7, [(2, "r2")], [(2, 50, "e2")]), (60, [], []), (70, [(3, "r3")], [(3, 99, "e3")]), (200, [], []))
    assert sent == [[], [("r1", AGAIN, 2)], [], [("r2", AGAIN, 3)], [("e3", "exhausted", 3)], []]
    # Both in one step; an error before its request; no request at all; no time.
    assert run((9, [(1, "r1")], [(1, 5, "e1")]))[1] == [[("r1", AGAIN, 2)]]
    assert run((0, [], [(1, 5, "e1")]), (1, [(1, "r1")], []), (5, [], []))[1][2] == [("r1", AGAIN, 2)]
    assert run((9, [], [(1, 5, "e1")]), (20, [(1, "r1")], []))[1] == [[], [("r1", AGAIN, 2)]]
    state, sent = run((9, [], [(1, 5, "e1")]), (1008, [], []), (1009, [], []))
    assert state is None and sent == [[], [], [("e1", "no request", 1)]]
    assert run((9, [(1, "r1")], [(1, None, "e1")]))[1] == [[("e1", "exhausted", 1)]]
    # Sent by someone else meanwhile; a request without an error is forgotten.
    assert run((0, [(1, "r1")], [(1, 50, "e1")]), (10, [(2, "r2")], []), (60, [], []))[1] == [[], [], []]
    assert run((0, [(1, "r1")], []), (1000, [], []))[0] is None


def _put(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding="utf-8") as h:
        h.writelines(json.dumps(r) + "\n" for r in records)


def _lines(folder):
    return [json.loads(x) for root, _, names in os.walk(folder) for n in names if n.startswith("part-")
            for x in open(os.path.join(root, n), encoding="utf-8") if x.strip()]


def test_stream_sends_again_when_due(spark, tmp_path):
    src, err, out, ck = (str(tmp_path / x) for x in ("requests", "errors", "again", "ck"))
    iso = lambda s: (dt.datetime.now(dt.timezone.utc) + dt.timedelta(seconds=s)).strftime("%Y-%m-%dT%H:%M:%SZ")
    request = lambda m, n=1: {"message_id": m, "attempts": n, **IDS}
    error = lambda m, n, at: {"message_id": m, "trace_id": "t", "question_id": "q", "error_type": "E", "error_detail": "d",
                              "attempts": n, "retry_at": at, "produced_at": iso(0)}
    _put(src, "a.json", [request("past"), request("soon"), request("spent", 2), request("fine")])
    soon = iso(15)
    _put(err, "a.json", [error("past", 1, iso(-5)), error("past", 1, iso(-5)), error("soon", 1, soon), error("spent", 2, iso(-5))])
    seen = {}

    def run(until, most):
        q = start_retries(spark, src, err, ck, again=out, hold_seconds=600, max_attempts=2)
        end = time.time() + most
        while time.time() < end and q.exception() is None and not until():
            time.sleep(0.5)
            for r in _lines(out):
                seen.setdefault(r["message_id"], time.time())
        q.stop()
        q.awaitTermination(60)
        assert q.exception() is None

    run(lambda: "past" in seen and len(_lines(f"{err}_quarantine")) == 1, 60)
    # After a restart the timer still stands; the error sent twice more is known.
    _put(err, "b.json", [error("past", 1, iso(-5)), {"message_id": "broken"}])
    run(lambda: "soon" in seen, 60)
    sent = {(r["message_id"], r["attempts"], r["prompt"]) for r in _lines(out)}
    assert sent == {("past", 2, "P"), ("soon", 2, "P")} and len(_lines(out)) == 2
    assert seen["soon"] >= dt.datetime.fromisoformat(soon).timestamp()
    assert sorted((json.loads(r["value"])["message_id"], r["reason"]) for r in _lines(f"{err}_quarantine")) == [("broken", "missing trace_id"), ("spent", "exhausted")]

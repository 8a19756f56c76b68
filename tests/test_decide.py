"""Attempt counter: batch closed form, streaming step and the reference loop agree."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from verity.operators.decide import attempt_decisions, decision_counts, generate_with_fallback, loop_quarantine, regeneration_loop
from verity.streaming.scorer import counter_step


def loop(scores, threshold, max_attempts):
    """Per key in arrival order: n += 1; accept on threshold or cap; accept clears n."""
    n, out = 0, []
    for s in scores:
        n += 1
        acc = s >= threshold or n >= max_attempts
        out.append((n, acc, acc and s < threshold))
        if acc:
            n = 0
    return out


@pytest.mark.parametrize("max_attempts", [-1, 0, 1, 2, 3, 5])
def test_batch_closed_form_matches_loop(spark, max_attempts):
    rnd = random.Random(max_attempts + 7)
    t0 = dt.datetime(2024, 1, 1)
    rows, expected = [], {}
    for key in range(6):
        scores = [round(rnd.random(), 3) for _ in range(rnd.randint(1, 25))]
        if key == 0:
            scores = [0.65, 0.1, 0.65, 0.6499]          # threshold hit exactly
        for i, s in enumerate(scores):
            # ts spread over several hours so chunks of the keyed scan are exercised
            rows.append((str(key), t0 + dt.timedelta(minutes=37 * i), i, s))
        for i, e in enumerate(loop(scores, 0.65, max_attempts)):
            expected[(str(key), i)] = e
    df = spark.createDataFrame(rows, "message_id string, ts timestamp, event_id long, score double")
    out = attempt_decisions(df, threshold=0.65, max_attempts=max_attempts).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.attempts, r.accepted, r.forced) == expected[(r.message_id, r.event_id)]
        assert r.attempts <= max(1, max_attempts)


@pytest.mark.parametrize("max_attempts", [0, 1, 3, 4])
def test_stream_step_matches_loop_across_batches(max_attempts):
    rnd = random.Random(max_attempts)
    scores = [rnd.random() for _ in range(200)]
    want = loop(scores, 0.65, max_attempts)
    got, pending, i = [], 0, 0
    while i < len(scores):
        k = rnd.randint(0, 7)                           # empty batches included
        a, acc, forced, pending = counter_step(np.array(scores[i:i + k]), pending, 0.65, max_attempts)
        got += list(zip(a.tolist(), acc.tolist(), forced.tolist()))
        i += k
    assert got == want


def test_null_scores_keys_and_times_are_decided(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [("a", t, 1, None), ("a", t, 2, 0.9), (None, t, 3, 0.1), (None, None, 4, 0.9), ("b", None, 5, None)]
    df = spark.createDataFrame(rows, "message_id string, ts timestamp, event_id long, score double")
    out = {r.event_id: (r.attempts, r.accepted, r.forced) for r in attempt_decisions(df, max_attempts=3).collect()}
    assert out == {1: (1, False, False), 2: (2, True, False), 3: (1, False, False), 4: (1, True, False), 5: (1, False, False)}
    both = attempt_decisions(df, max_attempts=3)
    assert both.filter("accepted").count() + both.filter("NOT accepted").count() == len(rows)


def test_generate_with_fallback(spark):
    req = spark.createDataFrame([(f"m{i}", "t", "q", "T", "C", p, "b", 1) for i, p in enumerate(["good", "boom", None])],
                                "message_id string, trace_id string, question_id string, title string, content string, "
                                "prompt string, best_answer string, attempts int")
    failing = F.when(F.col("prompt") == "boom", F.lit("timeout"))
    answers, errors = generate_with_fallback(req, lambda p: F.concat(F.lit("A "), p), failing)
    got = {r.message_id: r.llm_answer for r in answers.collect()}
    assert got["m0"] == "A good" and "timeout" in got["m1"] and "empty answer" in got["m2"]
    assert {r.message_id: r.error_detail for r in errors.collect()} == {"m1": "timeout", "m2": "empty answer"}
    answers, errors = generate_with_fallback(req, lambda p: F.concat(F.lit("A "), p), failing, fallback=False)
    assert (answers.count(), errors.count()) == (1, 2)


def test_regeneration_loop_rescores_a_changed_answer(spark):
    """A generator whose answer changes from round to round, and a question that brings attempts."""
    q = spark.createDataFrame(
        [("m1", "t1", "q1", "alpha", "beta", "alpha beta", "s", "2024-01-01T00:00:00Z", 2),
         ("m2", "t2", "q2", "alpha", "beta", "gamma delta", "s", "2024-01-01T00:00:00Z", 0)],
        "message_id string, trace_id string, question_id string, title string, content string, best_answer string, "
        "source string, created_at string, attempts int")
    calls = []

    def generator(prompt):
        calls.append(1)
        return F.lit(["nothing", "alpha beta", "x"][len(calls) - 1])

    out = {r.message_id: r for r in regeneration_loop(q, generator, 0.9, 3, decided_at=F.col("created_at")).collect()}
    assert (out["m1"].attempts, out["m1"].request_attempts, out["m1"].forced, out["m1"].llm_answer) == (2, 2, False, "alpha beta")
    assert (out["m2"].attempts, out["m2"].request_attempts, out["m2"].forced, out["m2"].llm_answer) == (3, 3, True, "x")
    calls.clear()
    once = {r.message_id: r for r in regeneration_loop(q, generator, 0.9, 1).collect()}
    assert once["m1"].request_attempts == 3 and once["m1"].content == "alpha\n\nbeta"


def test_decision_counts_labels(spark):
    df = spark.createDataFrame([(True, False), (True, True), (False, False), (False, False)],
                               "accepted boolean, forced boolean")
    got = {r.decision: r.n for r in decision_counts(df).collect()}
    assert got == {"accepted": 1, "forced": 1, "regenerated": 2}


def test_regeneration_loop_deterministic_generator(spark):
    q = spark.createDataFrame(
        [("m1", "t1", "q1", "same words here", "", "same words here", "traffic-generator", "", 0),
         ("m2", "t2", "q2", "title", "body text", "entirely different reference", "traffic-generator", "", 0)],
        "message_id string, trace_id string, question_id string, title string, content string, "
        "best_answer string, source string, created_at string, attempts int")
    out = {r.message_id: r for r in regeneration_loop(q, threshold=0.3, max_attempts=3).collect()}
    assert set(out) == {"m1", "m2"}
    assert out["m2"].attempts == 3 and out["m2"].forced is True and out["m2"].accepted is True
    one = {r.message_id: r for r in regeneration_loop(q, threshold=0.3, max_attempts=1).collect()}
    assert all(r.attempts == 1 and r.accepted for r in one.values())


def test_questions_without_message_id_reach_the_quarantine(spark):
    rows = [("m1", "t1", "q1", "a title", "", "a title", 0), (None, "t2", "q2", "b title", "", "b title", 0), (None, "t2", "q2", "b title", "", "b title", 0)]
    q = spark.createDataFrame(rows, "message_id string, trace_id string, question_id string, title string, content string, best_answer string, attempts int")
    assert [r.message_id for r in regeneration_loop(q, threshold=0.3).collect()] == ["m1"]
    left = loop_quarantine(q).collect()
    assert [tuple(r)[:-1] for r in left] == rows[1:] and {r.reason for r in left} == {"missing message_id"}

"""Exact quantiles and the threshold sweep against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from verity.operators.analytics import error_backoff, exact_quantiles, sample_questions, threshold_sweep
from verity.operators.sequence import keyed_scan


def test_exact_quantiles_match_numpy(spark):
    rnd = random.Random(3)
    vals = [rnd.choice([5.0, 5.0, 5.0, 7.5]) if rnd.random() < 0.3 else rnd.expovariate(0.01)
            for _ in range(3000)] + [None, None]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(4)
    probs = (0.0, 0.01, 0.5, 0.95, 0.999, 1.0)
    got = exact_quantiles(df, "x", probs).first()
    arr = np.array([v for v in vals if v is not None])
    for i, p in enumerate(probs):
        assert got[i] == pytest.approx(float(np.quantile(arr, p, method="linear")), rel=1e-12, abs=1e-12)


def test_exact_quantiles_of_odd_columns(spark):
    frame = lambda rows: spark.createDataFrame([(v,) for v in rows], "x double")
    assert exact_quantiles(frame([None]), "x", (0.5,)).first().q0 is None
    assert exact_quantiles(frame([2.0]), "x", (0.0, 0.5, 1.0)).first() == (2.0, 2.0, 2.0)
    nan, inf = float("nan"), float("inf")
    q = exact_quantiles(frame([1.0, nan, 3.0, inf, 2.0]), "x", (0.0, 0.5, 0.75, 1.0)).first()
    assert q[:3] == (1.0, 3.0, inf) and q[3] != q[3]


def test_keyed_scan_matches_loop_with_nulls_and_a_hot_key(spark):
    rnd = random.Random(6)
    rows = [("hot" if rnd.random() < 0.6 else rnd.choice(["a", "b", None]), rnd.choice([None, *range(50)]), i,
             rnd.choice([True, False, None])) for i in range(4000)]
    df = spark.createDataFrame(rows, "k string, t int, i int, f boolean").repartition(5)
    got = {r.i: r for r in keyed_scan(df, ["k"], ["t", "i"], lag_cols=["i"], lead_cols=["i"], flag=F.col("f"), cumsum="i").collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        last, total = None, 0
        for n, r in enumerate(own):
            g = got[r[2]]
            assert (g._pos, g._lastflag, g._csum) == (n + 1, last, total)
            assert g._prev_i == (own[n - 1][2] if n else None)
            assert g._next_i == (own[n + 1][2] if n + 1 < len(own) else None)
            last, total = n + 1 if r[3] else last, total + r[2]


@pytest.mark.parametrize("batch", [1, 7, 10000])
def test_keyed_scan_carries_over_batches_and_partitions(spark, batch):
    rnd = random.Random(batch)
    rows = [(rnd.choice(["hot", "hot", "b", None]), rnd.choice([float("nan"), 1.0, None]), rnd.choice([None, *range(400)]), i,
             rnd.getrandbits(63) - (1 << 62)) for i in range(900)]
    df = spark.createDataFrame(rows, "k string, d double, t bigint, i int, x bigint").repartition(3)
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        for keys in (["k", "d"], ["k"], []):
            got = {r.i: r for r in keyed_scan(df, keys, ["t", "i"], lag_cols=["t"], lead_cols=["i"], cumxor=["x"], gap=("t", 2)).collect()}
            own = lambda r: tuple("nan" if v != v else v for v in r[:len(keys)])  # noqa: E731, B023
            assert len(got) == len(rows)
            for key in {own(r) for r in rows}:
                group = sorted((r for r in rows if own(r) == key), key=lambda r: (r[2] is not None, r[2] or 0, r[3]))
                xor, seg, before = 0, None, None
                for n, r in enumerate(group):
                    leads = n == 0 or r[2] is None or before is None or r[2] - before > 2
                    seg = n + 1 if leads else seg
                    g = got[r[3]]
                    assert (g._pos, g._prev_t, g._cxor_x, g._leads, g._seg) == (n + 1, before, xor, leads, seg)
                    assert g._next_i == (group[n + 1][3] if n + 1 < len(group) else None)
                    xor, before = xor ^ r[4], r[2]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)


def test_keyed_scan_exchanges_the_rows_once(spark):
    """The scan's own plan: one range exchange, a sort, the scan; no hash exchange, no window."""
    from unittest import mock

    from verity.operators import sequence

    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    plans = []
    real = sequence.checkpoint
    with mock.patch.object(sequence, "checkpoint", lambda x: (plans.append(x._jdf.queryExecution().executedPlan().toString()), real(x))[1]):
        out = keyed_scan(df, ["k"], ["id"], flag=F.col("id") % 3 == 0, cumsum="id")
    assert len(plans) == 1 and plans[0].count("Exchange") == 1 and "rangepartitioning" in plans[0] and "Window" not in plans[0]
    final = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in final and "Window" not in final
    assert keyed_scan(df.limit(0), ["k"], ["id"], lead_cols=["id"]).count() == 0


def test_backoff_has_no_cap_and_does_not_overflow(spark):
    df = spark.range(1).select(F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("ts"), F.explode(F.array(
        *[F.lit(x) for x in (1, 12, 5000)])).alias("attempts"))
    got = {r.attempts: r for r in error_backoff(df, jitter=0.0).collect()}
    assert got[1].retry_at == "2024-01-01T00:00:01Z" and got[12].delay_s == 2048.0
    assert got[12].retry_at == "2024-01-01T00:34:08Z" and got[5000].retry_at is None


def test_threshold_sweep_brute_force(spark):
    rnd = random.Random(4)
    scores = [round(rnd.random(), 3) for _ in range(500)] + [0.65, 0.5]
    df = spark.createDataFrame([(s,) for s in scores], "score double")
    got = {r.threshold: r for r in threshold_sweep(df, thresholds=(0.5, 0.65)).collect()}
    for t in (0.5, 0.65):
        acc = [s for s in scores if s >= t]
        assert got[t].accepted == len(acc)
        assert got[t].regenerated == len(scores) - len(acc)
        assert got[t].regeneration_rate == pytest.approx((len(scores) - len(acc)) / len(scores))
        assert got[t].accepted_mean_score == pytest.approx(sum(acc) / len(acc))


def test_sample_with_replacement(spark):
    df = spark.range(50).select(F.col("id").alias("question_id"))
    a = [(r.draw, r.question_id) for r in sample_questions(df, 400, seed=7).collect()]
    assert sorted(a) == sorted((r.draw, r.question_id) for r in sample_questions(df, 400, seed=7).collect())
    assert sorted(d for d, _ in a) == list(range(400))      # exactly n draws
    assert {q for _, q in a} == set(range(50))
    assert sample_questions(df.limit(0), 10).count() == 0

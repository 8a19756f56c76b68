"""Reuse (lookup, TTL, LRU distance) against brute force; upsert merge law."""

from __future__ import annotations

import datetime as dt
import random
from collections import OrderedDict

import pandas as pd
import pytest

from conftest import as_rows
from verity.operators import reuse
from verity.operators.reuse import lru_hits, reuse_distance, reuse_lookup, reuse_misses, ttl_hits
from verity.operators.store import (RESULT_COLUMNS, merge_metrics, metrics_partial, results_merge, results_state,
                                    results_upsert)

T0 = dt.datetime(2024, 1, 1)


def _requests(spark, rows):
    return spark.createDataFrame(
        [(str(i), k, T0 + dt.timedelta(seconds=s), i) for i, (k, s) in enumerate(rows)],
        "message_id string, question_id string, ts timestamp, event_id long")


def ttl_loop(rows, ttl):
    stored, out = {}, []
    for k, s in rows:
        t0 = stored.get(k)
        hit = t0 is not None and (ttl <= 0 or s - t0 <= ttl)
        if not hit:
            stored[k] = s
        out.append(hit)
    return out


def test_ttl_boundaries(spark):
    rows = [("a", 0), ("a", 100), ("a", 100), ("a", 101), ("a", 150), ("a", 201), ("a", 202), ("b", 5)]
    got = {int(r.message_id): r.hit for r in ttl_hits(_requests(spark, rows), ttl_seconds=100).collect()}
    assert [got[i] for i in range(len(rows))] == [False, True, True, False, True, True, False, False]


@pytest.mark.parametrize("ttl", [-5, 0, 30, 3600, 20000])
def test_ttl_matches_loop(spark, ttl):
    rnd = random.Random(ttl + 100)
    rows, s = [], 0
    for _ in range(400):
        s += rnd.choice([0, 1, 7, 29, 30, 31, 400, 4000])
        rows.append((rnd.choice("abcdefg") if rnd.random() < 0.8 else "hot", s))
    got = {int(r.message_id): r.hit for r in ttl_hits(_requests(spark, rows), ttl_seconds=ttl).collect()}
    assert [got[i] for i in range(len(rows))] == ttl_loop(rows, ttl)


def lru_loop(keys, capacity):
    cache, out = OrderedDict(), []
    for k in keys:
        hit = k in cache
        if hit:
            cache.move_to_end(k)
        else:
            cache[k] = True
            if len(cache) > capacity:
                cache.popitem(last=False)
        out.append(hit)
    return out


def test_reuse_distance_matches_lru(spark):
    rnd = random.Random(5)
    keys = [f"k{int(rnd.paretovariate(1.2)) % 40}" for _ in range(600)]
    rows = [(k, i * 13) for i, k in enumerate(keys)]
    d = reuse_distance(_requests(spark, rows))
    for cap in (1, 3, 8, 20):
        got = {int(r.message_id): r.h for r in d.select("message_id", lru_hits(d, cap).alias("h")).collect()}
        assert [got[i] for i in range(len(rows))] == lru_loop(keys, cap), cap


@pytest.mark.parametrize(("bits", "most"), [(3, 10), (2, 5), (16, 10)])
def test_reuse_distance_over_blocks_of_positions(spark, monkeypatch, bits, most):
    """Requests of every spread of a and b over blocks; no scan of several rows a request (one a level)."""
    scan, sizes = reuse.keyed_scan, []
    monkeypatch.setattr(reuse, "keyed_scan", lambda df, *a, **b: sizes.append(df.count()) or scan(df, *a, **b))
    monkeypatch.setattr(reuse, "BLOCK_BITS", bits)
    monkeypatch.setattr(reuse, "MOST_BLOCKS_BITS", most)
    rnd = random.Random(bits)
    keys = [f"k{int(rnd.paretovariate(0.7)) % 60}" for _ in range(500)]
    d = reuse_distance(_requests(spark, [(k, i * 7) for i, k in enumerate(keys)]))
    got = {int(r.message_id): r.reuse_distance for r in d.collect()}
    want, last = {}, {}
    for i, k in enumerate(keys):
        want[i] = len(set(keys[last[k] + 1:i])) if k in last else -1
        last[k] = i
    assert got == want
    assert max(sizes) == len(keys)


def test_lookup_empty_vs_null_answer(spark):
    req = spark.createDataFrame(
        [("m1", "t1", "q1", "msg title", "msg content", "msg best", 2, "2024-01-01T00:00:00Z"),
         ("m2", "t2", "q2", "x", "y", "z", 0, "2024-01-01T00:00:01Z"),
         ("m3", "t3", "q3", "x", "y", "z", 0, "2024-01-01T00:00:02Z"),
         ("m4", "t4", "q4", "x", "y", "z", 0, "2024-01-01T00:00:03Z")],
        "message_id string, trace_id string, question_id string, title string, content string, "
        "best_answer string, attempts int, created_at string")
    store = spark.createDataFrame(
        [("q1", "", "", "stored best", "stored answer", None, None),
         ("q2", "p", "c", "b", "", 0.9, True),
         ("q3", "p", "c", "b", None, 0.9, True)],
        "id_pregunta string, pregunta string, contenido string, respuesta_dataset string, "
        "respuesta_llm string, score double, aceptado boolean")
    hits = reuse_lookup(req, store).collect()
    assert [h.message_id for h in hits] == ["m1"]
    h = hits[0]
    assert (h.title, h.content, h.best_answer, h.llm_answer) == ("", "", "stored best", "stored answer")
    assert h.score == 0.0 and h.accepted is False and h.attempts == 2
    assert sorted(r.message_id for r in reuse_misses(req, store).collect()) == ["m2", "m3", "m4"]


def test_lookup_takes_the_first_of_repeated_store_rows(spark):
    req = spark.createDataFrame([("m1", "t1", "q1", 0, "2024-01-01T00:00:00Z")],
                                "message_id string, trace_id string, question_id string, attempts int, created_at string")
    store = spark.createDataFrame(
        [("q1", "p", "c", "b", "older", 0.9, True, "2024-01-01T00:00:05.500000Z"),
         ("q1", "p", "c", "b", "newer", 0.9, True, "2024-01-01T00:00:06Z"),
         ("q1", "p", "c", "b", "", 0.9, True, "2024-01-01T00:00:07Z")],
        "id_pregunta string, pregunta string, contenido string, respuesta_dataset string, respuesta_llm string, "
        "score double, aceptado boolean, ultima_actualizacion string")
    assert [h.llm_answer for h in reuse_lookup(req, store).collect()] == ["newer"]


def test_ttl_dense_hot_key_and_odd_rows(spark):
    """One key asked every second for hours (a long chain inside one segment), NULL keys and times."""
    rows = [("hot", i) for i in range(3000)] + [("b", 5), ("b", 6)]
    df = _requests(spark, rows)
    got = {int(r.message_id): r.hit for r in ttl_hits(df, ttl_seconds=7).collect()}
    assert [got[i] for i in range(len(rows))] == ttl_loop(rows, 7)
    odd = spark.createDataFrame(
        [("0", None, T0, 0), ("1", None, T0 + dt.timedelta(seconds=1), 1), ("2", "a", None, 2), ("3", "a", T0, 3),
         ("4", "a", T0 + dt.timedelta(seconds=3), 4)], "message_id string, question_id string, ts timestamp, event_id long")
    assert {r.message_id: r.hit for r in ttl_hits(odd, ttl_seconds=7).collect()} == {
        "0": False, "1": True, "2": False, "3": False, "4": True}


def _validated(spark, n=300, seed=1):
    """Ties in time, both time forms, a time that does not parse, NULL question ids."""
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        ts = T0 + dt.timedelta(seconds=rnd.randint(0, 40) * 100, milliseconds=rnd.choice([0, 0, 500]))
        at = ts.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
        at = rnd.choice([at, at.replace(".000000Z", "Z"), at, "" if i % 29 == 3 else at])
        rows.append((f"m{i}", None if i % 23 == 7 else f"q{rnd.randint(0, 30)}", f"title{i}", f"c{i}", f"a{i}", f"b{i}",
                     round(rnd.random(), 4), rnd.random() < 0.6, at))
    return spark.createDataFrame(
        rows, "message_id string, question_id string, title string, content string, llm_answer string, "
        "best_answer string, score double, accepted boolean, decided_at string")


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merge_law(spark, seed):
    v = _validated(spark, seed=seed)
    x, y = v.randomSplit([0.4, 0.6], seed=3)
    want = as_rows(results_state(v).toPandas())
    assert as_rows(results_merge(results_state(x), y).toPandas()) == want
    assert as_rows(results_merge(results_state(y), x).toPandas()) == want       # the newer batch first
    assert as_rows(results_merge(results_state(x), y).select(*RESULT_COLUMNS).toPandas()) \
        == as_rows(results_upsert(v).toPandas())
    for a, b in ((x, y), (y, x)):
        m = merge_metrics(metrics_partial(a), metrics_partial(b))
        assert as_rows(m.toPandas()) == as_rows(metrics_partial(v).toPandas())
    empty = merge_metrics(metrics_partial(v), metrics_partial(v.limit(0)))
    assert as_rows(empty.toPandas()) == as_rows(metrics_partial(v).toPandas())


def test_merge_keeps_the_larger_message_of_a_tie(spark):
    row = lambda m, at: (m, "q", m, "", "", "", 0.5, True, at)
    kind = "message_id string, question_id string, title string, content string, llm_answer string, " \
           "best_answer string, score double, accepted boolean, decided_at string"
    old = spark.createDataFrame([row("m9", "2024-01-01T00:00:05.500000Z")], kind)
    new = spark.createDataFrame([row("m1", "2024-01-01T00:00:05.500000Z"), row("m0", "2024-01-01T00:00:05Z")], kind)
    r = results_merge(results_state(old), new).first()
    assert (r.pregunta, r.creado_en, r.contador_consultas) == ("m9", "2024-01-01T00:00:05Z", 3)


def test_upsert_counts_and_newest_wins(spark):
    v = _validated(spark, n=50, seed=9)
    res = {r.id_pregunta: r for r in results_upsert(v).collect()}
    pdf = v.toPandas()
    pdf["at"] = pd.to_datetime(pdf.decided_at.replace("", None), format="ISO8601")
    for q, g in pdf.groupby("question_id", dropna=False):
        r = res[None if pd.isna(q) else q]
        assert r.contador_consultas == len(g)
        newest = g.sort_values(["at", "message_id"], na_position="first").iloc[-1]
        earliest = g.sort_values(["at", "message_id"], na_position="last").iloc[0]
        assert r.respuesta_llm == newest.llm_answer and r.creado_en == earliest.decided_at

"""Pairwise TF-IDF cosine: edge cases and a property test against a brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from verity.operators.score import evaluate_pairs, pair_score, pair_tfidf, score_pairs, term_frequencies
from verity.plans.catalog import QUERIES

WORD = re.compile(r"(?u)\b\w\w+\b")


def brute(a: str | None, b: str | None) -> float:
    """Vectorizer fitted on the two texts only: idf = ln(3 / (1 + df)) + 1, L2 rows, cosine."""
    if not a or not b:
        return 0.0
    ta, tb = Counter(WORD.findall(a.lower())), Counter(WORD.findall(b.lower()))
    if not ta or not tb:
        return 0.0
    idf = {t: math.log(3 / (1 + (t in ta) + (t in tb))) + 1 for t in set(ta) | set(tb)}
    wa = {t: c * idf[t] for t, c in ta.items()}
    wb = {t: c * idf[t] for t, c in tb.items()}
    dot = sum(wa[t] * wb.get(t, 0.0) for t in wa)
    na = math.sqrt(sum(v * v for v in wa.values()))
    nb = math.sqrt(sum(v * v for v in wb.values()))
    return max(0.0, min(1.0, dot / (na * nb)))


EDGE = [
    ("identical", "the cat sat on the mat", "the cat sat on the mat"),
    ("disjoint", "alpha beta", "gamma delta"),
    ("empty_expected", "", "something here"),
    ("null_actual", "something here", None),
    ("both_null", None, None),
    ("one_char_words", "a b c d", "a b c d"),
    ("accents", "Canción número uno", "cancion NÚMERO uno"),
    ("case", "Hello World", "hello world"),
    ("repeats", "go go go stop", "go stop stop"),
    ("digits_underscore", "x_1 42 007", "42 x_1"),
    ("cyrillic", "Привет мир", "мир привет друг"),
]


def _frame(spark, rows):
    return spark.createDataFrame(rows, "message_id string, best_answer string, llm_answer string")


def test_edge_cases(spark):
    df = _frame(spark, EDGE)
    got = {r.message_id: r.score for r in score_pairs(df, digits=None).collect()}
    col = {r.message_id: r.s for r in df.select("message_id", pair_score("best_answer", "llm_answer")
                                                 .alias("s")).collect()}
    for key, a, b in EDGE:
        assert abs(got[key] - brute(a, b)) < 1e-12, key
        assert abs(col[key] - brute(a, b)) < 1e-12, key
    assert abs(got["identical"] - 1.0) < 1e-12
    assert got["disjoint"] == 0.0
    assert got["empty_expected"] == 0.0 and got["null_actual"] == 0.0 and got["one_char_words"] == 0.0


def test_threshold_on_unrounded_score(spark):
    df = _frame(spark, [("m1", "a1 b2 c3 d4", "a1 b2 c3 x9"), ("m2", "q1 q2", "q1 q2")])
    raw = {r.message_id: r.score for r in score_pairs(df, digits=None).collect()}
    t = raw["m1"]
    out = {r.message_id: r for r in evaluate_pairs(df, threshold=t).collect()}
    assert out["m1"].accepted is True
    assert out["m1"].score == round(t, 4)
    out2 = {r.message_id: r for r in evaluate_pairs(df, threshold=t + 1e-12).collect()}
    assert out2["m1"].accepted is False


def test_null_key_rows_are_kept(spark):
    df = _frame(spark, [(None, "x y", "x y"), ("k", "aa bb", "aa bb")])
    rows = score_pairs(df).collect()
    assert len(rows) == 2
    assert {r.message_id: r.score for r in rows} == {None: None, "k": 1.0}


def test_repeated_keys_are_pairs_of_their_own(spark):
    rows = [("m", "aa bb", "aa bb"), ("m", "aa bb", "cc dd"), ("m", "aa bb", "aa bb"), ("n", "aa", "aa")]
    got = sorted((r.llm_answer, r.score) for r in score_pairs(_frame(spark, rows)).collect())
    assert got == [("aa", 1.0), ("aa bb", 1.0), ("aa bb", 1.0), ("cc dd", 0.0)]
    two = score_pairs(_frame(spark, rows), key=["message_id", "best_answer"]).collect()
    assert sorted(r.score for r in two) == [0.0, 1.0, 1.0, 1.0]


VOCAB = ["aa", "bb", "cc", "dd", "ee", "ÉL", "x", "11", "a_b"]
text = st.lists(st.sampled_from(VOCAB), max_size=12).map(" ".join)


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(text, text), min_size=1, max_size=40))
def test_property_matches_brute_force_and_is_symmetric(spark, pairs):
    rows = [(str(i), a, b) for i, (a, b) in enumerate(pairs)]
    rows += [(f"r{i}", b, a) for i, (a, b) in enumerate(pairs)]
    got = {r.message_id: r.score for r in score_pairs(_frame(spark, rows), digits=None).collect()}
    for i, (a, b) in enumerate(pairs):
        s = got[str(i)]
        assert 0.0 <= s <= 1.0
        assert abs(s - brute(a, b)) < 1e-9
        assert abs(s - got[f"r{i}"]) < 1e-12


def test_counting_is_bounded_by_slices_not_by_tasks(spark):
    """No aggregate or exchange over token rows: a task's memory would grow with its share of the input."""
    rows = [(f"m{i}", f"alpha beta word{i}", "alpha") for i in range(50)]
    df = _frame(spark, rows)
    for out in (score_pairs(df), evaluate_pairs(df), term_frequencies(df), pair_tfidf(term_frequencies(df))):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" not in plan and "Generate" not in plan, plan
    assert "Exchange" not in score_pairs(df)._jdf.queryExecution().executedPlan().toString()


def test_term_frequencies_of_repeated_and_null_keys_over_many_slices(spark):
    rnd = random.Random(3)
    words = ["uno", "dos", "tres", "Cuatro", "ñandú", "x"]
    rows = [(rnd.choice(["a", "b", "c", None, f"k{i}"]),
             rnd.choice([None, "", " ".join(rnd.choices(words, k=rnd.randrange(9)))]),
             rnd.choice([None, " ".join(rnd.choices(words, k=rnd.randrange(9)))])) for i in range(4000)]
    want = Counter()
    for k, a, b in rows:
        for side, text in enumerate((a, b)):
            for t in WORD.findall(text.lower()) if None not in (a, b) else ():
                want[k, t, side] += 1
    df = _frame(spark, rows).repartition(3)
    got = {(r.message_id, r.term): (r.tf_expected, r.tf_actual) for r in term_frequencies(df).collect()}
    assert len(got) == term_frequencies(df).count()
    assert got == {(k, t): (want[k, t, 0], want[k, t, 1]) for k, t, _ in want}


@pytest.mark.parametrize("query", ["score_pairs", "evaluate_pairs"])
def test_registered_queries_score_row_by_row(spark, tmp_path, query):
    """From scan to result no operator gathers rows or tokens of a task: what a task holds does not grow with the table."""
    spark.createDataFrame([(i, f"uno dos palabra{i}", "es", "web") for i in range(9)], "doc_id bigint, text string, lang string, source string") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    out = QUERIES[query](spark, str(tmp_path))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(node in plan for node in ("Aggregate", "Generate", "Exchange", "Sort", "Window")), plan
    assert out.count() == 9

"""Text column functions against the Python string semantics they mirror."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from verity.functions import text as tx

# Whitespace of every kind Python's str.split() knows, mixed with words.
WS = ["\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", " ", "\x85", "\xa0", " ", " ",
      " ", " ", " ", " ", " ", "　"]
NOT_WS = ["​", "﻿", "x", "é", "ß", "中", "-", "."]
piece = st.one_of(st.sampled_from(WS), st.sampled_from(NOT_WS), st.text(alphabet="abcXYZ019_", min_size=1,
                                                                        max_size=4))
texts = st.lists(piece, max_size=90).map("".join)


def _eval(spark, values, fn):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.o for r in df.select("i", fn(F.col("s")).alias("o")).orderBy("i").collect()]


@settings(max_examples=3, deadline=None)
@given(st.lists(texts, min_size=1, max_size=60))
def test_strip_split_and_first_tokens(spark, values):
    assert _eval(spark, values, tx.strip_ws) == [v.strip() for v in values]
    assert _eval(spark, values, lambda c: tx.first_tokens(c, 5)) == [" ".join(v.split()[:5]) for v in values]
    assert _eval(spark, values, tx.offline_answer) == [
        tx.OFFLINE_PREFIX + " ".join(v.split()[:60]) + tx.OFFLINE_SUFFIX for v in values]


def test_first_tokens_long_text(spark):
    long = " \n ".join(f"w{i}" for i in range(20000))
    assert _eval(spark, [long], tx.first_tokens) == [" ".join(long.split()[:60])]


def test_prompt_joins_non_empty_parts(spark):
    df = spark.createDataFrame([("T", "C"), ("", "C"), ("T", ""), ("", ""), (None, "C"), (" ", "C")],
                               "t string, c string")
    got = [r.p for r in df.select(tx.build_prompt("t", "c").alias("p")).collect()]
    assert got == ["T\n\nC", "C", "T", "", "C", " \n\nC"]


def test_instruction_and_fallback_placeholders(spark):
    df = spark.createDataFrame([("  Title ", "　body\n"), ("", None), (" \t", "x")],
                               "t string, c string")
    ins = [r.p for r in df.select(tx.instruction_prompt("t", "c").alias("p")).collect()]
    assert ins[0] == tx.INSTRUCTION_INTRO + "Title" + tx.INSTRUCTION_DETAILS + "body" + tx.INSTRUCTION_TAIL
    assert ins[1] == (tx.INSTRUCTION_INTRO + tx.INSTRUCTION_EMPTY_TITLE + tx.INSTRUCTION_DETAILS
                      + tx.INSTRUCTION_EMPTY_CONTENT + tx.INSTRUCTION_TAIL)
    fb = df.withColumn("e", F.when(F.col("c") == "x", F.lit("timeout")))
    out = [r.a for r in fb.select(tx.fallback_answer("t", "c", "e").alias("a")).collect()]
    assert out[1].startswith(tx.FALLBACK_EMPTY_TITLE + tx.FALLBACK_DESCRIPTION + tx.FALLBACK_EMPTY_CONTENT)
    assert tx.FALLBACK_REASON + "timeout." in out[2] and tx.FALLBACK_REASON not in out[0]
    assert out[0].endswith(tx.FALLBACK_GUIDANCE)


def test_tokenize_unicode_words(spark):
    got = _eval(spark, ["Ünïcode wörds, a b 12 x_y ÉTÉ"], tx.tokenize)[0]
    assert got == ["ünïcode", "wörds", "12", "x_y", "été"]


def test_sanitize_fragment(spark):
    assert _eval(spark, ["poisson 1.5/s run"], tx.sanitize_fragment) == ["poisson-1_5-s-run"]


def test_whitespace_set_is_python_isspace():
    want = {chr(i) for i in range(0x110000) if chr(i).isspace()}
    assert set(tx.WHITESPACE_CHARS) == want

"""Id and timestamp helpers."""

from __future__ import annotations

import re

from verity.functions.ids import derived_id, iso_utc, new_id, now_iso


def test_ids(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None)], "k string, n int")
    rows = df.select(new_id().alias("r"), derived_id("k", "n").alias("d"), now_iso().alias("t")).collect()
    assert all(re.fullmatch(r"[0-9a-f]{32}", r.r) for r in rows)
    assert len({r.r for r in rows}) == 3
    assert rows[0].d == rows[1].d != rows[2].d
    assert all(re.fullmatch(r"[0-9a-f]{32}", r.d) for r in rows)
    assert all(re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{6}Z", r.t) for r in rows)
    again = df.select(derived_id("k", "n").alias("d")).collect()
    assert [r.d for r in again] == [r.d for r in rows]


def test_iso_utc(spark):
    df = spark.sql("SELECT TIMESTAMP '2024-01-02 03:04:05.5' AS ts")
    assert df.select(iso_utc("ts").alias("s")).first().s == "2024-01-02T03:04:05.500000Z"

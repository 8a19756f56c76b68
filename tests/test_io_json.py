"""JSON decode/validate, CSV question scan, bulk import, append log."""

from __future__ import annotations

import csv
import os

import pytest
from pyspark.sql import functions as F

from verity.functions.json import INVALID_PAYLOAD, decode, encode, split_valid, validate_score_requests
from verity.sources.files import append_csv_log, import_json_if_absent, load_questions_csv, read_csv_log


def test_decode_defaults_and_invalid(spark):
    df = spark.createDataFrame(
        [("k1", '{"message_id": "m1", "trace_id": "t1"}'),
         ("k2", "not json"),
         ("k3", '{"message_id": "m3", "question_id": "q3", "title": "T", "attempts": 2}'),
         ("k4", "[1, 2]")], "key string, value string")
    out = {r.key: r for r in decode(df, "question").collect()}
    assert out["k1"].valid and out["k1"].question_id == "" and out["k1"].attempts == 0
    assert out["k1"].source == "traffic-generator"
    assert out["k2"].valid is False and out["k2"].message_id is None
    assert out["k3"].title == "T" and out["k3"].attempts == 2
    assert out["k4"].valid is False


def test_encode_keeps_nulls_and_round_trips(spark):
    df = spark.createDataFrame(
        [("m1", "t1", "q1", "RuntimeError", "boom", 2, None, "2024-01-01T00:00:00Z")],
        "message_id string, trace_id string, question_id string, error_type string, error_detail string, "
        "attempts int, retry_at string, produced_at string")
    enc = encode(df, "error")
    row = enc.collect()[0]
    assert row.key == "m1" and '"retry_at":null' in row.value
    back = decode(enc, "error").collect()[0]
    assert back.valid
    assert back.error_detail == "boom" and back.retry_at is None and back.attempts == 2


def test_validate_score_requests(spark):
    df = spark.createDataFrame(
        [("a", '{"question_id": 17, "best_answer": "x"}'),
         ("b", '{"best_answer": "x"}'),
         ("c", "{broken"),
         ("d", '{"question_id": "q4"}')], "key string, value string")
    out = {r.key: r for r in validate_score_requests(df).collect()}
    assert out["a"].status == "ok" and out["a"].question_id == "17" and out["a"].llm_answer == ""
    assert out["b"].status == INVALID_PAYLOAD and out["c"].status == INVALID_PAYLOAD
    assert out["d"].best_answer == "" and out["d"].status == "ok"


def test_decode_loose_types_required_fields_and_stamps(spark):
    df = spark.createDataFrame(
        [("a", '{"message_id": 5, "trace_id": "t", "question_id": "q", "attempts": "2", "latency_ms": "1.5"}'),
         ("b", '{"message_id": "m", "trace_id": "t", "question_id": "q", "attempts": "two"}'),
         ("c", '{"trace_id": "t", "question_id": "q"}'), ("d", None), ("e", "")], "key string, value string")
    rows = decode(df, "llm_response", keep=("key", "value"), stamp=True)
    out = {r.key: r for r in rows.collect()}
    assert out["a"].valid and (out["a"].message_id, out["a"].attempts, out["a"].latency_ms) == ("5", 2, 1.5)
    assert out["a"].produced_at.endswith("Z") and out["a"].llm_answer == ""
    assert {k: out[k].reason for k in "bcde"} == {
        "b": "bad attempts", "c": "missing message_id", "d": "not a JSON object", "e": "not a JSON object"}
    good, bad = split_valid(rows)
    assert (good.count(), bad.count()) == (1, 4) and bad.columns == ["key", "value", "reason"]
    ids = [decode(df.filter("key = 'd'").withColumn("value", F.lit("{}")), "question", stamp=True).first().message_id
           for _ in range(2)]
    assert ids[0] == ids[1] and len(ids[0]) == 32          # the same message gets the same id again


def test_csv_like_a_dict_reader(spark, tmp_path):
    text = ('id,question_title,question_content,best_answer\r\n'
            '1,"two\nlines","says ""hi"", twice",x\r\n2,,"",plain\r\n3,"a, b",c\r\n4,t\r\n')
    p = tmp_path / "q.csv"
    p.write_bytes(text.encode())
    want = {}
    with open(p, newline="", encoding="utf-8") as f:
        for r in csv.DictReader(f):
            want[r["id"]] = (r["question_title"], r["question_content"], r["best_answer"])
    got = {r._id: (r.question_title, r.question_content, r.best_answer) for r in load_questions_csv(spark, str(p)).collect()}
    assert got == want


SAMPLE = (
    "id,question_title,question_content,best_answer\n"
    "a1,Title one,Content one,\"Quoted, full answer\"\n"
    "a2,Title two,Content two,I think so, maybe 2-1.\n"
    ",No id,Dropped,x\n"
    "a4,Short row\n"
)


@pytest.mark.parametrize("split", [37, 200, 5000])
def test_csv_splits_inside_quoted_fields(spark, tmp_path, split):
    """Files cut every few bytes, in the middle of quoted fields with line ends: the rows of csv.DictReader."""
    import csv
    import random

    from verity.sources.csv_records import read_csv_records

    rnd = random.Random(split)
    bits = ['a', 'é', '""', ',', '\n', '\r\n', ' ', '5" x', "it's", "long " * 20]
    for f in range(3):
        with open(tmp_path / f"{f}.csv", "w", encoding="utf-8", newline="") as out:
            out.write('id,"t\n1",c\r\n' if f == 1 else 'id,"t\n1",c\n')
            for i in range(60):
                quoted = '"' + "".join(rnd.choice([b for b in bits if '" x' not in b]) for _ in range(rnd.randrange(8))) + '"'
                plain = "".join(rnd.choice(["a", "é", "x\"y", " "]) for _ in range(rnd.randrange(4))).lstrip('"')
                row = rnd.choice([f"{f}-{i},{quoted},{plain}", f"{f}-{i},{plain},{quoted}", f"{f}-{i}", f"{f}-{i},{quoted},{plain},more,{quoted}", ""])
                out.write(row + rnd.choice(["\n", "\r\n"]))
            if f == 2:
                out.write('open,"never closed\nto the end')
    want = []
    for f in range(3):
        with open(tmp_path / f"{f}.csv", encoding="utf-8", newline="") as src:
            want += [tuple(r[c] for c in ("id", "t\n1", "c")) for r in csv.DictReader(src)]
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, str(split))
        df = read_csv_records(spark, str(tmp_path), ["id", "t", "c"])
        got = [tuple(r) for r in df.collect()]
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert tasks > 3 or split == 5000


def test_csv_question_scan(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text(SAMPLE, encoding="utf-8")
    out = {r._id: r for r in load_questions_csv(spark, str(p)).collect()}
    assert set(out) == {"a1", "a2", "a4"}
    assert out["a1"].best_answer == "Quoted, full answer"
    assert out["a2"].best_answer == "I think so"            # unquoted comma cuts the field
    assert out["a4"].question_content is None                # short row keeps NULL


def test_csv_underscore_id_and_absent_columns(spark, tmp_path):
    p = tmp_path / "q2.csv"
    p.write_text("_id,question_title\nz1,Only title\n", encoding="utf-8")
    rows = load_questions_csv(spark, str(p)).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r._id == "z1" and r.question_title == "Only title"
    assert r.question_content == "" and r.best_answer == ""


def test_import_only_when_absent(spark, tmp_path):
    src = tmp_path / "bdd.json"
    src.write_text('{"_id": "1", "question_title": "a"}\n{"_id": "2", "question_title": "b"}\n')
    target = str(tmp_path / "questions")
    assert import_json_if_absent(spark, str(src), target) is True
    src.write_text('{"_id": "3", "question_title": "c"}\n')
    assert import_json_if_absent(spark, str(src), target) is False
    assert sorted(r._id for r in spark.read.parquet(target).collect()) == ["1", "2"]


def test_append_log(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame(
        [("2024-01-01T00:00:00", "PUBLISH", "m1", "q1", "ok", 0.5, "questions_in")],
        "timestamp string, operation string, message_id string, question_id string, status string, "
        "latency double, topic string")
    append_csv_log(rows, path)
    append_csv_log(rows.withColumn("message_id", F.lit("m2")), path)
    back = read_csv_log(spark, path).collect()
    assert sorted(r.message_id for r in back) == ["m1", "m2"]
    assert all(r.latency == 0.5 for r in back)
    parts = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert all(open(os.path.join(path, f)).readline().startswith("timestamp,") for f in parts)

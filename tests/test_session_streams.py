"""Checkpoint folder choice, multi-topic source and the streaming topic sink."""

from __future__ import annotations

import json
import os

from pyspark.sql import functions as F

from verity.functions.json import decode
from verity.session import ensure_checkpoint_dir
from verity.sources.streams import read_topic_batch, read_topics, topic_writer


def test_checkpoint_dir_is_set(spark):
    d = ensure_checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def _drop(folder, name, records, mtime):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as h:
        for r in records:
            h.write(json.dumps(r) + "\n")
    os.utime(p, (mtime, mtime))


def test_two_topics_one_stream_and_sink(spark, tmp_path):
    qdir, rdir = str(tmp_path / "questions_in"), str(tmp_path / "regeneration_requests")
    _drop(qdir, "a.json", [{"message_id": "m1", "question_id": "q1", "title": "T"}], 1_700_000_000)
    _drop(rdir, "a.json", [{"message_id": "m2", "question_id": "q2", "prompt": "P", "attempts": 1}],
          1_700_000_001)
    src = read_topics(spark, ["questions_in", "regeneration_requests"], paths=[qdir, rdir])
    q1 = decode(src.filter(F.col("topic") == "questions_in"), "question", keep=("key", "topic", "value"), stamp=True)
    out = str(tmp_path / "llm_requests")
    w = topic_writer(q1.withColumn("prompt", F.col("title")).withColumn("created_at", F.lit("")),
                     "llm_request", "llm_requests", path=out, checkpoint=str(tmp_path / "ck"))
    q = w.trigger(availableNow=True).start()
    q.awaitTermination(300)
    assert q.exception() is None
    back = decode(read_topic_batch(spark, "llm_requests", out), "llm_request").collect()
    assert [(r.key, r.message_id, r.prompt, r.attempts) for r in back] == [("m1", "m1", "T", 0)]

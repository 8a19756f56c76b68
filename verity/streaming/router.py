"""The request side as streams: questions and rejected answers in, validated hits and requests out.

``start_router`` consumes two topics.  A question whose stored answer is usable becomes a validated record
(``storage`` when it fills the cache, ``cache`` while the entry lives); any other becomes a request.  A
regeneration record becomes a request with the same prompt.  ``start_worker`` answers requests: the generator's
answer, else the fallback text, and an error record for every failure, with the time to retry at.

The cache's entries (question id and the time it was filled) are a versioned table: micro-batch ``n`` routes its
questions together with the entries that batches before it left (``route_requests``, the batch operator, sees
them as earlier requests) and writes the entries it changed as delta ``n``.  Stored results and entries are bucketed by
question: a micro-batch reads the files of its own questions' buckets, and only these questions' rows are combined, so
its cost follows the batch.  What it checkpoints and persists is removed when it ends.  Inside a micro-batch the join strategy is left to AQE.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from verity.functions.ids import now_iso
from verity.functions.json import decode, split_valid
from verity.functions.text import offline_answer
from verity.operators import decide, reuse
from verity.operators.analytics import error_backoff
from verity.session import checkpoints_removed
from verity.sources import snapshots as snap
from verity.sources.streams import delivered_once, read_topic, read_topics
from verity.streaming.sinks import QUARANTINE, BatchSinks, make_folder, start
from verity.streaming.storage import COMPACT_EVERY, current_results

QUESTIONS, REGENERATION = "questions_in", "regeneration"


def latest_entries(rows: DataFrame) -> DataFrame:
    """(question_id, stored_at): the newest time each entry was filled."""
    return rows.groupBy("question_id").agg(F.max("stored_at").alias("stored_at"))


def route_batch(questions: DataFrame, store: DataFrame, entries: DataFrame | None,
                ttl_seconds: float = reuse.CACHE_TTL_SECONDS) -> DataFrame:
    """Questions (with ``ts``, parsed ``created_at``) -> the same with ``route``, given the cache's entries."""
    # An id per row: a question may be sent again, even as the very same message.
    same = F.sha2(F.to_json(F.struct(*questions.columns)), 256)
    rows = questions.withColumn("_same", same)
    nth = F.row_number().over(Window.partitionBy("_same").orderBy("_same"))
    rows = rows.withColumn("_row", F.concat(F.lit("q"), "_same", F.lit("-"), nth.cast("string"))).drop("_same")
    slim = rows.select("question_id", "ts", "message_id", "_row")
    if entries is not None:
        old = entries.join(slim.select("question_id").distinct(), "question_id", "left_semi").select(
            "question_id", F.col("stored_at").alias("ts"), F.lit("").alias("message_id"),
            F.concat(F.lit("e"), "question_id").alias("_row"))
        slim = slim.unionByName(old)
    routed = reuse.route_requests(slim, store, ttl_seconds, "question_id", "ts", "message_id", "_row")
    return rows.join(routed.select("_row", "route"), "_row").drop("_row")


def start_router(spark: SparkSession, questions: str, regeneration: str, validated: str, requests: str,
                 results_root: str, cache_root: str, checkpoint: str, quarantine: str | None = None,
                 ttl_seconds: float = reuse.CACHE_TTL_SECONDS, max_per_trigger: int | None = None, fmt: str = "files",
                 available_now: bool = True, decided_at: Column | None = None, kafka_servers: str | None = None,
                 kafka_options: Mapping[str, str] | None = None, once_within: str | None = None):
    """Start the router: questions and regeneration records -> validated hits / requests / quarantine.

    Topics are folders, or Kafka topics with ``fmt="kafka"``; ``results_root`` and ``cache_root`` are folders on
    shared storage.  ``decided_at`` is the time of the decision unless a column over the question is given.
    ``once_within``: messages delivered again in that time are routed once (``sources.streams.delivered_once``)."""
    topics = {"validated": validated, "requests": requests,
              QUARANTINE: quarantine or f"{requests.rstrip('/')}_quarantine"}
    sinks = BatchSinks(topics, checkpoint, fmt, kafka_servers, kafka_options)
    if fmt == "files":
        make_folder(spark, questions)
        make_folder(spark, regeneration)
    raw = read_topics(spark, [questions, regeneration], fmt, [questions, regeneration],
                      max_per_trigger=max_per_trigger, kafka_servers=kafka_servers, kafka_options=kafka_options)

    def sink(batch: DataFrame, batch_id: int) -> None:
        held = [batch.persist()]
        try:
            with checkpoints_removed(spark):
                route(held[0], batch_id, held)
        finally:
            for frame in held:
                frame.unpersist()

    def route(batch: DataFrame, batch_id: int, held: list[DataFrame]) -> None:
        asked, bad = split_valid(decode(batch.filter(F.col("topic") == questions), "question",
                                        keep=("key", "value"), stamp=True))
        again, bad_again = split_valid(decode(batch.filter(F.col("topic") == regeneration), "regeneration",
                                              keep=("key", "value")))
        asked = asked.drop("key").withColumn("ts", F.try_to_timestamp(F.col("created_at")))
        # Of the stored results and of the cache's entries, only the buckets of this batch's questions.
        ids = asked.select("question_id")
        store = current_results(spark, results_root, ids=ids.withColumnRenamed("question_id", "id_pregunta"))
        at = decided_at if decided_at is not None else now_iso()
        outputs = {}
        if store is None:
            fresh = asked
        else:
            store = store.persist()
            held.append(store)
            entries = snap.current_parts(spark, cache_root, upto=batch_id - 1, buckets=snap.buckets_of(ids, "question_id"))
            routed = route_batch(asked, store, None if entries is None else latest_entries(entries), ttl_seconds).persist()
            held.append(routed)
            hits = routed.filter(F.col("route") != reuse.ROUTE_LLM)
            stored = reuse.usable_answers(store).withColumnRenamed("id_pregunta", "question_id")
            joined = hits.select("message_id", "trace_id", "question_id", "route", "attempts", at.alias("_at")).join(
                stored, "question_id")
            outputs["validated"] = ("validated", reuse.hit_projection(joined, F.col("route"), "_at"))
            filled = hits.filter(F.col("route") == reuse.SOURCE_STORAGE).select("question_id", F.col("ts").alias("stored_at"))
            snap.write_delta(latest_entries(filled), cache_root, batch_id, "question_id")
            if (batch_id + 1) % COMPACT_EVERY == 0:
                snap.compact(spark, cache_root, batch_id, latest_entries, "question_id")
            fresh = routed.filter(F.col("route") == reuse.ROUTE_LLM)
        first, repeat = decide.first_requests(fresh), decide.repeat_requests(again)
        outputs["requests"] = ("llm_request", first.unionByName(repeat).withColumn("created_at", now_iso()))
        outputs[QUARANTINE] = (None, bad.unionByName(bad_again))
        if "validated" not in outputs:
            empty = reuse.hit_projection(fresh.filter("false").select("*", *[
                F.lit(None).cast("string").alias(c) for c in ("pregunta", "contenido", "respuesta_llm", "respuesta_dataset")],
                F.lit(None).cast("double").alias("score"), F.lit(None).cast("boolean").alias("aceptado")))
            outputs["validated"] = ("validated", empty)
        if not sinks.done(spark, batch_id):
            sinks.write(batch_id, outputs)

    return start(delivered_once(raw, once_within), sink, checkpoint, available_now)


def start_worker(spark: SparkSession, requests: str, responses: str, errors: str, checkpoint: str,
                 generator: decide.Generator = offline_answer, error: Column | None = None, fallback: bool = True,
                 quarantine: str | None = None, max_per_trigger: int | None = None, fmt: str = "files",
                 available_now: bool = True, kafka_servers: str | None = None,
                 kafka_options: Mapping[str, str] | None = None, once_within: str | None = None):
    """Start the answer worker: requests -> responses / errors / quarantine (``decide.generate_with_fallback``)."""
    topics = {"responses": responses, "errors": errors,
              QUARANTINE: quarantine or f"{responses.rstrip('/')}_quarantine"}
    sinks = BatchSinks(topics, checkpoint, fmt, kafka_servers, kafka_options)
    if fmt == "files":
        make_folder(spark, requests)
    raw = read_topic(spark, requests, fmt, requests, max_per_trigger, kafka_servers, kafka_options)
    decoded = decode(delivered_once(raw, once_within), "llm_request", keep=("key", "value"), stamp=True)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if sinks.done(spark, batch_id):
            return
        batch = batch.persist()
        try:
            good, bad = split_valid(batch)
            answers, failures = decide.generate_with_fallback(good, generator, error, fallback, now_iso())
            failures = error_backoff(failures.withColumn("ts", F.try_to_timestamp(F.col("produced_at"))))
            sinks.write(batch_id, {"responses": ("llm_response", answers), "errors": ("error", failures), QUARANTINE: (None, bad)})
        finally:
            batch.unpersist()

    return start(decoded, sink, checkpoint, available_now)

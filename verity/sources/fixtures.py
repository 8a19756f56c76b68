"""Views over the driver tables that the registered queries run on.

Each view maps a driver table onto one of the pipeline's record shapes
(questions, answers, scored responses, request traces, stored results,
validated decisions, logs, errors, correlated stages, raw JSON).  They only
project and join, so Catalyst prunes every unused column at the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.functions.text import build_prompt, offline_answer
from verity.operators.sequence import keyed_scan
from verity.sources.schemas import ISO_FORMAT
from verity.sources.tables import table, utc

# Fixed values of the views.
QUESTION_CREATED_AT = "2024-01-01T00:00:00.000000Z"
QUESTION_SOURCE = "traffic-generator"
ACCEPTED_EVENT_TYPES = ("purchase", "signup")


def iso(c) -> F.Column:
    return F.date_format(c, ISO_FORMAT)


def clamp01(c) -> F.Column:
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), c))


def v_questions(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents")
    qid = d.doc_id.cast("string")
    return d.select(
        F.concat(F.lit("m"), qid).alias("message_id"),
        F.concat(F.lit("t"), qid).alias("trace_id"),
        qid.alias("question_id"),
        F.concat(d.lang, F.lit("/"), d.source).alias("title"),
        d.text.alias("content"),
        d.text.alias("best_answer"),
        F.lit(QUESTION_SOURCE).alias("source"),
        F.lit(QUESTION_CREATED_AT).alias("created_at"),
        F.lit(0).alias("attempts"),
    )


def v_answers(spark: SparkSession, root: str) -> DataFrame:
    q = v_questions(spark, root).withColumn("prompt", build_prompt("title", "content"))
    return q.withColumn("llm_answer", offline_answer("prompt"))


def v_pairs(spark: SparkSession, root: str) -> DataFrame:
    c = table(spark, root, "conversations").select("conv_id", "turn", "role", "text")
    u = c.filter(c.role == "user").alias("u")
    a = c.filter(c.role == "assistant").alias("a")
    j = u.join(a, (F.col("a.conv_id") == F.col("u.conv_id")) & (F.col("a.turn") == F.col("u.turn") + 1))
    return j.select(
        F.concat(F.col("u.conv_id").cast("string"), F.lit("-"), F.col("u.turn").cast("string")).alias("message_id"),
        F.col("u.conv_id").cast("string").alias("question_id"),
        F.col("u.text").alias("best_answer"),
        F.col("a.text").alias("llm_answer"),
    )


def _events(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events")


def v_attempts(spark: SparkSession, root: str) -> DataFrame:
    """A scored response stream keyed by user: message_id = user_id."""
    e = _events(spark, root)
    return e.select(
        e.user_id.cast("string").alias("message_id"),
        F.concat(F.lit("t"), e.event_id.cast("string")).alias("trace_id"),
        e.user_id.cast("string").alias("question_id"),
        e.event_type.alias("title"),
        e.props.alias("content"),
        F.concat(e.event_type, F.lit("\n\n"), e.props).alias("prompt"),
        e.props.alias("llm_answer"),
        e.event_type.alias("best_answer"),
        e.value.alias("latency_ms"),
        F.lit(1).alias("attempts"),
        iso(utc("ts")).alias("produced_at"),
        utc("ts").alias("ts"),
        e.event_id,
        clamp01(e.value / 100).alias("score"),
    )


def v_trace(spark: SparkSession, root: str) -> DataFrame:
    e = _events(spark, root)
    return e.select(
        e.event_id.cast("string").alias("message_id"),
        F.concat(F.lit("t"), e.event_id.cast("string")).alias("trace_id"),
        e.user_id.cast("string").alias("question_id"),
        e.event_type.alias("title"),
        e.props.alias("content"),
        e.event_type.alias("best_answer"),
        F.lit(QUESTION_SOURCE).alias("source"),
        iso(utc("ts")).alias("created_at"),
        F.lit(0).alias("attempts"),
        utc("ts").alias("ts"),
        e.event_id,
    )


def v_store(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents").select("doc_id", "lang", "source", "text")
    lab = table(spark, root, "labels").select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        F.col("doc_id").cast("string").alias("id_pregunta"),
        F.concat(F.col("lang"), F.lit("/"), F.col("source")).alias("pregunta"),
        F.col("text").alias("contenido"),
        F.col("text").alias("respuesta_dataset"),
        F.when(F.col("quality") == 1, F.col("text"))
         .when(F.col("quality") == 0, F.lit("")).alias("respuesta_llm"),
        F.col("quality").cast("double").alias("score"),
        ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("aceptado"),
    )


def v_validated(spark: SparkSession, root: str) -> DataFrame:
    e = _events(spark, root)
    return e.select(
        e.event_id.cast("string").alias("message_id"),
        F.concat(F.lit("t"), e.event_id.cast("string")).alias("trace_id"),
        e.user_id.cast("string").alias("question_id"),
        e.event_type.alias("title"),
        e.props.alias("content"),
        e.props.alias("llm_answer"),
        e.event_type.alias("best_answer"),
        clamp01(e.value / 100).alias("score"),
        e.event_type.isin(*ACCEPTED_EVENT_TYPES).alias("accepted"),
        e.event_type.alias("source"),
        F.lit(1).alias("attempts"),
        iso(utc("ts")).alias("decided_at"),
        utc("ts").alias("decided_ts"),
    )


def v_log(spark: SparkSession, root: str) -> DataFrame:
    e = _events(spark, root)
    return e.select(
        utc("ts").alias("timestamp"),
        F.lit("PUBLISH").alias("operation"),
        e.event_id.cast("string").alias("message_id"),
        e.user_id.cast("string").alias("question_id"),
        e.event_type.alias("status"),
        e.value.alias("latency"),
        F.lit("questions_in").alias("topic"),
        e.event_id,
    )


def v_errors(spark: SparkSession, root: str) -> DataFrame:
    """Error events; attempts = position of the error per user."""
    e = _events(spark, root).filter(F.col("event_type") == "error")
    e = e.select(
        e.event_id, utc("ts").alias("ts"), e.user_id,
        e.event_id.cast("string").alias("message_id"),
        F.concat(F.lit("t"), e.event_id.cast("string")).alias("trace_id"),
        e.user_id.cast("string").alias("question_id"),
        F.lit("RuntimeError").alias("error_type"),
        e.props.alias("error_detail"),
    )
    ranked = keyed_scan(e, ["user_id"], ["ts", "event_id"])
    return ranked.withColumn("attempts", F.col("_pos").cast("int")).drop("_pos")


def v_json(spark: SparkSession, root: str) -> DataFrame:
    """Raw JSON messages: mostly valid, some broken, some lacking question_id."""
    e = _events(spark, root)
    body = F.struct(
        e.event_id.cast("string").alias("message_id"),
        F.concat(F.lit("t"), e.event_id.cast("string")).alias("trace_id"),
        F.when(e.event_id % 50 != 1, e.user_id.cast("string")).alias("question_id"),
        e.event_type.alias("title"),
        e.event_type.alias("best_answer"),
        e.props.alias("llm_answer"),
        F.floor(e.value / 100).cast("int").alias("attempts"),
    )
    return e.select(
        e.event_id.cast("string").alias("key"),
        F.when(e.event_id % 50 == 0, F.lit("{bad")).otherwise(F.to_json(body)).alias("value"),
    )


def v_attempts_nulls(spark: SparkSession, root: str) -> DataFrame:
    """``v_attempts`` with NULL keys, times and scores mixed in by event id."""
    a = v_attempts(spark, root)
    gap = lambda c, n, r: F.when(F.col("event_id") % n != r, F.col(c)).alias(c)
    return a.select("trace_id", "event_id", gap("message_id", 11, 3), gap("ts", 13, 4), gap("score", 7, 2))


def v_odd_validated(spark: SparkSession, root: str) -> DataFrame:
    """``v_validated`` with times cut to ten minutes (ties), in two forms (with
    and without a fraction), and some NULL question ids."""
    v = v_validated(spark, root)
    us = F.unix_micros("decided_ts")
    cut = F.timestamp_micros(us - F.pmod(us, F.lit(600_000_000)))
    whole = F.date_format(cut, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    at = F.when(F.col("message_id").cast("long") % 2 == 0, iso(cut)).otherwise(whole)
    qid = F.when(F.col("message_id").cast("long") % 17 != 5, F.col("question_id"))
    return v.withColumn("decided_at", at).withColumn("question_id", qid).drop("decided_ts")


def v_attempt_pairs(spark: SparkSession, root: str) -> DataFrame:
    """Several answers under one message id: all (user, assistant) turns of a conversation."""
    p = v_pairs(spark, root)
    return p.select(F.col("question_id").alias("message_id"), F.col("message_id").alias("turn_id"),
                    "best_answer", "llm_answer")

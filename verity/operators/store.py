"""Persisted results: per-question upsert, merge onto a prior table, global metrics.

The reference applies one document update per message.  Here a batch of
validated records becomes one aggregation per question (map-side partial
aggregation, so a hot question costs one partial row per task), and later
batches merge with it by one more aggregation over such rows:

* counter  = prior count + batch count            (``$inc``)
* created  = the earliest record's time           (``$setOnInsert``)
* fields   = the newest record wins                 (``$set``), ordered by
             (time, message_id, hash of the record) so replays and late
             records cannot overwrite newer values.

A stored row keeps that order key (``ORDER_FIELDS``: of the newest record, and
of the earliest), so a merge compares what a single pass would.
Times are parsed, never compared as text; a time that does not parse is older
than any for the newest record and later than any for the earliest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SET_FIELDS = [("title", "pregunta"), ("content", "contenido"), ("best_answer", "respuesta_dataset"),
               ("llm_answer", "respuesta_llm"), ("score", "score"), ("accepted", "aceptado"),
               ("decided_at", "ultima_actualizacion")]
RESULT_COLUMNS = ["id_pregunta", "pregunta", "contenido", "respuesta_dataset", "respuesta_llm", "score",
                  "aceptado", "ultima_actualizacion", "contador_consultas", "creado_en"]
ORDER_FIELDS = ["last_ts", "last_id", "last_tie", "first_ts", "first_id"]
METRIC_COLUMNS = ["_id", "procesadas", "aceptadas", "rechazadas", "score_acum", "ultimo_score",
                  "actualizado_en", "creado_en"]


def _time(validated: DataFrame) -> Column:
    return F.col("decided_ts") if "decided_ts" in validated.columns else F.try_to_timestamp(F.col("decided_at"))


# Order keys: of the newest record (NULL times first) and of the earliest (NULL times last).
def _newest() -> Column:
    return F.struct("last_ts", "last_id", "last_tie")


def _earliest() -> Column:
    return F.struct(F.col("first_ts").isNull(), F.col("first_ts"), F.col("first_id"), F.col("creado_en"))


def _keyed(validated: DataFrame) -> DataFrame:
    """Records with the order key of each."""
    return validated.withColumns({
        "last_ts": _time(validated), "last_id": F.col("message_id"),
        "last_tie": F.xxhash64(*[src for src, _ in _SET_FIELDS if src in validated.columns]),
        "first_ts": _time(validated), "first_id": F.col("message_id"), "creado_en": F.col("decided_at")})


def results_state(validated: DataFrame) -> DataFrame:
    """Validated records -> one row per question, with its order key."""
    rows = _keyed(validated).select(
        F.col("question_id").alias("id_pregunta"), *[F.col(src).alias(dst) for src, dst in _SET_FIELDS],
        F.lit(1).cast("long").alias("contador_consultas"), "creado_en", *ORDER_FIELDS)
    return combine_states(rows)


def results_upsert(validated: DataFrame) -> DataFrame:
    """Validated records -> one result document per question (without the order key)."""
    return results_state(validated).select(*RESULT_COLUMNS)


def combine_states(states: DataFrame) -> DataFrame:
    """One row per question out of any number of ``results_state`` rows of it
    (associative and commutative, NULL ids are one question)."""
    newest = F.struct(*[dst for _, dst in _SET_FIELDS], "last_ts", "last_id", "last_tie")
    earliest = F.struct("creado_en", "first_ts", "first_id")
    return states.groupBy("id_pregunta").agg(
        F.max_by(newest, _newest()).alias("_last"), F.min_by(earliest, _earliest()).alias("_first"),
        F.sum("contador_consultas").alias("contador_consultas"),
    ).select("id_pregunta", "contador_consultas", "_last.*", "_first.*").select(*RESULT_COLUMNS, *ORDER_FIELDS)


def results_merge(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Merge a batch of validated records onto a prior ``results_state``; the
    result is a ``results_state`` again, the one a single pass would give."""
    return combine_states(prior.select(*RESULT_COLUMNS, *ORDER_FIELDS).unionByName(results_state(batch)))


def metrics_partial(validated: DataFrame) -> DataFrame:
    """One-row running totals of a set of validated records, with the order key (mergeable)."""
    rows = _keyed(validated)
    last = F.struct(F.col("score").alias("ultimo_score"), F.col("decided_at").alias("actualizado_en"),
                    "last_ts", "last_id", "last_tie")
    first = F.struct("creado_en", "first_ts", "first_id")
    return rows.agg(
        F.count(F.lit(1)).alias("procesadas"),
        F.count_if(F.col("accepted")).alias("aceptadas"),
        F.count_if(~F.col("accepted")).alias("rechazadas"),
        F.sum("score").alias("score_acum"),
        F.max_by(last, _newest()).alias("_last"), F.min_by(first, _earliest()).alias("_first"),
    ).select(F.lit("global").alias("_id"), "procesadas", "aceptadas", "rechazadas", "score_acum", "_last.*", "_first.*") \
        .select(*METRIC_COLUMNS, *ORDER_FIELDS)


def combine_metrics(rows: DataFrame) -> DataFrame:
    """One metric row out of any number: counts and sums add, newest last score, first creation."""
    used = rows.filter(F.col("procesadas") > 0)
    newest = F.struct("ultimo_score", "actualizado_en", "last_ts", "last_id", "last_tie")
    earliest = F.struct("creado_en", "first_ts", "first_id")
    return used.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("procesadas", "aceptadas", "rechazadas")],
        F.sum("score_acum").alias("score_acum"),
        F.max_by(newest, _newest()).alias("_last"),
        F.min_by(earliest, _earliest()).alias("_first"),
    ).select(F.lit("global").alias("_id"), "procesadas", "aceptadas", "rechazadas", "score_acum", "_last.*", "_first.*") \
        .select(*METRIC_COLUMNS, *ORDER_FIELDS)


def merge_metrics(prior: DataFrame, batch: DataFrame) -> DataFrame:
    """Combine two metric rows (with order keys)."""
    return combine_metrics(prior.unionByName(batch))


def global_metrics(validated: DataFrame) -> DataFrame:
    """Global metrics document plus the mean score the docs promise."""
    m = metrics_partial(validated).select(*METRIC_COLUMNS)
    return m.withColumn("score_medio", F.col("score_acum") / F.col("procesadas"))

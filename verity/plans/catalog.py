"""Registered queries: one per operator of the pipeline.

Each query is ``(spark, root) -> DataFrame`` over the driver tables in
``root``; ``ORACLES`` holds the DuckDB SQL that must give the same rows.
Every query reads whole tables: there are no id subsets, prefixes or caps.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.functions import text as tx
from verity.operators import score as sc
from verity.plans import sqlviews as sv
from verity.plans.sqlviews import WS, with_views
from verity.sources import fixtures as fx
from verity.sources.tables import question_documents, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


TOKENS_SQL = r"regexp_extract_all(lower({c}), '[\p{{L}}\p{{N}}_]{{2,}}')"


def _tok(c: str) -> str:
    return TOKENS_SQL.format(c=c)


UNSHARED = "(ln(1.5) + 1.0)"


def _score_ctes(view: str, key: str = "message_id") -> str:
    """CTEs (after a ``WITH``) ending in ``r``: the view's rows plus ``raw`` score,
    computed with unnest + GROUP BY, independently of the DataFrame plan."""
    return f""",
toks AS (
  SELECT {key}, t, 0 AS s FROM {view}, unnest({_tok('best_answer')}) AS u(t)
  UNION ALL
  SELECT {key}, t, 1 AS s FROM {view}, unnest({_tok('llm_answer')}) AS u(t)),
tf AS (
  SELECT {key}, t, count(*) FILTER (WHERE s = 0) AS ca, count(*) FILTER (WHERE s = 1) AS cb
  FROM toks GROUP BY {key}, t),
w AS (
  SELECT {key},
         ca * CASE WHEN ca > 0 AND cb > 0 THEN 1.0 ELSE {UNSHARED} END AS wa,
         cb * CASE WHEN ca > 0 AND cb > 0 THEN 1.0 ELSE {UNSHARED} END AS wb
  FROM tf),
n AS (SELECT {key}, sum(wa * wb) AS dot, sum(wa * wa) AS na, sum(wb * wb) AS nb FROM w GROUP BY {key}),
r AS (
  SELECT p.*, CASE WHEN coalesce(length(p.best_answer), 0) = 0 OR coalesce(length(p.llm_answer), 0) = 0
                     OR coalesce(n.na, 0) = 0 OR coalesce(n.nb, 0) = 0 THEN 0.0
                   ELSE least(1.0, greatest(0.0, n.dot / (sqrt(n.na) * sqrt(n.nb)))) END AS raw
  FROM {view} p LEFT JOIN n USING ({key}))
"""


def _score_sql(view: str, extra_cols: str, digits: int = 6, accepted: float | None = None) -> str:
    acc = f", raw >= {accepted} AS accepted" if accepted is not None else ""
    return with_views(view) + _score_ctes(view) + f"SELECT {extra_cols}, round(raw, {digits}) AS score{acc} FROM r"


# --- 2.4 text scoring ------------------------------------------------------

@register("score_pairs", _score_sql("v_answers", "message_id, question_id"))
def q_score_pairs(spark: SparkSession, root: str) -> DataFrame:
    a = fx.v_answers(spark, root).select("message_id", "question_id", "best_answer", "llm_answer")
    return sc.score_pairs(a).select("message_id", "question_id", "score")


@register("score_conversation_pairs", _score_sql("v_pairs", "message_id, question_id"))
def q_score_conversation_pairs(spark: SparkSession, root: str) -> DataFrame:
    return sc.score_pairs(fx.v_pairs(spark, root)).select("message_id", "question_id", "score")


@register("score_attempts", with_views("v_attempt_pairs") + _score_ctes("v_attempt_pairs", "turn_id")
          + "SELECT message_id, turn_id, round(raw, 6) AS score FROM r")
def q_score_attempts(spark: SparkSession, root: str) -> DataFrame:
    """Several answers under one message id, scored apart by the default key."""
    return sc.score_pairs(fx.v_attempt_pairs(spark, root)).select("message_id", "turn_id", "score")


@register("evaluate_pairs", _score_sql("v_answers", "question_id", digits=4, accepted=sv.SERVICE_THRESHOLD))
def q_evaluate_pairs(spark: SparkSession, root: str) -> DataFrame:
    a = fx.v_answers(spark, root).select("message_id", "question_id", "best_answer", "llm_answer")
    return sc.evaluate_pairs(a).select("question_id", "score", "accepted")


@register("tokenize", with_views("v_questions") + f"""
SELECT message_id, CAST(len(tk) AS BIGINT) AS n_tokens,
       CAST(len(list_distinct(tk)) AS BIGINT) AS n_distinct, array_to_string(tk, ' ') AS tokens
FROM (SELECT message_id, {_tok('content')} AS tk FROM v_questions)""")
def q_tokenize(spark: SparkSession, root: str) -> DataFrame:
    q = fx.v_questions(spark, root).select("message_id", tx.tokenize("content").alias("tk"))
    return q.select("message_id", F.size("tk").cast("long").alias("n_tokens"),
                    F.size(F.array_distinct("tk")).cast("long").alias("n_distinct"),
                    F.array_join("tk", " ").alias("tokens"))


_TF_SQL = with_views("v_answers") + f""",
toks AS (
  SELECT message_id, t, 0 AS s FROM v_answers, unnest({_tok('best_answer')}) AS u(t)
  UNION ALL
  SELECT message_id, t, 1 AS s FROM v_answers, unnest({_tok('llm_answer')}) AS u(t)),
tf AS (
  SELECT message_id, t AS term, count(*) FILTER (WHERE s = 0) AS tf_expected,
         count(*) FILTER (WHERE s = 1) AS tf_actual
  FROM toks GROUP BY message_id, t)
"""


@register("term_frequencies", _TF_SQL + "SELECT * FROM tf")
def q_term_frequencies(spark: SparkSession, root: str) -> DataFrame:
    a = fx.v_answers(spark, root).select("message_id", "best_answer", "llm_answer")
    return sc.term_frequencies(a)


@register("pair_tfidf", _TF_SQL + f"""
SELECT message_id, term,
       CASE WHEN tf_expected > 0 AND tf_actual > 0 THEN 1.0 ELSE {UNSHARED} END AS idf,
       round(tf_expected * CASE WHEN tf_expected > 0 AND tf_actual > 0 THEN 1.0 ELSE {UNSHARED} END, 9) AS w_expected,
       round(tf_actual * CASE WHEN tf_expected > 0 AND tf_actual > 0 THEN 1.0 ELSE {UNSHARED} END, 9) AS w_actual
FROM tf""")
def q_pair_tfidf(spark: SparkSession, root: str) -> DataFrame:
    a = fx.v_answers(spark, root).select("message_id", "best_answer", "llm_answer")
    t = sc.pair_tfidf(sc.term_frequencies(a))
    return t.select("message_id", "term", "idf", F.round("w_expected", 9).alias("w_expected"),
                    F.round("w_actual", 9).alias("w_actual"))


# --- 2.5 answer generation ----------------------------------------------------

@register("build_prompts", with_views("v_prompted") + "SELECT message_id, prompt FROM v_prompted")
def q_build_prompts(spark: SparkSession, root: str) -> DataFrame:
    q = fx.v_questions(spark, root)
    return q.select("message_id", tx.build_prompt("title", "content").alias("prompt"))


@register("offline_answers", with_views("v_answers") + "SELECT message_id, llm_answer FROM v_answers")
def q_offline_answers(spark: SparkSession, root: str) -> DataFrame:
    return fx.v_answers(spark, root).select("message_id", "llm_answer")


def _strip_sql(c: str) -> str:
    return f"regexp_replace(coalesce({c}, ''), '^{WS}+|{WS}+$', '', 'g')"


def _placeholder_sql(c: str, ph: str) -> str:
    s = _strip_sql(c)
    return f"CASE WHEN {s} = '' THEN '{ph}' ELSE {s} END"


@register("instruction_prompts", with_views("v_questions") + f"""
SELECT message_id, '{sv.INSTRUCTION_INTRO}' || {_placeholder_sql('title', sv.INSTRUCTION_EMPTY_TITLE)}
       || chr(10) || chr(10) || 'Detalles adicionales: '
       || {_placeholder_sql('content', sv.INSTRUCTION_EMPTY_CONTENT)}
       || chr(10) || chr(10) || 'Respuesta:' AS prompt
FROM v_questions""")
def q_instruction_prompts(spark: SparkSession, root: str) -> DataFrame:
    q = fx.v_questions(spark, root)
    return q.select("message_id", tx.instruction_prompt("title", "content").alias("prompt"))


def _fallback_error_col() -> F.Column:
    # Generator failures in the fixture: documents of one source timed out.
    return F.when(F.col("title").endswith("/src0"), F.lit("timeout"))


_NL = "chr(10)"
_FALLBACK_BODY = f"""
SELECT message_id,
       {_placeholder_sql('title', sv.FALLBACK_EMPTY_TITLE)} || {_NL} || {_NL} || 'Descripción: '
       || {_placeholder_sql('content', sv.FALLBACK_EMPTY_CONTENT)} || {_NL} || {_NL}
       || 'Sugerencia generada localmente:' || {_NL}
       || '- Revisa la respuesta aceptada en el dataset.' || {_NL}
       || '- Considera desglosar el problema en pasos para verificar cada afirmación.' || {_NL} || {_NL}
       || '{sv.FALLBACK_NOTE}'
       || CASE WHEN ends_with(title, '/src0') THEN ' Motivo original: timeout.' ELSE '' END
       || ' ' || '{sv.FALLBACK_GUIDANCE}' AS answer
FROM v_questions"""


@register("fallback_answers", with_views("v_questions") + _FALLBACK_BODY)
def q_fallback_answers(spark: SparkSession, root: str) -> DataFrame:
    q = fx.v_questions(spark, root)
    return q.select("message_id", tx.fallback_answer("title", "content", _fallback_error_col()).alias("answer"))


# --- 2.1 scans ----------------------------------------------------------------

@register("scan_questions", """
SELECT CAST(doc_id AS VARCHAR) AS _id, lang || '/' || source AS question_title,
       text AS question_content, text AS best_answer
FROM documents""")
def q_scan_questions(spark: SparkSession, root: str) -> DataFrame:
    d = table(spark, root, "documents")
    return question_documents(d.select(
        F.col("doc_id").alias("_id"), F.concat("lang", F.lit("/"), "source").alias("question_title"),
        F.col("text").alias("question_content"), F.col("text").alias("best_answer")))


# --- 2.2 JSON, projections, validation ----------------------------------------

from verity.functions import json as js  # noqa: E402
from verity.operators import decide as dc  # noqa: E402

_Q_FIELDS = ["message_id", "trace_id", "question_id", "title", "content", "best_answer",
             "source", "created_at", "attempts"]


@register("encode_messages", with_views("v_questions") + "SELECT message_id AS key, CAST(to_json({"
          + ", ".join(f"'{f}': {f}" for f in _Q_FIELDS) + "}) AS VARCHAR) AS value FROM v_questions")
def q_encode_messages(spark: SparkSession, root: str) -> DataFrame:
    return js.encode(fx.v_questions(spark, root), "question")


_JSON_OK = """
j AS (SELECT key, value,
             CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS ok
      FROM v_json),
k AS (SELECT key, ok, CASE WHEN ok THEN value ELSE '{}' END AS jv FROM j)
"""


def _jstr(f: str, default: str | None) -> str:
    e = f"json_extract_string(jv, '$.{f}')"
    if default is not None:
        e = f"coalesce({e}, '{default}')"
    return f"CASE WHEN ok THEN {e} END AS {f}"


@register("decode_messages", with_views("v_json") + "," + _JSON_OK + "SELECT key, "
          + ", ".join([_jstr("message_id", None), _jstr("trace_id", None), _jstr("question_id", None),
                       _jstr("title", ""), _jstr("content", ""), _jstr("prompt", ""),
                       _jstr("best_answer", "")])
          + ", CASE WHEN ok THEN coalesce(CAST(json_extract(jv, '$.attempts') AS INTEGER), 0) END AS attempts"
          + " FROM k WHERE ok AND json_extract_string(jv, '$.question_id') IS NOT NULL")
def q_decode_messages(spark: SparkSession, root: str) -> DataFrame:
    # Decodable messages; malformed ones are routed by ``validate_requests``.
    d = js.decode(fx.v_json(spark, root), "regeneration")
    return d.filter(F.col("valid")).drop("valid", "reason")


@register("quarantine_messages", with_views("v_json") + "," + _JSON_OK + """
SELECT key, CASE WHEN ok THEN 'missing question_id' ELSE 'not a JSON object' END AS reason,
       (SELECT value FROM v_json v WHERE v.key = k.key) AS value
FROM k WHERE NOT ok OR json_extract_string(jv, '$.question_id') IS NULL""")
def q_quarantine_messages(spark: SparkSession, root: str) -> DataFrame:
    """The complement of ``decode_messages``: raw value and reason, none lost."""
    d = js.decode(fx.v_json(spark, root), "regeneration", keep=("key", "value"))
    return d.filter(~F.col("valid")).select("key", "reason", "value")


@register("validate_requests", with_views("v_json") + "," + _JSON_OK + """,
m AS (SELECT key, ok AND json_extract_string(jv, '$.question_id') IS NOT NULL AS good, jv FROM k)
SELECT key,
       CASE WHEN good THEN json_extract_string(jv, '$.question_id') END AS question_id,
       CASE WHEN good THEN coalesce(json_extract_string(jv, '$.best_answer'), '') END AS best_answer,
       CASE WHEN good THEN coalesce(json_extract_string(jv, '$.llm_answer'), '') END AS llm_answer,
       CASE WHEN good THEN 'ok' ELSE 'invalid_payload' END AS status
FROM m""")
def q_validate_requests(spark: SparkSession, root: str) -> DataFrame:
    return js.validate_score_requests(fx.v_json(spark, root))


# --- 2.9 W1 attempts, 2.2 P4 / P5, 2.7 A5 ----------------------------------------

_W1_CTES = f""",
a AS (SELECT *, score >= {sv.STREAM_THRESHOLD} AS nat FROM v_attempts),
b AS (SELECT *, coalesce(sum(CAST(nat AS INTEGER)) OVER (PARTITION BY message_id ORDER BY ts, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY message_id, seg ORDER BY ts, event_id) AS rn FROM b),
d AS (SELECT *, CAST((rn - 1) % {sv.MAX_ATTEMPTS} + 1 AS INTEGER) AS attempts_n FROM c),
decided AS (SELECT *, nat OR attempts_n >= {sv.MAX_ATTEMPTS} AS accepted,
                   (NOT nat) AND attempts_n >= {sv.MAX_ATTEMPTS} AS forced FROM d)
"""
W1_SQL = with_views("v_attempts") + _W1_CTES


def _decided(spark: SparkSession, root: str) -> DataFrame:
    return dc.attempt_decisions(fx.v_attempts(spark, root))


@register("attempt_decisions", W1_SQL + """
SELECT trace_id, message_id, round(score, 6) AS score, attempts_n AS attempts, accepted, forced FROM decided""")
def q_attempt_decisions(spark: SparkSession, root: str) -> DataFrame:
    d = _decided(spark, root)
    return d.select("trace_id", "message_id", F.round("score", 6).alias("score"), "attempts",
                    "accepted", "forced")


@register("attempt_decisions_nulls", with_views("v_attempts_nulls") + f""",
a AS (SELECT *, coalesce(score >= {sv.STREAM_THRESHOLD}, false) AS nat FROM v_attempts_nulls),
b AS (SELECT *, coalesce(sum(CAST(nat AS INTEGER)) OVER (PARTITION BY message_id ORDER BY ts NULLS FIRST, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seg FROM a),
c AS (SELECT *, row_number() OVER (PARTITION BY message_id, seg ORDER BY ts NULLS FIRST, event_id) AS rn FROM b)
SELECT trace_id, message_id, CAST((rn - 1) % 3 + 1 AS INTEGER) AS attempts, nat OR (rn - 1) % 3 + 1 >= 3 AS accepted,
       (NOT nat) AND (rn - 1) % 3 + 1 >= 3 AS forced FROM c""")
def q_attempt_decisions_nulls(spark: SparkSession, root: str) -> DataFrame:
    """NULL keys, times and scores: every row decided, a NULL score rejected."""
    d = dc.attempt_decisions(fx.v_attempts_nulls(spark, root))
    return d.select("trace_id", "message_id", "attempts", "accepted", "forced")


@register("regeneration_requests", W1_SQL + """
SELECT message_id, trace_id, question_id, title, content, prompt, best_answer, attempts_n AS attempts
FROM decided WHERE NOT accepted""")
def q_regeneration_requests(spark: SparkSession, root: str) -> DataFrame:
    return dc.regeneration_requests(_decided(spark, root))


@register("validated_projection", W1_SQL + f"""
SELECT message_id, trace_id, question_id, title, prompt AS content, llm_answer, best_answer,
       round(score, 6) AS score, accepted, '{sv.SCORER_SOURCE}' AS source, attempts_n AS attempts,
       produced_at AS decided_at
FROM decided WHERE accepted""")
def q_validated_projection(spark: SparkSession, root: str) -> DataFrame:
    v = dc.validated_projection(_decided(spark, root))
    return v.withColumn("score", F.round("score", 6))


@register("decision_counts", W1_SQL + """
SELECT CASE WHEN NOT accepted THEN 'regenerated' WHEN forced THEN 'forced' ELSE 'accepted' END AS decision,
       count(*) AS n
FROM decided GROUP BY 1""")
def q_decision_counts(spark: SparkSession, root: str) -> DataFrame:
    return dc.decision_counts(_decided(spark, root))


# --- 2.2 P6 / P7, 2.8 U1, 2.5 P8 / G5, 2.9 W5 -------------------------------------

@register("llm_request_union", with_views("v_questions", "v_prompted", "v_attempts") + _W1_CTES + """
SELECT message_id, trace_id, question_id, title, content, prompt, best_answer,
       attempts + 1 AS attempts, 'question' AS origin FROM v_prompted
UNION ALL
SELECT message_id, trace_id, question_id, title, content, prompt, best_answer,
       attempts_n + 1 AS attempts, 'regeneration' AS origin FROM decided WHERE NOT accepted""")
def q_llm_request_union(spark: SparkSession, root: str) -> DataFrame:
    regen = dc.regeneration_requests(_decided(spark, root))
    return dc.request_union(fx.v_questions(spark, root), regen)


@register("answer_requests", with_views("v_answers") + """
SELECT message_id, trace_id, question_id, title, content, prompt, llm_answer, best_answer,
       0.0 AS latency_ms, attempts + 1 AS attempts FROM v_answers""")
def q_answer_requests(spark: SparkSession, root: str) -> DataFrame:
    responses, _errors = dc.answer_requests(dc.first_requests(fx.v_questions(spark, root)))
    return responses


_LOOP_SQL = with_views("v_answers") + _score_ctes("v_answers") + f""",
loop AS (
  SELECT message_id, trace_id, question_id, title, prompt AS content, llm_answer, best_answer, raw AS score,
         true AS accepted, '{sv.SCORER_SOURCE}' AS source,
         CASE WHEN raw >= {sv.STREAM_THRESHOLD} THEN 1 ELSE {sv.MAX_ATTEMPTS} END AS attempts,
         created_at AS decided_at, raw < {sv.STREAM_THRESHOLD} AS forced FROM r)
"""


def _looped(spark: SparkSession, root: str) -> DataFrame:
    return dc.regeneration_loop(fx.v_questions(spark, root), decided_at=F.col("created_at"))


@register("regeneration_loop", _LOOP_SQL + """
SELECT * EXCLUDE (score), round(score, 6) AS score, attempts AS request_attempts FROM loop""")
def q_regeneration_loop(spark: SparkSession, root: str) -> DataFrame:
    return _looped(spark, root).withColumn("score", F.round("score", 6))


@register("loop_to_results", _LOOP_SQL + """
SELECT question_id AS id_pregunta, title AS pregunta, content AS contenido, best_answer AS respuesta_dataset,
       llm_answer AS respuesta_llm, round(score, 6) AS score, accepted AS aceptado,
       decided_at AS ultima_actualizacion, CAST(1 AS BIGINT) AS contador_consultas, decided_at AS creado_en FROM loop""")
def q_loop_to_results(spark: SparkSession, root: str) -> DataFrame:
    """The loop's records, upserted into the results."""
    from verity.operators import store as results

    return results.results_upsert(_looped(spark, root)).withColumn("score", F.round("score", 6))


@register("generate_with_fallback", with_views("v_answers") + f""",
fb AS ({_FALLBACK_BODY})
SELECT a.message_id, a.question_id, a.attempts + 1 AS attempts,
       CASE WHEN ends_with(a.title, '/src0') THEN fb.answer ELSE a.llm_answer END AS llm_answer,
       CASE WHEN ends_with(a.title, '/src0') THEN 'timeout' END AS error_detail
FROM v_answers a JOIN fb USING (message_id)""")
def q_generate_with_fallback(spark: SparkSession, root: str) -> DataFrame:
    """Answer, else fallback text naming the failure; failures are reported too."""
    r, e = dc.generate_with_fallback(dc.first_requests(fx.v_questions(spark, root)), error=_fallback_error_col())
    return r.join(e.select("message_id", "error_detail"), "message_id", "left") \
        .select("message_id", "question_id", "attempts", "llm_answer", "error_detail")


# --- 2.3 joins, 2.9 W2 / W3, 2.7 A6, 2.8 U2 ----------------------------------------

from verity.operators import reuse as ru  # noqa: E402

_TTL = ru.CACHE_TTL_SECONDS
_USABLE = "coalesce(length(respuesta_llm), 0) > 0"


def _trace(spark: SparkSession, root: str) -> DataFrame:
    return fx.v_trace(spark, root)


@register("reuse_lookup", with_views("v_trace", "v_store") + f"""
SELECT t.message_id, t.trace_id, t.question_id, coalesce(s.pregunta, '') AS title,
       coalesce(s.contenido, '') AS content, coalesce(s.respuesta_llm, '') AS llm_answer,
       coalesce(s.respuesta_dataset, '') AS best_answer, coalesce(s.score, 0.0) AS score,
       coalesce(s.aceptado, false) AS accepted, 'storage' AS source, t.attempts, t.created_at AS decided_at
FROM v_trace t JOIN v_store s ON s.id_pregunta = t.question_id WHERE {_USABLE}""")
def q_reuse_lookup(spark: SparkSession, root: str) -> DataFrame:
    return ru.reuse_lookup(_trace(spark, root), fx.v_store(spark, root))


@register("reuse_misses", with_views("v_trace", "v_store") + f"""
SELECT message_id, question_id, created_at FROM v_trace t
WHERE NOT EXISTS (SELECT 1 FROM v_store s WHERE s.id_pregunta = t.question_id AND {_USABLE})""")
def q_reuse_misses(spark: SparkSession, root: str) -> DataFrame:
    return ru.reuse_misses(_trace(spark, root), fx.v_store(spark, root)) \
        .select("message_id", "question_id", "created_at")


def _ttl_ctes(source: str) -> str:
    """Refresh chain per key by recursion over next pointers (oracle form)."""
    return f""",
nx AS (SELECT a.id, (SELECT first(b.id ORDER BY b.ts, b.event_id) FROM {source} b
                     WHERE b.k = a.k AND b.ts > a.ts + INTERVAL '{sv.TTL_SECONDS} seconds') AS nxt
       FROM {source} a),
anchors(id) AS (
  SELECT first(id ORDER BY ts, event_id) FROM {source} GROUP BY k
  UNION ALL
  SELECT nx.nxt FROM anchors JOIN nx ON nx.id = anchors.id WHERE nx.nxt IS NOT NULL)
"""


_T = ",\nt AS (SELECT message_id AS id, question_id AS k, ts, event_id FROM v_trace)"
_ST = f",\nst AS (SELECT DISTINCT id_pregunta FROM v_store WHERE {_USABLE}),\n" \
      "ts2 AS (SELECT t.* FROM t JOIN st ON st.id_pregunta = t.k)"
ROUTE_SQL = with_views("v_trace", "v_store", recursive=True) + _T + _ST + _ttl_ctes("ts2") + """,
routed AS (
  SELECT t.id AS message_id, t.k AS question_id,
         CASE WHEN st.id_pregunta IS NULL THEN 'llm' WHEN an.id IS NOT NULL THEN 'storage' ELSE 'cache' END AS route
  FROM t LEFT JOIN st ON st.id_pregunta = t.k LEFT JOIN anchors an ON an.id = t.id)
"""


@register("reuse_ttl_hits", with_views("v_trace", recursive=True) + _T + _ttl_ctes("t") + """
SELECT t.id AS message_id, t.k AS question_id, an.id IS NULL AS hit
FROM t LEFT JOIN anchors an ON an.id = t.id""")
def q_reuse_ttl_hits(spark: SparkSession, root: str) -> DataFrame:
    return ru.ttl_hits(_trace(spark, root), _TTL).select("message_id", "question_id", "hit")


def _routed(spark: SparkSession, root: str) -> DataFrame:
    return ru.route_requests(_trace(spark, root), fx.v_store(spark, root), _TTL)


@register("route_questions", ROUTE_SQL + "SELECT * FROM routed")
def q_route_questions(spark: SparkSession, root: str) -> DataFrame:
    return _routed(spark, root).select("message_id", "question_id", "route")


@register("reuse_hit_rate", ROUTE_SQL + """
SELECT count(*) FILTER (WHERE route = 'cache') AS cache_hits,
       count(*) FILTER (WHERE route = 'storage') AS storage_hits,
       count(*) FILTER (WHERE route = 'llm') AS misses,
       round(avg(CASE WHEN route <> 'llm' THEN 1.0 ELSE 0.0 END), 6) AS hit_rate
FROM routed""")
def q_reuse_hit_rate(spark: SparkSession, root: str) -> DataFrame:
    return ru.hit_rate(_routed(spark, root)).withColumn("hit_rate", F.round("hit_rate", 6))


@register("reuse_distance", with_views("v_trace") + f""",
p AS (SELECT message_id, question_id, row_number() OVER (ORDER BY ts, event_id) AS pos FROM v_trace),
q AS (SELECT *, lag(pos) OVER (PARTITION BY question_id ORDER BY pos) AS prv,
                lead(pos) OVER (PARTITION BY question_id ORDER BY pos) AS nxt FROM p),
c AS (SELECT a.message_id, count(*) AS n FROM q a JOIN q b
        ON b.pos > a.prv AND b.pos < a.pos AND coalesce(b.nxt, 9223372036854775807) > a.pos
      GROUP BY a.message_id)
SELECT q.message_id, q.question_id,
       CAST(CASE WHEN q.prv IS NULL THEN -1 ELSE coalesce(c.n, 0) END AS BIGINT) AS reuse_distance,
       (q.prv IS NOT NULL AND coalesce(c.n, 0) < {sv.CACHE_SIZE}) AS lru_hit
FROM q LEFT JOIN c USING (message_id)""")
def q_reuse_distance(spark: SparkSession, root: str) -> DataFrame:
    d = ru.reuse_distance(_trace(spark, root))
    return d.select("message_id", "question_id", "reuse_distance", ru.lru_hits(d).alias("lru_hit"))


@register("validated_union", with_views("v_trace", "v_store", "v_attempts", recursive=True) + _T + _ST
          + _ttl_ctes("ts2") + _W1_CTES + f""",
routed AS (
  SELECT t.id AS message_id, CASE WHEN an.id IS NOT NULL THEN 'storage' ELSE 'cache' END AS route
  FROM t JOIN st ON st.id_pregunta = t.k LEFT JOIN anchors an ON an.id = t.id)
SELECT v.message_id, v.trace_id, v.question_id, coalesce(s.pregunta, '') AS title,
       coalesce(s.contenido, '') AS content, coalesce(s.respuesta_llm, '') AS llm_answer,
       coalesce(s.respuesta_dataset, '') AS best_answer, round(coalesce(s.score, 0.0), 6) AS score,
       coalesce(s.aceptado, false) AS accepted, r.route AS source, v.attempts, v.created_at AS decided_at
FROM v_trace v JOIN routed r ON r.message_id = v.message_id JOIN v_store s ON s.id_pregunta = v.question_id
UNION ALL
SELECT message_id, trace_id, question_id, title, prompt AS content, llm_answer, best_answer,
       round(score, 6) AS score, accepted, '{sv.SCORER_SOURCE}' AS source, attempts_n AS attempts,
       produced_at AS decided_at
FROM decided WHERE accepted""")
def q_validated_union(spark: SparkSession, root: str) -> DataFrame:
    routed = _routed(spark, root).filter(F.col("route") != ru.ROUTE_LLM)
    store = ru.first_stored(ru.usable_answers(fx.v_store(spark, root))).withColumnRenamed("id_pregunta", "question_id")
    hits = ru.hit_projection(routed.join(store, "question_id"), source=F.col("route"))
    accepted = dc.validated_projection(_decided(spark, root))
    return hits.unionByName(accepted).withColumn("score", F.round("score", 6))


# --- 2.7 A1-A4 upserts and metrics ------------------------------------------------

from verity.operators import analytics as an  # noqa: E402
from verity.operators import retry  # noqa: E402
from verity.operators import store as st  # noqa: E402

MERGE_SPLIT = "2024-01-16 00:00:00"

def _upsert_sql(view: str) -> str:
    return f""",
o AS (SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY decided_ts DESC, message_id DESC) AS rl,
             row_number() OVER (PARTITION BY question_id ORDER BY decided_ts, message_id) AS rf,
             count(*) OVER (PARTITION BY question_id) AS cnt FROM {view}),
l AS (SELECT * FROM o WHERE rl = 1),
f AS (SELECT question_id, decided_at AS creado_en FROM o WHERE rf = 1)
SELECT l.question_id AS id_pregunta, l.title AS pregunta, l.content AS contenido,
       l.best_answer AS respuesta_dataset, l.llm_answer AS respuesta_llm, l.score, l.accepted AS aceptado,
       l.decided_at AS ultima_actualizacion, l.cnt AS contador_consultas, f.creado_en
FROM l JOIN f ON l.question_id IS NOT DISTINCT FROM f.question_id"""


_UPSERT_SQL = with_views("v_validated") + _upsert_sql("v_validated")


@register("results_upsert", _UPSERT_SQL)
def q_results_upsert(spark: SparkSession, root: str) -> DataFrame:
    return st.results_upsert(fx.v_validated(spark, root))


@register("results_merge", _UPSERT_SQL)
def q_results_merge(spark: SparkSession, root: str) -> DataFrame:
    """Prior table = upsert of records before the split; merge the rest onto it.
    The oracle is the single-pass upsert of everything (merge law)."""
    v = fx.v_validated(spark, root)
    split = F.lit(MERGE_SPLIT).cast("timestamp")
    prior = st.results_state(v.filter(F.col("decided_ts") < split))
    return st.results_merge(prior, v.filter(F.col("decided_ts") >= split)).select(*st.RESULT_COLUMNS)


@register("results_merge_ties", with_views("v_odd_validated") + _upsert_sql("v_odd_validated"))
def q_results_merge_ties(spark: SparkSession, root: str) -> DataFrame:
    """The merge law with ties across the split, both time forms and NULL ids, the
    later half first."""
    v = fx.v_odd_validated(spark, root)
    half = F.pmod(F.xxhash64("message_id"), F.lit(2)) == 0
    merged = st.results_merge(st.results_state(v.filter(half)), v.filter(~half))
    return merged.select(*st.RESULT_COLUMNS)


_METRICS_SQL = """
SELECT 'global' AS _id, count(*) AS procesadas, count(*) FILTER (WHERE accepted) AS aceptadas,
       count(*) FILTER (WHERE NOT accepted) AS rechazadas, round(sum(score), 6) AS score_acum,
       first(score ORDER BY decided_ts DESC, message_id DESC) AS ultimo_score,
       first(decided_at ORDER BY decided_ts DESC, message_id DESC) AS actualizado_en,
       first(decided_at ORDER BY decided_ts, message_id) AS creado_en
FROM v_odd_validated"""


@register("metrics_merge", with_views("v_odd_validated") + _METRICS_SQL)
def q_metrics_merge(spark: SparkSession, root: str) -> DataFrame:
    v = fx.v_odd_validated(spark, root)
    half = F.pmod(F.xxhash64("message_id"), F.lit(2)) == 0
    m = st.merge_metrics(st.metrics_partial(v.filter(half)), st.metrics_partial(v.filter(~half)))
    return m.select(*st.METRIC_COLUMNS).withColumn("score_acum", F.round("score_acum", 6))


@register("global_metrics", with_views("v_validated") + """
SELECT 'global' AS _id, count(*) AS procesadas, count(*) FILTER (WHERE accepted) AS aceptadas,
       count(*) FILTER (WHERE NOT accepted) AS rechazadas, round(sum(score), 6) AS score_acum,
       first(score ORDER BY decided_ts DESC, message_id DESC) AS ultimo_score,
       first(decided_at ORDER BY decided_ts DESC, message_id DESC) AS actualizado_en,
       first(decided_at ORDER BY decided_ts, message_id) AS creado_en,
       round(sum(score) / count(*), 6) AS score_medio
FROM v_validated""")
def q_global_metrics(spark: SparkSession, root: str) -> DataFrame:
    m = st.global_metrics(fx.v_validated(spark, root))
    return m.withColumn("score_acum", F.round("score_acum", 6)).withColumn("score_medio", F.round("score_medio", 6))


# --- 2.7 A7-A11, 2.3 J4, 2.6 E1, 2.8 L3, 2.10 labels ----------------------------------------

@register("status_counts", with_views("v_log") + "SELECT status, count(*) AS n FROM v_log GROUP BY status")
def q_status_counts(spark: SparkSession, root: str) -> DataFrame:
    return an.status_counts(fx.v_log(spark, root))


_SWEEP_VALUES = ", ".join(f"(CAST({t} AS DOUBLE))" for t in sv.SWEEP_THRESHOLDS)


@register("threshold_sweep", with_views("v_answers") + _score_ctes("v_answers") + f""",
th AS (SELECT * FROM (VALUES {_SWEEP_VALUES}) AS v(threshold)),
tot AS (SELECT count(*) AS n FROM r)
SELECT th.threshold, count(*) FILTER (WHERE raw >= th.threshold) AS accepted,
       count(*) FILTER (WHERE raw < th.threshold) AS regenerated,
       round(count(*) FILTER (WHERE raw < th.threshold) / any_value(tot.n), 6) AS regeneration_rate,
       round(avg(raw) FILTER (WHERE raw >= th.threshold), 6) AS accepted_mean_score
FROM th, r, tot GROUP BY th.threshold""")
def q_threshold_sweep(spark: SparkSession, root: str) -> DataFrame:
    a = fx.v_answers(spark, root).select("message_id", "best_answer", "llm_answer")
    scored = sc._scored(a, "message_id", "best_answer", "llm_answer")
    sweep = an.threshold_sweep(scored, "_raw")
    return sweep.withColumn("regeneration_rate", F.round("regeneration_rate", 6)) \
        .withColumn("accepted_mean_score", F.round("accepted_mean_score", 6))


def _latency(spark: SparkSession, root: str) -> DataFrame:
    o = table(spark, root, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("created_ts"))
    li = table(spark, root, "lineitem").select(
        F.col("l_orderkey").alias("k"), "l_linenumber", F.col("l_shipdate").alias("decided_ts"))
    li = li.withColumn("message_id", F.concat(F.col("k").cast("string"), F.lit("-"),
                                              F.col("l_linenumber").cast("string")))
    lat = an.message_latency(o, li, key="k", keep=("message_id",))
    return lat.select("message_id", "latency_ms")


_LAT_SQL = with_views("v_correlated") + """,
lat AS (SELECT message_id, CAST(trunc((epoch_us(decided_ts) - epoch_us(created_ts)) / 1000) AS BIGINT) AS latency_ms FROM v_correlated)
"""


@register("message_latency", _LAT_SQL + "SELECT * FROM lat")
def q_message_latency(spark: SparkSession, root: str) -> DataFrame:
    return _latency(spark, root)


@register("latency_summary", _LAT_SQL + """
SELECT count(latency_ms) AS n, round(avg(latency_ms), 6) AS mean_ms, CAST(max(latency_ms) AS DOUBLE) AS max_ms,
       round(quantile_cont(latency_ms, 0.5), 6) AS p50_ms, round(quantile_cont(latency_ms, 0.95), 6) AS p95_ms
FROM lat""")
def q_latency_summary(spark: SparkSession, root: str) -> DataFrame:
    s = an.latency_summary(_latency(spark, root))
    return s.select("n", "max_ms", *[F.round(c, 6).alias(c) for c in ("mean_ms", "p50_ms", "p95_ms")])


@register("latency_sketches", with_views("v_log") + """
SELECT strftime(time_bucket(INTERVAL '1 day', "timestamp"), '%Y-%m-%d %H:%M:%S') AS window_start, count(latency) AS n,
       min(latency) AS lo, max(latency) AS hi, true AS p50_within, true AS p95_within
FROM v_log WHERE latency IS NOT NULL GROUP BY 1""")
def q_latency_sketches(spark: SparkSession, root: str) -> DataFrame:
    """Sketches per hour merged to days; whether the exact rank of each quantile is within the stated error."""
    log = fx.v_log(spark, root).select("timestamp", F.col("latency").cast("double").alias("latency"))
    day = an.sketch_quantiles(an.merge_sketches(an.sketch_windows(log, "latency", "timestamp", "1 hour"), "1 day"), (0.5, 0.95))
    rows = log.select(F.date_format(F.window("timestamp", "1 day").start, "yyyy-MM-dd HH:mm:ss").alias("window_start"), "latency")
    below = [f(F.when(c, 1).otherwise(0)).alias(name) for f, c, name in (
        (F.sum, F.col("latency") < F.col("q0"), "b0"), (F.sum, F.col("latency") <= F.col("q0"), "t0"),
        (F.sum, F.col("latency") < F.col("q1"), "b1"), (F.sum, F.col("latency") <= F.col("q1"), "t1"))]
    ranked = rows.filter("latency IS NOT NULL").join(day, "window_start").groupBy("window_start", "n", "lo", "hi").agg(*below)

    def within(i: int, p: float):
        slack = F.lit(an.SKETCH_ERROR) * F.col("n") + 1
        return (F.col(f"b{i}") <= F.lit(p) * F.col("n") + slack) & (F.col(f"t{i}") >= F.lit(p) * F.col("n") - slack)

    return ranked.select("window_start", "n", "lo", "hi", within(0, 0.5).alias("p50_within"), within(1, 0.95).alias("p95_within"))


@register("throughput_windows", with_views("v_log") + """
SELECT strftime(time_bucket(INTERVAL '1 hour', "timestamp"), '%Y-%m-%d %H:%M:%S') AS window_start,
       strftime(time_bucket(INTERVAL '1 hour', "timestamp") + INTERVAL '1 hour', '%Y-%m-%d %H:%M:%S') AS window_end,
       count(*) AS n
FROM v_log GROUP BY 1, 2""")
def q_throughput_windows(spark: SparkSession, root: str) -> DataFrame:
    return an.throughput_windows(fx.v_log(spark, root))


@register("interarrival_stats", with_views("v_log") + """,
g AS (SELECT question_id, (epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (
          PARTITION BY question_id ORDER BY "timestamp", event_id)) / 1e6 AS gap FROM v_log)
SELECT question_id, count(*) AS n, round(avg(gap), 3) AS mean_gap_s, round(1 / avg(gap), 9) AS rate_per_s
FROM g GROUP BY question_id""")
def q_interarrival_stats(spark: SparkSession, root: str) -> DataFrame:
    s = an.interarrival_stats(fx.v_log(spark, root))
    # A mean of microsecond stamps may end in a half microsecond, where six
    # decimals would depend on the order of the sum: compared to three.
    return s.withColumn("mean_gap_s", F.round("mean_gap_s", 3)).withColumn("rate_per_s", F.round("rate_per_s", 9))


@register("interarrival_gaps", with_views("v_log") + """
SELECT message_id, question_id,
       round((epoch_us("timestamp") - lag(epoch_us("timestamp")) OVER (
           PARTITION BY question_id ORDER BY "timestamp", event_id)) / 1e6, 6) AS gap_s
FROM v_log""")
def q_interarrival_gaps(spark: SparkSession, root: str) -> DataFrame:
    g = an.interarrival_gaps(fx.v_log(spark, root), tiebreak="event_id")
    return g.select("message_id", "question_id", F.round("gap_s", 6).alias("gap_s"))


@register("error_backoff", with_views("v_errors") + """,
d AS (SELECT *, 1.0 * pow(2, attempts - 1) AS delay_s FROM v_errors)
SELECT message_id, question_id, error_type, error_detail, attempts, delay_s,
       strftime(make_timestamp(((epoch_us(ts) + CAST(delay_s * 1000000 AS BIGINT)) // 1000000) * 1000000),
                '%Y-%m-%dT%H:%M:%SZ') AS retry_at
FROM d""")
def q_error_backoff(spark: SparkSession, root: str) -> DataFrame:
    e = an.error_backoff(fx.v_errors(spark, root), jitter=0.0)
    return e.select("message_id", "question_id", "error_type", "error_detail", "attempts", "delay_s", "retry_at")


@register("retry_states", with_views("v_errors", "v_questions") + """,
e AS (SELECT question_id AS message_id, max(attempts) AS n FROM v_errors GROUP BY question_id),
l AS (SELECT e.message_id, e.n, make_timestamp(((epoch_us(v.ts) + CAST(pow(2, e.n - 1) * 1000000 AS BIGINT)) // 1000000) * 1000000) AS due
      FROM e JOIN v_errors v ON v.question_id = e.message_id AND v.attempts = e.n),
t AS (SELECT max(ts) AS at FROM v_errors)
SELECT l.message_id,
       CASE WHEN l.n >= 12 THEN 'exhausted' WHEN q.question_id IS NULL THEN 'no request'
            WHEN l.due <= t.at - INTERVAL 1 DAY THEN 'due' ELSE 'waiting' END AS state,
       l.n AS failed_attempts, l.n + 1 AS attempts, strftime(l.due, '%Y-%m-%dT%H:%M:%SZ') AS retry_at, q.title
FROM l CROSS JOIN t LEFT JOIN (SELECT DISTINCT question_id, title FROM v_questions) q ON q.question_id = l.message_id""")
def q_retry_states(spark: SparkSession, root: str) -> DataFrame:
    """Failed messages a day before the last error: due, waiting, exhausted after twelve attempts, or unknown."""
    e = an.error_backoff(fx.v_errors(spark, root), jitter=0.0).withColumn("message_id", F.col("question_id"))
    asked = fx.v_questions(spark, root).select(F.col("question_id").alias("message_id"), "title", F.lit(1).alias("attempts"))
    last = e.agg(F.max(F.unix_micros("ts")).alias("us")).first()["us"] or 0
    at = F.timestamp_micros(F.lit(last)) - F.expr("INTERVAL 1 DAY")
    states = retry.retry_states(e, asked, at, max_attempts=12)
    return states.select("message_id", "state", "failed_attempts", "attempts", "retry_at", "title")


@register("sample_questions", with_views("v_questions") + """,
p AS (SELECT message_id, question_id, row_number() OVER (ORDER BY question_id) AS pos FROM v_questions),
t AS (SELECT count(*) AS n FROM p),
d AS (SELECT n, unnest(range(n)) AS draw FROM t),
h AS (SELECT draw, CAST('0x' || substr(md5('42:' || CAST(draw AS VARCHAR)), 1, 15) AS BIGINT) % n + 1 AS pos FROM d)
SELECT h.draw, p.message_id, p.question_id FROM h JOIN p USING (pos)""")
def q_sample_questions(spark: SparkSession, root: str) -> DataFrame:
    """As many draws as there are questions."""
    q = fx.v_questions(spark, root).select("message_id", "question_id")
    return an.sample_questions(q, q.count(), seed=42)


def _sanitize_sql(x: str) -> str:
    return f"replace(replace(replace({x}, ' ', '-'), '/', '-'), '.', '_')"


@register("sanitize_labels", with_views("v_log") + f""",
g AS (SELECT status, count(*) AS n, min(latency) AS lo, max(latency) AS hi,
             count(*) / ((epoch_us(max("timestamp")) - epoch_us(min("timestamp"))) / 1e6) AS rate
      FROM v_log GROUP BY status)
SELECT status,
       'traffic_poisson_n' || CAST(n AS VARCHAR) || '_lambda'
         || {_sanitize_sql('CAST(CAST(rate AS DECIMAL(18, 4)) AS VARCHAR)')} AS poisson_label,
       'traffic_uniform_n' || CAST(n AS VARCHAR)
         || '_low' || {_sanitize_sql('CAST(CAST(lo AS DECIMAL(18, 2)) AS VARCHAR)')}
         || '_high' || {_sanitize_sql('CAST(CAST(hi AS DECIMAL(18, 2)) AS VARCHAR)')} AS uniform_label
FROM g""")
def q_sanitize_labels(spark: SparkSession, root: str) -> DataFrame:
    log = fx.v_log(spark, root)
    us = F.unix_micros(F.col("timestamp"))
    g = log.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.min("latency").alias("lo"),
                                  F.max("latency").alias("hi"),
                                  (F.count(F.lit(1)) / ((F.max(us) - F.min(us)) / 1e6)).alias("rate"))
    dec = lambda c, s: F.col(c).cast(f"decimal(18,{s})").cast("string")
    return g.select(
        "status",
        an.run_label(F.lit("poisson"), F.col("n"), [("lambda", dec("rate", 4))]).alias("poisson_label"),
        an.run_label(F.lit("uniform"), F.col("n"), [("low", dec("lo", 2)), ("high", dec("hi", 2))])
        .alias("uniform_label"))

"""The fixture views written as SQL (DuckDB dialect) for the oracle queries.

These mirror ``verity.sources.fixtures`` line by line but are written
independently in SQL, so an oracle checks the DataFrame implementation
rather than re-running it.
"""

from __future__ import annotations

# Fixed values of the results, stated here once more: an oracle that took them
# from the library would agree with whatever the library has.
WS = (r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
      r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")
OFFLINE_PREFIX = "Respuesta generada automáticamente en modo offline. Resumen de la pregunta: "
INSTRUCTION_INTRO = ("Eres un asistente experto que responde preguntas provenientes de Yahoo! Answers. "
                     "Redacta una respuesta clara y completa, justificando los pasos si corresponde. Pregunta: ")
INSTRUCTION_EMPTY_TITLE, INSTRUCTION_EMPTY_CONTENT = "(Sin título)", "(Sin descripción adicional)"
FALLBACK_EMPTY_TITLE = "Consulta de Yahoo! Answers"
FALLBACK_EMPTY_CONTENT = "No se proporcionaron detalles adicionales."
FALLBACK_NOTE = "Esta respuesta fue generada localmente porque el servicio de Gemini no respondió a tiempo."
FALLBACK_GUIDANCE = ("Para obtener una respuesta definitiva, compara esta recomendación con la mejor respuesta humana "
                     "del dataset y consulta fuentes confiables adicionales.")
QUESTION_SOURCE, QUESTION_CREATED_AT = "traffic-generator", "2024-01-01T00:00:00.000000Z"
STREAM_THRESHOLD, SERVICE_THRESHOLD, MAX_ATTEMPTS, SCORER_SOURCE = 0.65, 0.5, 3, "scorer"
TTL_SECONDS, CACHE_SIZE = 3600, 1024
SWEEP_THRESHOLDS = (0.3, 0.4, 0.5, 0.6, 0.65, 0.7, 0.8, 0.9)

ISO = "%Y-%m-%dT%H:%M:%S.%fZ"

VIEWS: dict[str, str] = {}

VIEWS["v_questions"] = f"""
SELECT 'm' || CAST(doc_id AS VARCHAR) AS message_id,
       't' || CAST(doc_id AS VARCHAR) AS trace_id,
       CAST(doc_id AS VARCHAR) AS question_id,
       lang || '/' || source AS title,
       text AS content,
       text AS best_answer,
       '{QUESTION_SOURCE}' AS source,
       '{QUESTION_CREATED_AT}' AS created_at,
       CAST(0 AS INTEGER) AS attempts
FROM documents"""

VIEWS["v_prompted"] = """
SELECT *, concat_ws(chr(10) || chr(10), nullif(title, ''), nullif(content, '')) AS prompt
FROM v_questions"""

VIEWS["v_answers"] = f"""
SELECT *, '{OFFLINE_PREFIX}' ||
       array_to_string(list_slice(string_split_regex(
           regexp_replace(prompt, '^{WS}+|{WS}+$', '', 'g'), '{WS}+'), 1, 60), ' ') || '.' AS llm_answer
FROM v_prompted"""

VIEWS["v_pairs"] = """
SELECT CAST(u.conv_id AS VARCHAR) || '-' || CAST(u.turn AS VARCHAR) AS message_id,
       CAST(u.conv_id AS VARCHAR) AS question_id,
       u.text AS best_answer,
       a.text AS llm_answer
FROM conversations u JOIN conversations a
  ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
WHERE u.role = 'user' AND a.role = 'assistant'"""

VIEWS["v_attempts"] = f"""
SELECT CAST(user_id AS VARCHAR) AS message_id,
       't' || CAST(event_id AS VARCHAR) AS trace_id,
       CAST(user_id AS VARCHAR) AS question_id,
       event_type AS title,
       props AS content,
       event_type || chr(10) || chr(10) || props AS prompt,
       props AS llm_answer,
       event_type AS best_answer,
       value AS latency_ms,
       CAST(1 AS INTEGER) AS attempts,
       strftime(ts, '{ISO}') AS produced_at,
       ts, event_id,
       least(1.0, greatest(0.0, value / 100)) AS score
FROM events"""

VIEWS["v_trace"] = f"""
SELECT CAST(event_id AS VARCHAR) AS message_id,
       't' || CAST(event_id AS VARCHAR) AS trace_id,
       CAST(user_id AS VARCHAR) AS question_id,
       event_type AS title,
       props AS content,
       event_type AS best_answer,
       '{QUESTION_SOURCE}' AS source,
       strftime(ts, '{ISO}') AS created_at,
       CAST(0 AS INTEGER) AS attempts,
       ts, event_id
FROM events"""

VIEWS["v_store"] = """
SELECT CAST(d.doc_id AS VARCHAR) AS id_pregunta,
       d.lang || '/' || d.source AS pregunta,
       d.text AS contenido,
       d.text AS respuesta_dataset,
       CASE WHEN l.quality = 1 THEN d.text WHEN l.quality = 0 THEN '' END AS respuesta_llm,
       CAST(l.quality AS DOUBLE) AS score,
       (l.quality = 1 AND l.toxic = 0) AS aceptado
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id"""

VIEWS["v_validated"] = f"""
SELECT CAST(event_id AS VARCHAR) AS message_id,
       't' || CAST(event_id AS VARCHAR) AS trace_id,
       CAST(user_id AS VARCHAR) AS question_id,
       event_type AS title,
       props AS content,
       props AS llm_answer,
       event_type AS best_answer,
       least(1.0, greatest(0.0, value / 100)) AS score,
       event_type IN ('purchase', 'signup') AS accepted,
       event_type AS source,
       CAST(1 AS INTEGER) AS attempts,
       strftime(ts, '{ISO}') AS decided_at,
       ts AS decided_ts
FROM events"""

VIEWS["v_log"] = """
SELECT ts AS "timestamp", 'PUBLISH' AS operation,
       CAST(event_id AS VARCHAR) AS message_id,
       CAST(user_id AS VARCHAR) AS question_id,
       event_type AS status, value AS latency, 'questions_in' AS topic, event_id
FROM events"""

VIEWS["v_errors"] = """
SELECT event_id, ts, user_id,
       CAST(event_id AS VARCHAR) AS message_id,
       't' || CAST(event_id AS VARCHAR) AS trace_id,
       CAST(user_id AS VARCHAR) AS question_id,
       'RuntimeError' AS error_type,
       props AS error_detail,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS INTEGER) AS attempts
FROM events WHERE event_type = 'error'"""

VIEWS["v_correlated"] = """
SELECT CAST(o.o_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS message_id,
       o.o_orderdate AS created_ts, l.l_shipdate AS decided_ts
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

VIEWS["v_json"] = """
SELECT CAST(event_id AS VARCHAR) AS key,
       CASE WHEN event_id % 50 = 0 THEN '{bad'
            WHEN event_id % 50 = 1 THEN CAST(to_json({'message_id': CAST(event_id AS VARCHAR),
                 'trace_id': 't' || CAST(event_id AS VARCHAR), 'title': event_type,
                 'best_answer': event_type, 'llm_answer': props,
                 'attempts': CAST(floor(value / 100) AS INTEGER)}) AS VARCHAR)
            ELSE CAST(to_json({'message_id': CAST(event_id AS VARCHAR),
                 'trace_id': 't' || CAST(event_id AS VARCHAR),
                 'question_id': CAST(user_id AS VARCHAR), 'title': event_type,
                 'best_answer': event_type, 'llm_answer': props,
                 'attempts': CAST(floor(value / 100) AS INTEGER)}) AS VARCHAR) END AS value
FROM events"""

VIEWS["v_attempts_nulls"] = """
SELECT trace_id, event_id,
       CASE WHEN event_id % 11 <> 3 THEN message_id END AS message_id,
       CASE WHEN event_id % 13 <> 4 THEN ts END AS ts,
       CASE WHEN event_id % 7 <> 2 THEN score END AS score
FROM v_attempts"""

VIEWS["v_odd_validated"] = f"""
SELECT * REPLACE (
         CASE WHEN CAST(message_id AS BIGINT) % 17 <> 5 THEN question_id END AS question_id,
         CASE WHEN CAST(message_id AS BIGINT) % 2 = 0
              THEN strftime(time_bucket(INTERVAL '10 minutes', decided_ts), '{ISO}')
              ELSE strftime(time_bucket(INTERVAL '10 minutes', decided_ts), '%Y-%m-%dT%H:%M:%SZ') END AS decided_at,
         time_bucket(INTERVAL '10 minutes', decided_ts) AS decided_ts)
FROM v_validated"""

VIEWS["v_attempt_pairs"] = """
SELECT question_id AS message_id, message_id AS turn_id, best_answer, llm_answer FROM v_pairs"""

# Views used by other views.
DEPENDS = {
    "v_prompted": ["v_questions"],
    "v_answers": ["v_questions", "v_prompted"],
    "v_attempts_nulls": ["v_attempts"],
    "v_odd_validated": ["v_validated"],
    "v_attempt_pairs": ["v_pairs"],
}


def with_views(*names: str, recursive: bool = False) -> str:
    """A ``WITH`` clause defining the named views (and what they build on)."""
    ordered: list[str] = []
    for n in names:
        for dep in DEPENDS.get(n, []) + [n]:
            if dep not in ordered:
                ordered.append(dep)
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in ordered) + "\n"

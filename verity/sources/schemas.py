"""Message schemas and their field defaults.

Six record kinds travel between pipeline stages.  Each is a flat StructType;
defaults apply when a field is absent from a decoded message.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, D, B = T.StringType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


QUESTION = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("title", S), ("content", S),
    ("best_answer", S), ("source", S), ("created_at", S), ("attempts", I),
)
LLM_REQUEST = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("title", S), ("content", S),
    ("prompt", S), ("best_answer", S), ("attempts", I), ("created_at", S),
)
LLM_RESPONSE = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("title", S), ("content", S),
    ("prompt", S), ("llm_answer", S), ("best_answer", S), ("latency_ms", D), ("attempts", I),
    ("produced_at", S),
)
ERROR_MESSAGE = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("error_type", S),
    ("error_detail", S), ("attempts", I), ("retry_at", S), ("produced_at", S),
)
VALIDATED = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("title", S), ("content", S),
    ("llm_answer", S), ("best_answer", S), ("score", D), ("accepted", B), ("source", S),
    ("attempts", I), ("decided_at", S),
)
REGENERATION = _schema(
    ("message_id", S), ("trace_id", S), ("question_id", S), ("title", S), ("content", S),
    ("prompt", S), ("best_answer", S), ("attempts", I),
)
SCORE_REQUEST = _schema(("question_id", S), ("best_answer", S), ("llm_answer", S))

# Field defaults of absent fields.
# The string default is "", counters default to 0, the question
# source defaults to "traffic-generator".
DEFAULTS: dict[str, dict[str, object]] = {
    "question": {"question_id": "", "title": "", "content": "", "best_answer": "",
                 "source": "traffic-generator", "attempts": 0},
    "llm_request": {"attempts": 0},
    "llm_response": {"title": "", "content": "", "prompt": "", "llm_answer": "", "best_answer": ""},
    "error": {},
    "validated": {},
    "regeneration": {"title": "", "content": "", "prompt": "", "best_answer": "", "attempts": 0},
    "score_request": {"best_answer": "", "llm_answer": ""},
}

# Fields without a default, which a message must have.
_IDS = ("message_id", "trace_id", "question_id")
REQUIRED: dict[str, tuple[str, ...]] = {
    "llm_request": (*_IDS, "title", "content", "prompt", "best_answer"),
    "llm_response": _IDS,
    "error": (*_IDS, "error_type", "error_detail", "attempts"),
    "validated": (*_IDS, "title", "content", "llm_answer", "best_answer", "score", "accepted", "source", "attempts"),
    "regeneration": _IDS,
    "score_request": ("question_id",),
}

# Fields filled in when absent: ids, and times of the step that makes the record.
GENERATED = {"message_id": "id", "trace_id": "id", "created_at": "time", "produced_at": "time", "decided_at": "time"}

SCHEMAS: dict[str, T.StructType] = {
    "question": QUESTION,
    "llm_request": LLM_REQUEST,
    "llm_response": LLM_RESPONSE,
    "error": ERROR_MESSAGE,
    "validated": VALIDATED,
    "regeneration": REGENERATION,
    "score_request": SCORE_REQUEST,
}

# ISO-8601 UTC with microseconds, the canonical form we emit.
ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"

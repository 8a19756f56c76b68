"""Text column expressions: whitespace handling, tokens, prompts and answers.

Everything here maps Columns to Columns with built-in Spark functions, so it
stays inside whole-stage code generation and needs no Python worker.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These must equal the reference's behaviour for equal results.
# ---------------------------------------------------------------------------
# Characters Python's ``str.split()`` (no separator) treats as whitespace,
# written in a syntax both Java regex and RE2 accept.
WHITESPACE_CLASS = (
    r"[\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
# The same characters as code-point ranges, for trimming by character set.
WHITESPACE_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680),
    (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
WHITESPACE_CHARS = "".join(chr(c) for lo, hi in WHITESPACE_RANGES for c in range(lo, hi + 1))
# Default TF-IDF token pattern: runs of two or more word characters.
TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"
# Separator between title and content in a prompt.
PROMPT_SEPARATOR = "\n\n"
# Offline answer: fixed prefix, the first 60 whitespace tokens, then a period.
OFFLINE_PREFIX = (
    "Respuesta generada automáticamente en modo offline. Resumen de la pregunta: "
)
OFFLINE_SUFFIX = "."
OFFLINE_TOKEN_LIMIT = 60
# Instruction prompt template and placeholders.
INSTRUCTION_INTRO = (
    "Eres un asistente experto que responde preguntas provenientes de Yahoo! Answers. "
    "Redacta una respuesta clara y completa, justificando los pasos si corresponde. "
    "Pregunta: "
)
INSTRUCTION_DETAILS = "\n\nDetalles adicionales: "
INSTRUCTION_TAIL = "\n\nRespuesta:"
INSTRUCTION_EMPTY_TITLE = "(Sin título)"
INSTRUCTION_EMPTY_CONTENT = "(Sin descripción adicional)"
# Fallback answer template and placeholders.
FALLBACK_EMPTY_TITLE = "Consulta de Yahoo! Answers"
FALLBACK_EMPTY_CONTENT = "No se proporcionaron detalles adicionales."
FALLBACK_DESCRIPTION = "\n\nDescripción: "
FALLBACK_BODY = (
    "\n\nSugerencia generada localmente:\n"
    "- Revisa la respuesta aceptada en el dataset.\n"
    "- Considera desglosar el problema en pasos para verificar cada afirmación.\n\n"
)
FALLBACK_NOTE = (
    "Esta respuesta fue generada localmente porque el servicio de Gemini no respondió a tiempo."
)
FALLBACK_REASON = " Motivo original: "
FALLBACK_GUIDANCE = (
    "Para obtener una respuesta definitiva, compara esta recomendación con la mejor respuesta humana del "
    "dataset y consulta fuentes confiables adicionales."
)
# Smoothed IDF of a term present in one of the two texts of a pair:
# ln((1 + n) / (1 + df)) + 1 with n = 2 documents and df = 1.
UNSHARED_IDF = math.log(1.5) + 1.0
# A term present in both texts has idf ln(3 / 3) + 1 = 1.
SHARED_IDF = 1.0


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c: Column | str) -> Column:
    """Python ``str.strip()``: remove leading/trailing whitespace of any kind.

    A character-set trim touches only the two ends of the text (a regex
    replace would scan all of it).
    """
    return F.trim(_col(c), F.lit(WHITESPACE_CHARS))


def first_tokens(c: Column | str, n: int = OFFLINE_TOKEN_LIMIT) -> Column:
    """``" ".join(text.split()[:n])``.

    One anchored regex match reads the first ``n`` tokens only; the rest of a
    long text is never split into an array.
    """
    ws = WHITESPACE_CLASS
    word = "[^" + ws[1:] + "+"
    head = F.regexp_extract(_col(c), f"^{ws}*((?:{word}{ws}+){{0,{n - 1}}}{word})?", 1)
    return F.regexp_replace(head, ws + "+", " ")


def tokenize(c: Column | str) -> Column:
    """Lower-cased word runs of two or more characters (the TF-IDF analyzer)."""
    return F.regexp_extract_all(F.lower(_col(c)), F.lit(TOKEN_PATTERN), 0)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def build_prompt(title: Column | str, content: Column | str) -> Column:
    """Non-empty parts of (title, content) joined by a blank line."""
    return F.concat_ws(PROMPT_SEPARATOR, blank_to_null(title), blank_to_null(content))


def offline_answer(prompt: Column | str, prefix: str = OFFLINE_PREFIX,
                   limit: int = OFFLINE_TOKEN_LIMIT) -> Column:
    """Deterministic offline answer: prefix + first ``limit`` tokens + '.'."""
    return F.concat(F.lit(prefix), first_tokens(F.coalesce(_col(prompt), F.lit("")), limit),
                    F.lit(OFFLINE_SUFFIX))


def _or_placeholder(c: Column | str, placeholder: str) -> Column:
    s = strip_ws(F.coalesce(_col(c), F.lit("")))
    return F.when(s == "", F.lit(placeholder)).otherwise(s)


def instruction_prompt(title: Column | str, content: Column | str) -> Column:
    """Instruction prompt for a hosted generator, with placeholders when empty."""
    return F.concat(
        F.lit(INSTRUCTION_INTRO),
        _or_placeholder(title, INSTRUCTION_EMPTY_TITLE),
        F.lit(INSTRUCTION_DETAILS),
        _or_placeholder(content, INSTRUCTION_EMPTY_CONTENT),
        F.lit(INSTRUCTION_TAIL),
    )


def fallback_answer(title: Column | str, content: Column | str,
                    error: Column | str | None = None) -> Column:
    """Locally built answer used when the generator fails; notes the error if any."""
    note = F.lit(FALLBACK_NOTE)
    if error is not None:
        err = _col(error)
        note = F.when(err.isNotNull(),
                      F.concat(note, F.lit(FALLBACK_REASON), err, F.lit("."))).otherwise(note)
    return F.concat(
        _or_placeholder(title, FALLBACK_EMPTY_TITLE),
        F.lit(FALLBACK_DESCRIPTION),
        _or_placeholder(content, FALLBACK_EMPTY_CONTENT),
        F.lit(FALLBACK_BODY),
        note,
        F.lit(" "),
        F.lit(FALLBACK_GUIDANCE),
    )


def sanitize_fragment(c: Column | str) -> Column:
    """space -> '-', '/' -> '-', '.' -> '_' (file-name fragment)."""
    return F.translate(_col(c).cast("string"), " /.", "--_")

"""Accept / regenerate decisions per message, and the regeneration loop.

The streaming scorer keeps, per message key, an attempt counter: each scored
response increments it; a response is accepted when its score reaches the
threshold or the counter reaches ``max_attempts``; acceptance clears the
counter.  In batch this has a closed form over the key's arrival order:

    lastnat  = position of the last naturally accepted row before this one
    attempts = ((pos - lastnat) - 1) % max(max_attempts, 1) + 1

``pos`` and ``lastnat`` come from ``keyed_scan``, which cuts the rows into
ranges of (key, order), so one hot key is spread over many tasks.  A NULL
score is a rejection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verity.functions.ids import now_iso
from verity.functions.text import build_prompt, fallback_answer, offline_answer
from verity.operators.score import STREAM_THRESHOLD, _scored
from verity.operators.sequence import keyed_scan
from verity.session import checkpoint

# Default cap on attempts, and the source label of scored answers.
MAX_ATTEMPTS = 3
SCORER_SOURCE = "scorer"


def attempt_decisions(df: DataFrame, key: str = "message_id", order: Sequence[str] = ("ts", "event_id"),
                      score: str = "score", threshold: float = STREAM_THRESHOLD,
                      max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Add ``attempts``, ``accepted`` and ``forced`` (accepted only because of the cap).

    A NULL score is a rejection; rows with a NULL key or order value are kept
    (NULL keys are one key, NULL order values come first).
    """
    nat = F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False))
    scanned = keyed_scan(df, [key], list(order), flag=nat)
    m = max(int(max_attempts), 1)
    rn = F.col("_pos") - F.coalesce(F.col("_lastflag"), F.lit(0))
    attempts = ((rn - 1) % F.lit(m) + 1).cast("int")
    return scanned.withColumn("attempts", attempts) \
        .withColumn("accepted", nat | (F.col("attempts") >= F.lit(max_attempts))) \
        .withColumn("forced", F.col("accepted") & ~nat) \
        .drop("_pos", "_lastflag")


def validated_projection(decided: DataFrame, source: str = SCORER_SOURCE,
                         decided_at: Column | str = "produced_at") -> DataFrame:
    """Accepted response -> validated record.  ``content`` carries the prompt
    (the scorer's mapping), ``attempts`` the decision counter."""
    at = F.col(decided_at) if isinstance(decided_at, str) else decided_at
    return decided.filter(F.col("accepted")).select(
        "message_id", "trace_id", "question_id",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("prompt"), F.lit("")).alias("content"),
        F.coalesce(F.col("llm_answer"), F.lit("")).alias("llm_answer"),
        F.coalesce(F.col("best_answer"), F.lit("")).alias("best_answer"),
        F.col("score").cast("double").alias("score"),
        F.col("accepted"),
        F.lit(source).alias("source"),
        F.col("attempts").cast("int").alias("attempts"),
        at.alias("decided_at"),
    )


def regeneration_requests(decided: DataFrame) -> DataFrame:
    """Rejected response -> regeneration record carrying the decision counter."""
    return decided.filter(~F.col("accepted")).select(
        "message_id", "trace_id", "question_id",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        F.coalesce(F.col("prompt"), F.lit("")).alias("prompt"),
        F.coalesce(F.col("best_answer"), F.lit("")).alias("best_answer"),
        F.col("attempts").cast("int").alias("attempts"),
    )


def split_decisions(decided: DataFrame, source: str = SCORER_SOURCE) -> tuple[DataFrame, DataFrame]:
    """Main output (validated) and side output (regeneration) of one decided frame."""
    return validated_projection(decided, source), regeneration_requests(decided)


def decision_counts(decided: DataFrame) -> DataFrame:
    """Counters of the scorer: accepted (natural / forced) and regenerated."""
    label = F.when(~F.coalesce("accepted", F.lit(False)), "regenerated").when(F.col("forced"), "forced").otherwise("accepted")
    return decided.groupBy(label.alias("decision")).agg(F.count(F.lit(1)).alias("n"))


# --- requests ----------------------------------------------------------------

def first_requests(questions: DataFrame) -> DataFrame:
    """Question -> answer request: prompt from title/content, attempts + 1."""
    return questions.select(
        "message_id", "trace_id", "question_id",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        build_prompt("title", "content").alias("prompt"),
        F.coalesce(F.col("best_answer"), F.lit("")).alias("best_answer"),
        (F.coalesce(F.col("attempts"), F.lit(0)) + 1).cast("int").alias("attempts"),
    )


def repeat_requests(regenerations: DataFrame) -> DataFrame:
    """Regeneration record -> answer request with the same prompt, attempts + 1."""
    return regenerations.select(
        "message_id", "trace_id", "question_id",
        F.coalesce(F.col("title"), F.lit("")).alias("title"),
        F.coalesce(F.col("content"), F.lit("")).alias("content"),
        F.coalesce(F.col("prompt"), F.lit("")).alias("prompt"),
        F.coalesce(F.col("best_answer"), F.lit("")).alias("best_answer"),
        (F.coalesce(F.col("attempts"), F.lit(0)) + 1).cast("int").alias("attempts"),
    )


def request_union(questions: DataFrame, regenerations: DataFrame) -> DataFrame:
    """Both request producers feed one request stream."""
    return first_requests(questions).withColumn("origin", F.lit("question")) \
        .unionByName(repeat_requests(regenerations).withColumn("origin", F.lit("regeneration")))


Generator = Callable[[Column], Column]
_MESSAGE = ["message_id", "trace_id", "question_id"]


def answer_requests(requests: DataFrame, generator: Generator = offline_answer,
                    error: Column | None = None, produced_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Request -> (responses, errors).

    ``generator`` maps the prompt Column to an answer Column (default: the
    deterministic offline answer; a ``pandas_udf`` plugs in the same way).
    When ``error`` is given, rows where it is non-null become error records
    instead of responses.  Latency is not measured per row in batch (0.0).
    ``produced_at`` adds that column to both (streams stamp the time).
    """
    err = error if error is not None else F.lit(None).cast("string")
    with_answer = requests.withColumn("llm_answer", generator(F.col("prompt"))).withColumn("_error", err)
    stamp = [] if produced_at is None else [produced_at.alias("produced_at")]
    responses = with_answer.filter(F.col("_error").isNull()).select(
        *_MESSAGE, "title", "content", "prompt", "llm_answer",
        "best_answer", F.lit(0.0).alias("latency_ms"), F.col("attempts").cast("int").alias("attempts"), *stamp)
    errors = with_answer.filter(F.col("_error").isNotNull()).select(
        *_MESSAGE, F.lit("GenerationError").alias("error_type"),
        F.col("_error").alias("error_detail"), F.col("attempts").cast("int").alias("attempts"), *stamp)
    return responses, errors


def generate_with_fallback(requests: DataFrame, generator: Generator = offline_answer,
                           error: Column | None = None, fallback: bool = True,
                           produced_at: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Request -> (responses, errors): the generator's answer, else the local
    fallback text, else an error record.

    ``error`` (a Column, non-null where the generator failed; it may read
    ``llm_answer``) marks failures; a NULL answer is one too.  With ``fallback`` a failed request gets
    the fallback answer naming the error and every failure is also reported;
    without it, it becomes an error record only.
    """
    answered = requests.withColumn("llm_answer", generator(F.col("prompt")))
    failed = error if error is not None else F.lit(None).cast("string")
    failed = F.coalesce(failed, F.when(F.col("llm_answer").isNull(), F.lit("empty answer")))
    answered = answered.withColumn("_error", failed)
    stamp = [] if produced_at is None else [produced_at.alias("produced_at")]
    text = F.when(F.col("_error").isNull(), F.col("llm_answer")) \
        .otherwise(fallback_answer("title", "content", F.col("_error")))
    responses = (answered if fallback else answered.filter(F.col("_error").isNull())).select(
        *_MESSAGE, "title", "content", "prompt", text.alias("llm_answer"), "best_answer",
        F.lit(0.0).alias("latency_ms"), F.col("attempts").cast("int").alias("attempts"), *stamp)
    errors = answered.filter(F.col("_error").isNotNull()).select(
        *_MESSAGE, F.lit("GenerationError").alias("error_type"),
        F.col("_error").alias("error_detail"), F.col("attempts").cast("int").alias("attempts"), *stamp)
    return responses, errors


def loop_quarantine(questions: DataFrame) -> DataFrame:
    """The questions that ``regeneration_loop`` cannot take, one row each, all columns, with a ``reason``."""
    return questions.filter(F.col("message_id").isNull()).withColumn("reason", F.lit("missing message_id"))


def regeneration_loop(questions: DataFrame, generator: Generator = offline_answer,
                      threshold: float = STREAM_THRESHOLD, max_attempts: int = MAX_ATTEMPTS,
                      source: str = SCORER_SOURCE, decided_at: Column | None = None) -> DataFrame:
    """Question -> answer -> score -> accept or regenerate, for at most
    ``max(max_attempts, 1)`` rounds; returns the validated records of all
    rounds (all twelve fields, score unrounded), with ``request_attempts`` (what
    the accepted request carried: the question's attempts + 1 in the first
    round, then the decision counter + 1) and ``forced``.

    ``message_id`` must be unique per question.  A question with a NULL
    ``message_id`` cannot be told from others; ``loop_quarantine`` has it.  A round's requests are the source
    questions joined with the keys still rejected, which carry the last answer
    and its score: an answer equal to the last one keeps its score, so a
    deterministic generator is scored once.  Each round checkpoints ids, the
    short answer and the decision, never prompts or reference texts; the
    texts of the result are joined from the questions once, at the end.
    ``decided_at`` is a column over the question's fields (default: now).
    """
    base = first_requests(questions).filter(F.col("message_id").isNotNull())
    rounds = max(int(max_attempts), 1)
    parts = []
    pending = None
    for r in range(1, rounds + 1):
        ids = ["message_id", "attempts"]
        if pending is None:
            asked = base.withColumn("_last", F.lit(None).cast("string")).withColumn("_kept", F.lit(None).cast("double"))
        else:
            asked = base.drop("attempts").join(pending, "message_id")
        answered = asked.select(*ids, "best_answer", "_last", "_kept", generator(F.col("prompt")).alias("llm_answer"))
        same = F.col("_last").eqNullSafe(F.col("llm_answer")) & F.col("_kept").isNotNull()
        answered = answered.repartition("message_id").persist(StorageLevel.MEMORY_AND_DISK)
        fresh = _scored(answered.filter(~same).select("message_id", "attempts", "llm_answer", "best_answer"),
                        "message_id", "best_answer", "llm_answer").select(*ids, "llm_answer", "_raw")
        kept = answered.filter(same).select(*ids, "llm_answer", F.col("_kept").alias("_raw"))
        nat = F.coalesce(F.col("_raw") >= F.lit(threshold), F.lit(False))
        decided = checkpoint((fresh if pending is None else fresh.unionByName(kept)).select(
            *ids, "llm_answer", F.col("_raw").alias("score"), nat.alias("nat")))
        answered.unpersist()
        ends = F.lit(r >= max_attempts)
        parts.append(decided.filter(F.col("nat") | ends).select(
            "message_id", "llm_answer", "score", F.col("attempts").alias("request_attempts"),
            F.lit(r).cast("int").alias("attempts"), (~F.col("nat")).alias("forced")))
        if r == rounds:
            break
        pending = decided.filter(~F.col("nat") & ~ends).select(
            "message_id", F.lit(r + 1).cast("int").alias("attempts"),
            F.col("llm_answer").alias("_last"), F.col("score").alias("_kept"))
        if not pending.head(1):
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    at = decided_at if decided_at is not None else now_iso()
    texts = questions.select("message_id", "trace_id", "question_id", F.coalesce("title", F.lit("")).alias("title"),
                             build_prompt("title", "content").alias("content"),
                             F.coalesce("best_answer", F.lit("")).alias("best_answer"), at.alias("decided_at"))
    return out.join(texts, "message_id").select(
        "message_id", "trace_id", "question_id", "title", "content", "llm_answer", "best_answer", "score",
        F.lit(True).alias("accepted"), F.lit(source).alias("source"), "attempts", "decided_at",
        "request_attempts", "forced")

"""Streaming scorer: responses -> score -> per-key attempt counter -> two outputs.

* Scoring is row-local (``pair_score``: tokens sorted and folded inside the
  row), so it runs in the micro-batch without any aggregation or shuffle.
* The attempt counter is keyed state (``applyInPandasWithState`` on
  ``message_id``).  Per key and micro-batch the counter is vectorised with
  numpy: positions continue from the stored count, the last natural accept
  before each row is a running maximum, and the closed form
  ``((pos - lastnat) - 1) % max_attempts + 1`` gives the counter including
  the resets of forced accepts.  A key's state is removed when its last row
  is accepted, so state holds only keys with pending rejections (each at most
  ``max_attempts - 1``).
* The decided stream goes to ``foreachBatch``, which writes the validated
  rows, the regeneration requests and the undecodable messages of a
  micro-batch once (``verity.streaming.sinks``).

``max_per_trigger`` bounds a micro-batch, and with it what one hot key can put
into a single state call.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from verity.functions.ids import now_iso
from verity.functions.json import decode
from verity.operators.decide import MAX_ATTEMPTS, SCORER_SOURCE, regeneration_requests, validated_projection
from verity.operators.score import STREAM_THRESHOLD, pair_score
from verity.sources.streams import delivered_once, read_topic
from verity.streaming.sinks import QUARANTINE, BatchSinks, consume, start

_STATE = T.StructType([T.StructField("pending", T.IntegerType())])
DECISION_FIELDS = [T.StructField("attempts", T.IntegerType()), T.StructField("accepted", T.BooleanType()),
                   T.StructField("forced", T.BooleanType())]


def counter_step(scores: np.ndarray, pending: int, threshold: float, max_attempts: int):
    """Counter of one key over rows in arrival order, given ``pending`` earlier
    rejections.  Returns (attempts, accepted, forced, pending_after)."""
    m = max(int(max_attempts), 1)
    nat = scores >= threshold
    pos = np.arange(1, len(scores) + 1, dtype=np.int64) + int(pending)
    last = np.maximum.accumulate(np.where(nat, pos, 0))
    before = np.concatenate([[0], last[:-1]]) if len(last) else last
    attempts = ((pos - before) - 1) % m + 1
    accepted = nat | (attempts >= max_attempts)
    forced = accepted & ~nat
    if len(attempts) == 0:
        return attempts.astype(np.int32), accepted, forced, int(pending)
    after = 0 if accepted[-1] else int(attempts[-1])
    return attempts.astype(np.int32), accepted, forced, after


def _counter_fn(score: str, order: Sequence[str], threshold: float, max_attempts: int):
    order = list(order)

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(pdfs), ignore_index=True)
        if order:
            pdf = pdf.sort_values(order, kind="mergesort", ignore_index=True)
        pending = int(state.get[0]) if state.exists else 0
        s = pdf[score].astype("float64").fillna(-np.inf).to_numpy()
        attempts, accepted, forced, after = counter_step(s, pending, threshold, max_attempts)
        if after:
            state.update((after,))
        elif state.exists:
            state.remove()
        yield pdf.assign(attempts=attempts, accepted=accepted, forced=forced)

    return fn


def stream_attempt_decisions(scored: DataFrame, key: str = "message_id", order: Sequence[str] = (),
                             score: str = "score", threshold: float = STREAM_THRESHOLD,
                             max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Streaming form of ``attempt_decisions``: adds attempts, accepted, forced.

    Rows of one key are taken in arrival order (micro-batch by micro-batch),
    and inside a micro-batch by ``order`` when given.
    """
    base = scored.drop(*[f.name for f in DECISION_FIELDS if f.name in scored.columns])
    out_schema = T.StructType(base.schema.fields + DECISION_FIELDS)
    return base.groupBy(key).applyInPandasWithState(
        _counter_fn(score, order, threshold, max_attempts), out_schema, _STATE, "append",
        GroupStateTimeout.NoTimeout)


def score_responses(responses: DataFrame, expected: str = "best_answer", actual: str = "llm_answer") -> DataFrame:
    """Add the unrounded pair score (row-local, no shuffle)."""
    return responses.withColumn("score", pair_score(expected, actual))


def decide_stream(raw: DataFrame, threshold: float = STREAM_THRESHOLD, max_attempts: int = MAX_ATTEMPTS) -> DataFrame:
    """Raw (key, value) messages -> decided responses; undecodable ones pass
    with ``valid`` false, their raw value and the reason.

    Rows of a key are taken in order of their parsed ``produced_at``.  A message
    that does not decode has no key and no counter; it is keyed by its own text.
    """
    messages = decode(raw, "llm_response", keep=("key", "value"), stamp=True)
    messages = messages.withColumn("value", F.when(~F.col("valid"), F.col("value")))
    messages = messages.withColumn("_at", F.try_to_timestamp(F.col("produced_at")))
    lane = F.when(F.col("valid"), F.concat(F.lit("m"), F.col("message_id"))) \
        .otherwise(F.concat(F.lit("x"), F.sha2(F.coalesce("value", F.lit("")), 256)))
    scored = score_responses(messages.withColumn("_lane", lane))
    decided = stream_attempt_decisions(scored, "_lane", ("_at", "produced_at"), "score", threshold, max_attempts)
    decided = decided.drop("_lane", "_at")
    # Live counters, in every progress report of the query.
    good = F.col("valid")
    return decided.observe(
        "decisions", F.count_if(good & F.col("accepted") & ~F.col("forced")).alias("accepted"),
        F.count_if(good & F.col("forced")).alias("forced"),
        F.count_if(good & ~F.col("accepted")).alias("regenerated"), F.count_if(~good).alias("quarantined"))


def decision_sink(sinks: BatchSinks, source: str = SCORER_SOURCE, decided_at: Column | None = None):
    """foreachBatch function writing the outputs of a decided micro-batch once."""

    def sink(batch: DataFrame, batch_id: int) -> None:
        if sinks.done(batch.sparkSession, batch_id):
            consume(batch)
            return
        batch = batch.persist()
        try:
            good = batch.filter("valid")
            at = decided_at if decided_at is not None else now_iso()
            sinks.write(batch_id, {
                "validated": ("validated", validated_projection(good, source, at)),
                "regeneration": ("regeneration", regeneration_requests(good)),
                QUARANTINE: (None, batch.filter(~F.col("valid")).select("key", "value", "reason")),
            })
        finally:
            batch.unpersist()

    return sink


def start_scorer(spark: SparkSession, responses: str, validated: str, regeneration: str, checkpoint: str,
                 quarantine: str | None = None, threshold: float = STREAM_THRESHOLD,
                 max_attempts: int = MAX_ATTEMPTS, max_per_trigger: int | None = None, fmt: str = "files",
                 available_now: bool = True, source: str = SCORER_SOURCE, decided_at: Column | None = None,
                 kafka_servers: str | None = None, kafka_options: Mapping[str, str] | None = None,
                 once_within: str | None = None):
    """Start the scorer: llm_responses -> decode -> score -> counter -> validated / regeneration / quarantine.

    ``responses``, ``validated``, ``regeneration`` and ``quarantine`` are folders, or Kafka topics with
    ``fmt="kafka"`` (``kafka_options`` go to the source and the sinks).  Without ``quarantine``, undecodable
    messages go to ``<regeneration>_quarantine``.  ``checkpoint`` must be on shared storage; it holds offsets
    and the keyed state, so a restarted query resumes where it stopped.  ``decided_at`` is the time of the
    decision unless a column over the response is given (replayable runs).  ``once_within``: responses delivered
    again in that time are scored once (``sources.streams.delivered_once``).
    """
    topics = {"validated": validated, "regeneration": regeneration,
              QUARANTINE: quarantine or f"{regeneration.rstrip('/')}_quarantine"}
    sinks = BatchSinks(topics, checkpoint, fmt, kafka_servers, kafka_options)
    raw = read_topic(spark, responses, fmt, responses, max_per_trigger, kafka_servers, kafka_options)
    return start(decide_stream(delivered_once(raw, once_within), threshold, max_attempts), decision_sink(sinks, source, decided_at),
                 checkpoint, available_now)

"""Error records as a stream: failed requests go back to the requests when their time has come.

``start_retries`` reads requests and errors.  Keyed state per message holds the newest request and, after an error, the
time to try again; a processing-time timer wakes the key then, and the request is sent with the next attempt's number
(``verity.operators.retry`` says the same for tables).  A request that no error follows within ``hold_seconds`` leaves
the state, so state is bounded by the requests of that time.  An error of no more attempts than one seen before is a
replay and changes nothing.  What cannot be tried again (attempts used up, no time, no request known ``hold_seconds`` after its time) goes to
the quarantine with the reason.

For workers that answer failures with an error record alone (``start_worker(..., fallback=False)``): with the
fallback text the failed request already has its response.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from verity.functions.ids import now_iso
from verity.functions.json import decode, split_valid
from verity.operators.retry import EXHAUSTED, MAX_RETRY_ATTEMPTS, NO_REQUEST
from verity.sources.streams import read_topics
from verity.streaming.sinks import QUARANTINE, BatchSinks, consume, make_folder, start

HOLD_SECONDS = 3600.0
AGAIN = "again"
_STATE = "request string, error string, sent int, failed int, due_ms long, until_ms long"
_OUT = "key string, value string, outcome string, attempts int"
_NEVER = -1


def retry_step(state: tuple, requests: list[tuple], errors: list[tuple], now_ms: int, hold_ms: int, max_attempts: int):
    """One key's step.  ``state``: (request, error, sent, failed, due_ms, until_ms): the texts of the newest request and error, their
    attempts (0: none) and two times (``_NEVER``: none).  ``requests``: (attempts, text); ``errors``: (attempts, due_ms or None, text).
    Returns the state after (None: forget the key) and the output rows (text, outcome, attempts)."""
    request, error, sent, failed, due, until = state
    out = []
    for attempts, text in requests:
        if request is None or attempts >= sent:
            request, sent = text, attempts
        until = now_ms + hold_ms
    for attempts, due_ms, text in sorted(errors, key=lambda e: e[0]):
        if attempts <= failed:
            continue
        error, failed, due, until = text, attempts, _NEVER, max(until, now_ms + hold_ms)
        if attempts >= max_attempts or due_ms is None:
            out.append((text, EXHAUSTED, attempts))
        elif sent <= attempts:
            due = due_ms
            until = max(until, due_ms + hold_ms)
    if due != _NEVER and sent > failed:
        due = _NEVER  # sent again by someone else meanwhile
    if due != _NEVER and now_ms >= due and request is not None:
        out.append((request, AGAIN, failed + 1))
        due = _NEVER
    if now_ms >= until and (due == _NEVER or request is None):
        return None, out + ([(error, NO_REQUEST, failed)] if due != _NEVER else [])
    return (request, error, sent, failed, due, until), out


def _step_fn(hold_ms: int, max_attempts: int):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        requests, errors = [], []
        if not state.hasTimedOut:
            for pdf in pdfs:
                for row in pdf.itertuples(index=False):
                    if row.is_error:
                        errors.append((int(row.attempts), None if pd.isna(row.due_ms) else int(row.due_ms), row.value))
                    else:
                        requests.append((int(row.attempts), row.value))
        now_ms = state.getCurrentProcessingTimeMs()
        before = tuple(state.get) if state.exists else (None, None, 0, 0, _NEVER, now_ms + hold_ms)
        after, out = retry_step(before, requests, errors, now_ms, hold_ms, max_attempts)
        if after is None:
            if state.exists:
                state.remove()
        else:
            state.update(after)
            request, due, until = after[0], after[4], after[5]
            wake = until if due == _NEVER or request is None else due
            state.setTimeoutDuration(max(1, wake - now_ms))
        yield pd.DataFrame([(key[0], *row) for row in out], columns=["key", "value", "outcome", "attempts"])

    return fn


def retry_stream(requests: DataFrame, errors: DataFrame, hold_seconds: float = HOLD_SECONDS,
                 max_attempts: int = MAX_RETRY_ATTEMPTS) -> DataFrame:
    """Decoded requests and errors (with ``value``) -> (key, value, outcome, attempts): a request's text to be sent
    ``again`` with these attempts, or a text and why nothing is sent."""
    tries = F.coalesce(F.col("attempts"), F.lit(0)).alias("attempts")
    due = F.unix_millis(F.try_to_timestamp(F.col("retry_at")))
    rows = requests.select("message_id", "value", tries, F.lit(None).cast("long").alias("due_ms"), F.lit(False).alias("is_error"))
    rows = rows.unionByName(errors.select("message_id", "value", tries, due.alias("due_ms"), F.lit(True).alias("is_error")))
    return rows.groupBy("message_id").applyInPandasWithState(
        _step_fn(int(hold_seconds * 1000), max_attempts), _OUT, _STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)


def start_retries(spark: SparkSession, requests: str, errors: str, checkpoint: str, again: str | None = None,
                  quarantine: str | None = None, hold_seconds: float = HOLD_SECONDS, max_attempts: int = MAX_RETRY_ATTEMPTS,
                  max_per_trigger: int | None = None, fmt: str = "files", available_now: bool = False,
                  kafka_servers: str | None = None, kafka_options: Mapping[str, str] | None = None):
    """Start the consumer of error records; ``again`` (default: ``requests``) takes the requests to send again.

    Errors that do not decode go to the quarantine; requests that do not are left to the worker's.  The default trigger keeps the
    query running: timers need triggers to come."""
    topics = {"requests": again or requests, QUARANTINE: quarantine or f"{errors.rstrip('/')}_quarantine"}
    sinks = BatchSinks(topics, checkpoint, fmt, kafka_servers, kafka_options)
    if fmt == "files":
        make_folder(spark, requests)
        make_folder(spark, errors)
    raw = read_topics(spark, [requests, errors], fmt, [requests, errors], max_per_trigger=max_per_trigger,
                      kafka_servers=kafka_servers, kafka_options=kafka_options)
    asked = decode(raw.filter(F.col("topic") == requests), "llm_request", keep=("key", "value")).filter("valid")
    failed = decode(raw.filter(F.col("topic") == errors), "error", keep=("key", "value"))
    broken = failed.filter(~F.col("valid")).select("key", "value", F.col("reason").alias("outcome"), F.lit(0).alias("attempts"))
    outcomes = retry_stream(asked, failed.filter("valid"), hold_seconds, max_attempts).unionByName(broken)

    def sink(batch: DataFrame, batch_id: int) -> None:
        if sinks.done(spark, batch_id):
            consume(batch)
            return
        batch = batch.persist()
        try:
            if batch.isEmpty():  # most wake-ups of the trigger find nothing due
                return
            sent, _ = split_valid(decode(batch.filter(F.col("outcome") == AGAIN), "llm_request", keep=("key", "value")))
            tries = batch.filter(F.col("outcome") == AGAIN).select(F.col("key").alias("message_id"), F.col("attempts").alias("next"))
            sent = sent.drop("key").join(tries, "message_id").withColumn("attempts", F.col("next")).withColumn("created_at", now_iso())
            refused = batch.filter(F.col("outcome") != AGAIN).select("key", "value", F.col("outcome").alias("reason"))
            sinks.write(batch_id, {"requests": ("llm_request", sent), QUARANTINE: (None, refused)})
        finally:
            batch.unpersist()

    return start(outcomes, sink, checkpoint, available_now)

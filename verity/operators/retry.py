"""What becomes of error records: requests to send again once their time has come.

An error record names the request that failed by its ``message_id`` and ``attempts`` and says when to try again
(``retry_at``).  Per message the record of most attempts counts; records of fewer attempts, and the same record sent
twice, change nothing.  A message's state at a given time is

* ``retried``: a request of more attempts than the error exists already;
* ``exhausted``: ``max_attempts`` are used up, or the record names no time (the delay leads beyond all time);
* ``no request``: nothing is known of the request;
* ``due`` / ``waiting``: the request goes out again, with the next attempt's number, once its time has come.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETRIED, EXHAUSTED, NO_REQUEST, DUE, WAITING = "retried", "exhausted", "no request", "due", "waiting"
#: Attempts after which a failing request is given up, unless the caller says otherwise.
MAX_RETRY_ATTEMPTS = 10


def retry_states(errors: DataFrame, requests: DataFrame, at: Column, max_attempts: int = MAX_RETRY_ATTEMPTS) -> DataFrame:
    """One row per message_id of ``errors`` (message_id, attempts, retry_at): ``state`` at the time ``at``, ``retry_at``, ``failed_attempts``,
    and the columns of its newest request (``attempts``: those of the next try).

    Both sides are folded to one slim row a message before the join, so a message that fails often or is sent
    often weighs no more than others.  A NULL message_id is left out; NULL attempts count as 0.
    """
    tries = F.coalesce(F.col("attempts").cast("int"), F.lit(0))
    due_at = F.try_to_timestamp(F.col("retry_at"))
    last = errors.filter("message_id IS NOT NULL").groupBy("message_id").agg(
        F.max(F.struct(tries.alias("n"), due_at.alias("due"), F.col("retry_at").alias("text"))).alias("e"))
    rest = [c for c in requests.columns if c not in ("message_id", "attempts")]
    sent = requests.filter("message_id IS NOT NULL").groupBy("message_id").agg(
        F.max_by(F.struct(tries.alias("n"), *rest), tries).alias("r"))
    joined = last.join(sent, "message_id", "left")
    state = F.when(F.col("r.n") > F.col("e.n"), RETRIED) \
        .when((F.col("e.n") >= max_attempts) | F.col("e.due").isNull(), EXHAUSTED) \
        .when(F.col("r").isNull(), NO_REQUEST).when(F.col("e.due") <= at, DUE).otherwise(WAITING)
    return joined.select("message_id", state.alias("state"), F.col("e.text").alias("retry_at"), F.col("e.n").alias("failed_attempts"),
                         *[F.col("r").getField(c).alias(c) for c in rest], (F.col("e.n") + 1).alias("attempts"))


def due_requests(errors: DataFrame, requests: DataFrame, at: Column, max_attempts: int = MAX_RETRY_ATTEMPTS) -> DataFrame:
    """The requests to send again at the time ``at``, with the columns of ``requests``."""
    return retry_states(errors, requests, at, max_attempts).filter(F.col("state") == DUE).select(*requests.columns)

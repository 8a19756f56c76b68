"""Keyed JSON message streams: sources and sinks.

A topic is either a Kafka topic (``fmt="kafka"``, needs the Kafka connector
on the classpath) or a folder of JSON-lines files (``fmt="files"``, used in
tests and for replayable batch drops; folders inside it are read too).  Both
give the same raw shape ``(key, value, topic)`` with ``value`` the UTF-8 JSON
text, so decoding (``verity.functions.json.decode``) is the same for both.

A micro-batch takes all that is there unless ``max_per_trigger`` bounds it
(records for Kafka, files for a folder): size it for the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from verity.functions.json import encode


def kafka_source_options(topic: str, servers: str | None, max_per_trigger: int | None = None,
                         extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a Kafka source; ``extra`` overrides (security, group prefix, ...)."""
    if not servers:
        raise ValueError("a Kafka topic needs kafka_servers")
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    return options | dict(extra or {})


def kafka_sink_options(topic: str, servers: str | None, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a Kafka sink: every in-sync replica confirms, retries do not duplicate."""
    if not servers:
        raise ValueError("a Kafka topic needs kafka_servers")
    options = {"kafka.bootstrap.servers": servers, "topic": topic, "kafka.acks": "all",
               "kafka.enable.idempotence": "true"}
    return options | dict(extra or {})


def read_topic(spark: SparkSession, topic: str, fmt: str = "files", path: str | None = None,
               max_per_trigger: int | None = None, kafka_servers: str | None = None,
               kafka_options: Mapping[str, str] | None = None) -> DataFrame:
    """Streaming (key, value, topic) from the earliest offset.  For files, the
    key is the message's ``message_id``."""
    if fmt == "kafka":
        options = kafka_source_options(topic, kafka_servers, max_per_trigger, kafka_options)
        return spark.readStream.format("kafka").options(**options).load().select(
            F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "topic")
    reader = spark.readStream.format("text").option("recursiveFileLookup", "true")
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_per_trigger))
    raw = reader.load(path or topic)
    return raw.select(F.get_json_object("value", "$.message_id").alias("key"), "value",
                      F.lit(topic).alias("topic"))


def read_topics(spark: SparkSession, topics: Sequence[str], fmt: str = "files",
                paths: Sequence[str] | None = None, **kw) -> DataFrame:
    """One stream over several topics; ``topic`` tells the branch (multi-topic consumer)."""
    if fmt == "kafka":
        return read_topic(spark, ",".join(topics), fmt, **kw)
    paths = list(paths or topics)
    out = read_topic(spark, topics[0], fmt, paths[0], **kw)
    for t, p in zip(topics[1:], paths[1:]):
        out = out.unionByName(read_topic(spark, t, fmt, p, **kw))
    return out


def delivered_once(raw: DataFrame, within: str | None, fields: Sequence[str] = ("message_id", "attempts")) -> DataFrame:
    """``raw`` without messages delivered again within ``within`` (an interval; None: ``raw`` as it is).

    A producer that repeats a micro-batch after a failure (a Kafka sink) emits its records again, with other times and
    maybe in another order.  Two messages of one topic are the same when they agree in ``fields``; one without the
    first of these is told by its whole text.  State holds an identity for that long after it came.  The clock is that of
    arrival, so no message is ever late, and none is dropped but for repeats.  Give it to consumers of topics whose
    messages carry their attempt: a message that is sent again on purpose with the same attempt goes, too."""
    if within is None:
        return raw
    parts = [F.get_json_object("value", f"$.{f}") for f in fields]
    same = F.when(parts[0].isNotNull(), F.to_json(F.array(F.lit("m"), *[F.coalesce(p, F.lit("")) for p in parts]))) \
        .otherwise(F.concat(F.lit("x"), F.sha2(F.coalesce("value", F.lit("")), 256)))
    named = raw.withColumn("_same", same).withColumn("_came", F.current_timestamp())
    return named.withWatermark("_came", within).dropDuplicatesWithinWatermark(["topic", "_same"]).drop("_same", "_came")


def read_topic_batch(spark: SparkSession, topic: str, path: str | None = None) -> DataFrame:
    """The whole content of a file topic as a batch DataFrame (same shape)."""
    raw = spark.read.format("text").load(path or topic)
    return raw.select(F.get_json_object("value", "$.message_id").alias("key"), "value",
                      F.lit(topic).alias("topic"))


def topic_writer(records: DataFrame, kind: str, topic: str, fmt: str = "files", path: str | None = None,
                 checkpoint: str | None = None, kafka_servers: str | None = None,
                 kafka_options: Mapping[str, str] | None = None) -> DataStreamWriter:
    """Streaming sink of typed records as JSON values keyed by ``message_id``.

    Returns the configured writer; the caller picks the trigger and starts it.
    """
    enc = encode(records, kind)
    if fmt == "kafka":
        w = enc.writeStream.format("kafka").options(**kafka_sink_options(topic, kafka_servers, kafka_options))
    else:
        w = enc.select("value").writeStream.format("text").option("path", path or topic)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w

"""Outputs of a micro-batch, written once per batch id.

``BatchSinks`` writes the frames of one micro-batch to their topics.  On files,
each goes to a folder named by the query and the batch id, so another query's
batch of the same number cannot meet it; a batch that is replayed after its folders
were completed is consumed (its keyed state has to be written) but not emitted
again.  On Kafka a replayed batch is emitted again (at least once).

Messages that do not decode go to the quarantine as raw value and reason.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from verity.functions.json import encode
from verity.sources.streams import kafka_sink_options

QUARANTINE = "quarantine"


def folder_exists(spark: SparkSession, path: str) -> bool:
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jp.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jp)


def make_folder(spark: SparkSession, path: str) -> None:
    """A file topic is a folder; one that nothing was sent to yet can still be read."""
    jp = spark._jvm.org.apache.hadoop.fs.Path(path)
    jp.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(jp)


@dataclass
class BatchSinks:
    """``topics``: output name -> folder (files) or Kafka topic; a name missing there is not written."""

    topics: Mapping[str, str]
    checkpoint: str
    fmt: str = "files"
    kafka_servers: str | None = None
    kafka_options: Mapping[str, str] | None = None
    _query: str | None = field(default=None, init=False)

    def query_id(self, spark: SparkSession) -> str:
        """The query's id, as its checkpoint keeps it."""
        if self._query is None:
            self._query = spark.read.json(f"{self.checkpoint}/metadata").first()["id"]
        return self._query

    def folder(self, spark: SparkSession, name: str, batch_id: int) -> str:
        return f"{self.topics[name].rstrip('/')}/{self.query_id(spark)}-b{int(batch_id):012d}"

    def done(self, spark: SparkSession, batch_id: int) -> bool:
        return self.fmt == "files" and all(
            folder_exists(spark, f"{self.folder(spark, n, batch_id)}/_SUCCESS") for n in self.topics)

    def write(self, batch_id: int, outputs: Mapping[str, tuple[str | None, DataFrame]]) -> None:
        """``outputs``: name -> (record kind, rows); kind None: rows are (key, value, reason)."""
        for name, (kind, rows) in outputs.items():
            if name not in self.topics:
                continue
            if kind is None:
                rows = rows.select("key", F.to_json(F.struct("value", "reason")).alias("value"))
            else:
                rows = encode(rows, kind)
            if self.fmt == "kafka":
                options = kafka_sink_options(self.topics[name], self.kafka_servers, self.kafka_options)
                rows.write.format("kafka").options(**options).save()
            else:
                rows.select("value").write.mode("overwrite").text(self.folder(rows.sparkSession, name, batch_id))


def consume(batch: DataFrame) -> None:
    """Run a micro-batch without emitting it."""
    batch.write.format("noop").mode("overwrite").save()


def start(stream: DataFrame, sink, checkpoint: str, available_now: bool, interval: str = "1 second"):
    """Start a query that hands its micro-batches to ``sink``."""
    w = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()

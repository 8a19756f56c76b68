"""File sources and sinks: question CSV, bulk JSON import, append-only CSV log.

All three are plain DataFrame reads/writes, so they split across executors by
file blocks and never pass rows through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.sources.csv_records import read_csv_records

# The id columns tried in order, and the question fields kept.
CSV_ID_COLUMNS = ("id", "_id")
CSV_QUESTION_FIELDS = ("question_title", "question_content", "best_answer")
_DIALECT = {"header": True, "multiLine": True, "quote": '"', "escape": '"', "emptyValue": ""}
TRAFFIC_LOG_COLUMNS = ("timestamp", "operation", "message_id", "question_id", "status", "latency", "topic")


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names from the header line (read as one small text row)."""
    first = spark.read.options(**_DIALECT).option("inferSchema", False).csv(path).limit(0)
    return list(first.columns)


def load_questions_csv(spark: SparkSession, path: str) -> DataFrame:
    """Question CSV with a header line -> (_id, question_title, question_content, best_answer).

    The id is the first non-empty of ``id`` and ``_id``; rows without one are
    dropped.  Columns absent from the header read as ""; a short row keeps
    NULL in its missing fields, an empty field is "".  Quoted fields may hold
    commas, line ends and doubled quotes.  Surplus fields of a row are dropped,
    so an unquoted comma cuts the last field, as a dict reader with a fixed header
    does.  A file splits over tasks wherever it is cut (``read_csv_records``).
    """
    cols = _header(spark, path)
    df = read_csv_records(spark, path, cols)
    ids = [F.when(F.col(c) != "", F.col(c)) for c in CSV_ID_COLUMNS if c in cols]
    qid = F.coalesce(*ids) if ids else F.lit(None).cast("string")
    fields = [(F.col(c) if c in cols else F.lit("")).alias(c) for c in CSV_QUESTION_FIELDS]
    return df.select(qid.alias("_id"), *fields).filter(F.col("_id").isNotNull())


def import_json_if_absent(spark: SparkSession, source: str, target: str, fmt: str = "parquet") -> bool:
    """Bulk-import a JSON-lines file into a table only when the table does not exist yet.

    Returns True when an import happened.  ``mode("ignore")`` makes the
    existence check and the write one step, so a second run is a no-op.
    """
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    existed = fs.exists(jvm_path)
    if existed:
        return False
    spark.read.json(source).write.mode("ignore").format(fmt).save(target)
    return True


def append_csv_log(rows: DataFrame, path: str) -> None:
    """Append log rows to a CSV folder; every part file carries the header line."""
    rows.select(*TRAFFIC_LOG_COLUMNS).write.mode("append").option("header", True).csv(path)


def read_csv_log(spark: SparkSession, path: str) -> DataFrame:
    """Read a traffic log folder written by ``append_csv_log``."""
    schema = T.StructType([
        T.StructField("timestamp", T.StringType()), T.StructField("operation", T.StringType()),
        T.StructField("message_id", T.StringType()), T.StructField("question_id", T.StringType()),
        T.StructField("status", T.StringType()), T.StructField("latency", T.DoubleType()),
        T.StructField("topic", T.StringType()),
    ])
    return spark.read.option("header", True).schema(schema).csv(path) \
        .withColumn("timestamp", F.to_timestamp("timestamp"))

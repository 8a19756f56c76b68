"""JSON message encode / decode / validate as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from verity.functions.ids import derived_id, now_iso
from verity.sources.schemas import DEFAULTS, GENERATED, REQUIRED, SCHEMAS

_CORRUPT = "_corrupt_record"

# Fixed value: status of a rejected score request.
INVALID_PAYLOAD = "invalid_payload"
VALID_PAYLOAD = "ok"
NOT_AN_OBJECT = "not a JSON object"


def encode(df: DataFrame, kind: str, key: str = "message_id") -> DataFrame:
    """Record -> (key, value) with every field of the record kind, nulls kept."""
    schema = SCHEMAS[kind]
    value = F.to_json(F.struct(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]),
                      {"ignoreNullFields": "false"})
    return df.select(F.col(key).cast("string").alias("key"), value.alias("value"))


def decode(df: DataFrame, kind: str, value: str = "value", keep: tuple[str, ...] = ("key",),
           stamp: bool = False) -> DataFrame:
    """JSON -> typed columns of ``kind``; absent fields take the record's defaults.

    Fields are read as text and cast, so loose JSON types pass (``"2"`` is a
    2).  Adds ``valid`` and ``reason``: NULL, ``not a JSON object``,
    ``missing <field>`` (a required field is absent) or ``bad <field>`` (a
    value that does not cast).  Fields of invalid rows stay NULL; nothing is
    dropped here, so the rest can go to a quarantine (``split_valid``).

    ``stamp=True`` also defaults ids and times (``GENERATED``): times to now, ids derived
    from the raw value, so a replayed message gets the same id.
    """
    schema = SCHEMAS[kind]
    defaults = DEFAULTS.get(kind, {})
    required = REQUIRED.get(kind, ())
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    # One parse: a JSON object gives a struct with no corrupt text; malformed
    # text, arrays, scalars and null are captured as corrupt (or give NULL).
    with_corrupt = T.StructType(text.fields + [T.StructField(_CORRUPT, T.StringType())])
    parsed = df.withColumn("_j", F.from_json(F.col(value), with_corrupt, {"columnNameOfCorruptRecord": _CORRUPT}))
    reason = F.when(F.col("_j").isNull() | F.col(f"_j.{_CORRUPT}").isNotNull(), NOT_AN_OBJECT)
    typed = {}
    for f in schema.fields:
        raw = F.col("_j").getField(f.name)
        typed[f.name] = raw if isinstance(f.dataType, T.StringType) else raw.try_cast(f.dataType)
        if f.name in required:
            reason = reason.when(raw.isNull(), f"missing {f.name}")
        if not isinstance(f.dataType, T.StringType):
            reason = reason.when(raw.isNotNull() & typed[f.name].isNull(), f"bad {f.name}")
    parsed = parsed.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull())
    cols = []
    for f in schema.fields:
        c = typed[f.name]
        if f.name in defaults:
            c = F.coalesce(c, F.lit(defaults[f.name]).cast(f.dataType))
        elif stamp and GENERATED.get(f.name) == "id":
            c = F.coalesce(c, derived_id(value, namespace=f.name))
        elif stamp and GENERATED.get(f.name) == "time":
            c = F.coalesce(F.when(F.try_to_timestamp(c).isNotNull(), c), now_iso())
        cols.append(F.when(F.col("valid"), c).alias(f.name))
    return parsed.select(*keep, *cols, "valid", "reason")


def split_valid(decoded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantine): the second keeps ``key``, ``value`` and ``reason`` of every other row."""
    good = decoded.filter(F.col("valid")).drop("valid", "reason", "value")
    return good, decoded.filter(~F.col("valid")).select("key", "value", "reason")


def validate_score_requests(df: DataFrame, value: str = "value",
                            keep: tuple[str, ...] = ("key",)) -> DataFrame:
    """Score requests: a JSON object with a ``question_id`` is ``ok``, else ``invalid_payload``.

    The id is read as a string whatever its JSON type; answers default to "".
    Rejected rows stay in the output with their status, so they can be
    written to a quarantine sink instead of stopping the job.
    """
    d = decode(df, "score_request", value, keep)
    ok = F.col("valid")
    return d.select(
        *keep,
        F.when(ok, F.col("question_id")).alias("question_id"),
        F.when(ok, F.col("best_answer")).alias("best_answer"),
        F.when(ok, F.col("llm_answer")).alias("llm_answer"),
        F.when(ok, F.lit(VALID_PAYLOAD)).otherwise(F.lit(INVALID_PAYLOAD)).alias("status"),
    )

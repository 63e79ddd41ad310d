"""The event stream: subscribe, decode, and set undecodable messages aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from accountwatch.schemas import RAW_EVENT

_REJECT = "__reject"


def read_events_stream(
    spark: SparkSession, servers: str, topic: str, starting: str | None = None, **options: str
) -> DataFrame:
    """Messages of one topic, one at a time since the subscription.

    Needs the public spark-sql-kafka package on the session. ``starting`` is
    'latest', 'earliest' or an offset map; left out, Spark's default applies.
    """
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    if starting is not None:
        reader = reader.option("startingOffsets", starting)
    return reader.options(**options).load()


def read_event_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same messages from text files, one JSON object per line, for replay and tests."""
    reader = spark.readStream.format("text")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def _text() -> Column:
    return F.col("value").cast("string")


def parse_events(raw: DataFrame, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """``value`` to the declared fields; unknown fields vanish, a bad message is a row of nulls."""
    return raw.select(F.from_json(_text(), schema).alias("event")).select("event.*")


def parsed_once(raw: DataFrame, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """The columns beside ``value``, the declared fields and, where they could not be read in full, the ``message``."""
    checked = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT}
    others = [c for c in raw.columns if c != "value"]
    parsed = raw.select(*others, _text().alias("__text"), F.from_json(_text(), checked, options).alias("event"))
    message = F.when(F.col(f"event.{_REJECT}").isNotNull(), F.col("__text")).alias("message")
    return parsed.select(*others, message, *[F.col(f"event.{name}") for name in schema.names])


def rejected_events(raw: DataFrame, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """The messages ``parse_events`` could not read in full, as ``message``."""
    checked = T.StructType([*schema.fields, T.StructField(_REJECT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECT}
    reject = F.from_json(_text(), checked, options)[_REJECT]
    return raw.filter(reject.isNotNull()).select(_text().alias("message"))

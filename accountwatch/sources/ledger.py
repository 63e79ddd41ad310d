"""Which messages a routed stream has stored, by their places in the source.

Every stored batch has an entry: its run, its number and, for each partition of the source,
the first and last place it holds. A batch without an entry does not count; readers
leave it out and a later run reads its messages again. A new run, started for whatever
reason and from wherever, leaves out the messages that entries of earlier runs cover.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTRY = "run_id string, batch_id long, source string, low long, high long, messages long"
_RANGES = "source string, low long, high long"


def read_or_empty(spark: SparkSession, path: str, schema: str, base: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema)
    try:
        return (reader.option("basePath", base) if base else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def positioned(raw: DataFrame) -> DataFrame:
    """``value`` with its ``source`` and ``position``: topic partition and offset, or the file, which is read whole."""
    if {"topic", "partition", "offset"} <= set(raw.columns):
        source = F.concat_ws("-", "topic", F.col("partition").cast("string"))
        return raw.select("value", source.alias("source"), F.col("offset").alias("position"))
    return raw.select("value", F.col("_metadata.file_path").alias("source"), F.lit(0).cast("long").alias("position"))


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, f"{root}/ledger", ENTRY, f"{root}/ledger")


def entry_of(rows: DataFrame) -> DataFrame:
    """The places of a batch; one row for each partition of the source."""
    return rows.groupBy("source").agg(F.min("position").alias("low"), F.max("position").alias("high"), F.count("*").alias("messages"))


def covered(entries: DataFrame) -> DataFrame:
    """The stored places as ranges that do not touch, however many batches they came in."""
    by_place = Window.partitionBy("source").orderBy("low", "high")
    before = F.max("high").over(by_place.rowsBetween(Window.unboundedPreceding, -1))
    opens = (before.isNull() | (F.col("low") > before + 1)).cast("int")
    islands = entries.withColumn("__opens", opens).withColumn("__island", F.sum("__opens").over(by_place))
    return islands.groupBy("source", "__island").agg(F.min("low").alias("low"), F.max("high").alias("high")).drop("__island")


def without_covered(messages: DataFrame, ranges: DataFrame) -> DataFrame:
    """Messages at places that are not stored yet."""
    taken = ranges.select(F.col("source").alias("__source"), F.col("low").alias("__low"), F.col("high").alias("__high"))
    held = (F.col("source") == F.col("__source")) & F.col("position").between(F.col("__low"), F.col("__high"))
    return messages.join(taken, held, "left_anti")


def committed(spark: SparkSession, root: str, name: str, schema: str) -> DataFrame:
    """The rows of one output from all batches that have an entry, with their run and batch."""
    rows = read_or_empty(spark, f"{root}/{name}", f"{schema}, run_id string, batch_id long", f"{root}/{name}")
    return rows.join(read_ledger(spark, root).select("run_id", "batch_id").distinct(), ["run_id", "batch_id"], "left_semi")


def store_ranges(spark: SparkSession, root: str, run_id: str) -> str:
    """What earlier runs have stored, written once at the start of a run; the folder."""
    path = f"{root}/covered/run_id={run_id}"
    covered(read_ledger(spark, root).where(F.col("run_id") != run_id)).write.mode("overwrite").parquet(path)
    return path


def read_ranges(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_RANGES).parquet(path)

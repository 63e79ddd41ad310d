"""The ticket library, the knowledge base and the exported report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accountwatch.lanes import Lane
from accountwatch.schemas import KNOWLEDGE_BASE, TICKET_LIBRARY


def read_ticket_library(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of category, support_text and suggested_csat; a hand-written dimension."""
    return spark.read.schema(TICKET_LIBRARY).json(path, multiLine=True)


def load_knowledge_base(entries: DataFrame, path: str) -> None:
    """Append policies with the embeddings their author supplies."""
    entries.select(*KNOWLEDGE_BASE.names).write.mode("append").parquet(path)


def read_knowledge_base(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(KNOWLEDGE_BASE).parquet(path)


def export_actioned(rows: DataFrame, path: str) -> None:
    """CSV with a header in every part file; parts are as many as the rows need."""
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def store_by_key(rows: DataFrame, lane: Lane, table: str, path: str, buckets: int = 64) -> DataFrame:
    """A lane or its change log as a table in buckets of the change key, sorted within; the stored table.

    Tables with the same number of buckets meet without a shuffle. Each task
    writes the one file of a bucket. Choose the number so that a bucket fits a task.
    """
    keys = list(lane.change_key)
    writer = rows.repartition(buckets, *keys).write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table)
    return rows.sparkSession.table(table)

"""Late events of a windowed lane: kept as an output, and corrected.

Append mode drops an event whose window the watermark has closed. A second, stateless
stream over the same events stores such events by themselves, with a watermark of its own:
the latest event time so far, stored with each batch, less the lane's delay. An event is
``certain`` to be late if the batches before closed its window. One that only its own batch
did is stored too: the lane's stream, in smaller batches, may have dropped it. A
correction then recounts the windows that these events fall into, from all events of those
accounts and that span, and stores the counts under a run that outranks the lane's.
Windows that nothing late fell into stay as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accountwatch.config import DEFAULT, RiskConfig
from accountwatch.lanes import CHURN, LOOPS, Lane
from accountwatch.operators import detect
from accountwatch.sources.lanes import BatchWriter, new_run_id, parquet_sink
from accountwatch.sources.ledger import read_or_empty
from accountwatch.streaming.lanes import qualifying

_CLOCK = "latest long, run_id string, batch_id long"
_SUBJECT = {LOOPS.name: ("account_id", "category", "mrr"), CHURN.name: ("account_id", "mrr")}


def late_pairs(events: DataFrame, lane: Lane, cfg: RiskConfig, before: int | None, latest: int | None) -> DataFrame:
    """Events with a window that is closed: one row for each such window. Times are microseconds, none is null."""

    def closed(time: int | None) -> Column:
        mark = F.timestamp_micros(F.lit(time).cast("long")) - F.expr(f"interval {cfg.watermark}")
        return F.coalesce(F.col("window_end") <= mark, F.lit(False))

    pairs = qualifying(events, cfg, lane).withColumn("__window", detect.event_window(cfg)).select(
        *_SUBJECT[lane.name],
        "event_timestamp",
        F.col("__window.start").alias("window_start"),
        F.col("__window.end").alias("window_end"),
    )
    return pairs.where(closed(latest)).withColumn("certain", closed(before))


def late_watch(root: str, run_id: str, lane: Lane, cfg: RiskConfig = DEFAULT) -> BatchWriter:
    """Stores the late events of a batch, then the latest time so far. A batch delivered again replaces both."""
    clocks: dict[int, int | None] = {}

    def stored(spark: SparkSession, batch_id: int) -> int | None:
        """The latest time before a batch: what this run has noted, or at its start what any run has stored."""
        if batch_id - 1 in clocks:
            return clocks[batch_id - 1]
        path = f"{root}/{lane.name}-clock"
        own = (F.col("run_id") == run_id) & (F.col("batch_id") >= batch_id)
        return read_or_empty(spark, path, _CLOCK, path).where(~own).agg(F.max("latest")).first()[0]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark, place = batch.sparkSession, f"run_id={run_id}/batch_id={batch_id}"
        before = stored(spark, batch_id)
        now = qualifying(batch, cfg, lane).agg(F.max(F.unix_micros("event_timestamp"))).first()[0]
        latest = max((t for t in (before, now) if t is not None), default=None)
        late_pairs(batch, lane, cfg, before, latest).write.mode("overwrite").parquet(f"{root}/{lane.name}-late/{place}")
        clock = spark.range(1).select(F.lit(latest).cast("long").alias("latest"))
        clock.coalesce(1).write.mode("overwrite").parquet(f"{root}/{lane.name}-clock/{place}")
        clocks.clear()
        clocks[batch_id] = latest

    return write


def start_late_watch(
    events: DataFrame, lane: Lane, root: str, checkpoint: str, cfg: RiskConfig = DEFAULT, run_id: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """The stream that stores late events of a lane; ``events`` carries event_timestamp, as the lane's own stream has it."""
    watch = late_watch(root, run_id or new_run_id(), lane, cfg)
    writer = events.writeStream.queryName(f"{lane.name}-late").option("checkpointLocation", checkpoint).foreachBatch(watch)
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_late(spark: SparkSession, root: str, lane: Lane) -> DataFrame:
    """The late events of a lane, one row for each closed window they belong to."""
    return spark.read.parquet(f"{root}/{lane.name}-late").drop("run_id", "batch_id")


def correct_lane(spark: SparkSession, root: str, lane: Lane, events: DataFrame, cfg: RiskConfig = DEFAULT, run_id: str | None = None) -> None:
    """Recounts the windows of late events from ``events``, all of them in batch form, and stores the counts.

    Only events of the accounts and the span concerned are read, with the span pushed to the scan.
    Counts are stored with no bound, so that a window that no longer qualifies outranks its
    alert; ``read_early_lane`` applies the bounds.
    """
    keys = [*_SUBJECT[lane.name], "window_start"]
    late = read_late(spark, root, lane)
    windows = late.select(*keys).distinct()
    first, last = late.agg(F.min("window_start"), F.max("window_end")).first()
    if first is None:
        return
    span = (F.col("event_timestamp") >= F.lit(first)) & (F.col("event_timestamp") < F.lit(last))
    counted = {LOOPS.name: detect.ticket_counts, CHURN.name: detect.usage_counts}[lane.name]
    accounts = windows.select("account_id").distinct()
    of_accounts = events.where(span).join(accounts, events["account_id"].eqNullSafe(accounts["account_id"]), "left_semi")
    counts = counted(of_accounts, cfg)
    same = [counts[key].eqNullSafe(windows[key]) for key in keys]
    touched = counts.join(windows, same, "left_semi")
    parquet_sink(root, run_id or new_run_id())(lane)(touched, 0)

"""One stream that reads and parses every message once and deals it out.

A micro-batch is parsed once, with the text of what could not be read in full, and stored
under one batch id as the event log, the rejects, the ticket alerts, and what it adds to
the counts of loops and churn: additive counts by window, with no state between batches.
Readers add them up over the batches of the ledger. So nothing depends on the
stream's checkpoint but its place in the source: after a lost one a new run starts where it
is told to, leaves out what is stored, and the sums go on. Late events are added to
their windows like others.

One router of a source runs at a time, each start under a new run id; a batch that is
delivered again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from accountwatch.config import DEFAULT, RiskConfig
from accountwatch.lanes import CHURN, LOOPS, TICKETS, Lane
from accountwatch.operators import detect
from accountwatch.schemas import RAW_EVENT
from accountwatch.sources import ledger
from accountwatch.sources.events import parsed_once
from accountwatch.sources.lanes import BatchWriter, new_run_id, newest_rows

LOG, REJECTS = "log", "rejects"
_PLACE = "source string, position long"


def _fields(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


_WINDOW = "window_start timestamp, window_end timestamp"
#: Declared columns of the additive counts.
ADDED = {
    LOOPS.name: "account_id string, category string, mrr double, incident_count long, event_summary string, "
    f"first_at timestamp, first_id string, {_WINDOW}",
    CHURN.name: f"account_id string, mrr double, login_count long, feature_count long, {_WINDOW}",
}


def outputs(rows: DataFrame, cfg: RiskConfig = DEFAULT) -> dict[str, DataFrame]:
    """What one parsed batch is dealt out to."""
    events = rows.drop("source", "position", "message")
    timed = detect.with_event_time(events)
    return {
        LOG: rows.drop("message"),
        REJECTS: rows.where("message is not null").select("source", "position", "message"),
        TICKETS.name: detect.ticket_alerts(events, cfg),
        LOOPS.name: detect.added_tickets(timed, cfg),
        CHURN.name: detect.usage_counts(timed, cfg),
    }


def batch_router(root: str, run_id: str, ranges: str, cfg: RiskConfig = DEFAULT, schema: T.StructType = RAW_EVENT) -> BatchWriter:
    """Stores one batch of ``positioned`` messages. The ledger entry comes last and makes it count."""

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        fresh = ledger.without_covered(batch, ledger.read_ranges(spark, ranges))
        rows = parsed_once(fresh, schema).persist()
        try:
            for name, part in {**outputs(rows, cfg), "ledger": ledger.entry_of(rows)}.items():
                part.write.mode("overwrite").parquet(f"{root}/{name}/run_id={run_id}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return write


def start_router(
    raw: DataFrame, root: str, checkpoint: str, cfg: RiskConfig = DEFAULT, run_id: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """The routed stream over raw messages, as ``read_events_stream`` or ``read_event_files`` gives them."""
    run_id = run_id or new_run_id()
    ranges = ledger.store_ranges(raw.sparkSession, root, run_id)
    writer = ledger.positioned(raw).writeStream.queryName("router").option("checkpointLocation", checkpoint).foreachBatch(batch_router(root, run_id, ranges, cfg))
    return (writer.trigger(**trigger) if trigger else writer).start()


def read_log(spark: SparkSession, root: str, schema: T.StructType = RAW_EVENT) -> DataFrame:
    """Every stored message as ``parse_events`` reads it, once."""
    return ledger.committed(spark, root, LOG, f"{_PLACE}, {_fields(schema)}").select(*schema.names)


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """The messages that could not be read in full, as ``rejected_events`` has them."""
    return ledger.committed(spark, root, REJECTS, f"{_PLACE}, message string").select("message")


def read_tickets(spark: SparkSession, root: str) -> DataFrame:
    schema = f"{_fields(RAW_EVENT)}, priority_score double"
    return newest_rows(ledger.committed(spark, root, TICKETS.name, schema), TICKETS)


def read_counts(spark: SparkSession, root: str, lane: Lane) -> DataFrame:
    """Counts of every window so far: what the batches have added, summed."""
    added = ledger.committed(spark, root, lane.name, ADDED[lane.name])
    return {LOOPS.name: detect.summed_tickets, CHURN.name: detect.summed_usage}[lane.name](added)


def read_alerts(spark: SparkSession, root: str, lane: Lane, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The current alerts of a lane; those of windows still open may yet change."""
    if lane is TICKETS:
        return read_tickets(spark, root)
    counts = read_counts(spark, root, lane)
    return {LOOPS.name: detect.enough_incidents, CHURN.name: detect.no_feature_use}[lane.name](counts, cfg)

"""Start, watch and read the three detection queries.

``append`` (the default) stores a window once, after it has closed. ``update``
stores every change of a window as an early alert; the count thresholds then
apply when the lane is read, so an account that uses a feature after its logins
disappears again.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from accountwatch.config import DEFAULT, RiskConfig
from accountwatch.lanes import CHURN, LANES, LOOPS, TICKETS, Lane
from accountwatch.operators import detect
from accountwatch.sources.lanes import Sink, read_lane

_COUNTED = {LOOPS.name: detect.ticket_counts, CHURN.name: detect.usage_counts}
_THRESHOLD = {LOOPS.name: detect.enough_incidents, CHURN.name: detect.no_feature_use}


def qualifying(events: DataFrame, cfg: RiskConfig, lane: Lane) -> DataFrame:
    """The events that can count in a lane and that move its watermark."""
    events = events.filter(F.col("mrr") >= cfg.min_mrr)
    return events.filter(F.col("event_type") == cfg.ticket_type) if lane is LOOPS else events


def watermarked(events: DataFrame, cfg: RiskConfig, lane: Lane) -> DataFrame:
    """Event time with a watermark that only the lane's qualifying events move.

    Spark pushes these filters below the watermark anyway; stating them here
    makes the lateness rule independent of the optimizer.
    """
    return qualifying(events, cfg, lane).withWatermark("event_timestamp", cfg.watermark)


def lane_stream(events: DataFrame, lane: Lane, cfg: RiskConfig = DEFAULT, mode: str = "append") -> DataFrame:
    """The streaming frame of one lane; ``events`` carries event_timestamp."""
    if lane is TICKETS:
        return detect.ticket_alerts(events, cfg).drop("event_timestamp")
    counts = _COUNTED[lane.name](watermarked(events, cfg, lane), cfg)
    return counts if mode == "update" else _THRESHOLD[lane.name](counts, cfg)


def start_lane(
    events: DataFrame,
    lane: Lane,
    sink: Sink,
    checkpoint_root: str,
    cfg: RiskConfig = DEFAULT,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    writer = (
        lane_stream(events, lane, cfg, mode)
        .writeStream.queryName(lane.name)
        .outputMode("append" if lane is TICKETS else mode)
        .option("checkpointLocation", f"{checkpoint_root}/{lane.name}")
        .foreachBatch(sink(lane))
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def start_lanes(
    events: DataFrame,
    sink: Sink,
    checkpoint_root: str,
    cfg: RiskConfig = DEFAULT,
    mode: str = "append",
    trigger: dict | None = None,
) -> dict[str, StreamingQuery]:
    """One query per lane, each with its own checkpoint and its own pace."""
    started: dict[str, StreamingQuery] = {}
    try:
        for lane in LANES:
            started[lane.name] = start_lane(events, lane, sink, checkpoint_root, cfg, mode, trigger)
    except Exception:
        for query in started.values():
            query.stop()
        raise
    return started


def await_lanes(queries: dict[str, StreamingQuery], poll_seconds: float = 0.2) -> None:
    """Wait until every query has ended; when one fails, stop the others and raise."""
    try:
        while any(query.isActive for query in queries.values()):
            for query in queries.values():
                if query.exception() is not None:
                    query.awaitTermination()
            time.sleep(poll_seconds)
        for query in queries.values():
            query.awaitTermination()
    finally:
        for query in queries.values():
            query.stop()


def read_early_lane(spark: SparkSession, root: str, lane: Lane, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """The current alerts of a lane that was written in update mode."""
    return current_alerts(read_lane(spark, root, lane), lane, cfg)


def current_alerts(rows: DataFrame, lane: Lane, cfg: RiskConfig = DEFAULT) -> DataFrame:
    """What counts as an alert among the newest rows of a lane, from whichever store they were read."""
    return rows if lane is TICKETS else _THRESHOLD[lane.name](rows, cfg)

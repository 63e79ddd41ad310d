"""Streams against the batch answer: closed windows, replay, restart, late rows, retraction."""

import itertools
import json
import time

import pytest
from helpers import DEFAULTS, T0, logins_at, tickets_at
from pyspark.errors import StreamingQueryException

from accountwatch import CHURN, DEFAULT, LOOPS, TICKETS
from accountwatch.operators import detect
from accountwatch.sources import lanes as store
from accountwatch.sources.events import parse_events, read_event_files
from accountwatch.streaming import lanes as streaming
from accountwatch.streaming import late
from accountwatch.streaming.__main__ import arguments, main

_IDS = itertools.count()


class Topic:
    """A folder of message files; each ``send`` is one micro-batch."""

    def __init__(self, root):
        self.root, self.sent = root / "topic", []
        self.root.mkdir()
        self.lanes, self.checkpoints = str(root / "lanes"), str(root / "checkpoints")

    def send(self, rows):
        rows = [{"event_id": f"e-{next(_IDS):06d}", **DEFAULTS, **row} for row in rows]
        self.sent += rows
        hidden = self.root / f".{len(self.sent)}-{next(_IDS)}"
        hidden.write_text("".join(json.dumps(r) + "\n" for r in rows))
        # A visible name appears only once the file is whole.
        hidden.rename(self.root / hidden.name[1:])
        time.sleep(0.02)

    def stream(self, spark):
        return detect.with_event_time(parse_events(read_event_files(spark, str(self.root), files_per_trigger=1)))

    def batch(self, spark):
        return detect.with_event_time(parse_events(spark.read.text(str(self.root))))

    def run(self, spark, lane, mode="append", run_id="run-1", sink=None):
        sink = sink or store.parquet_sink(self.lanes, run_id)
        query = streaming.start_lane(
            self.stream(spark), lane, sink, self.checkpoints, DEFAULT, mode, trigger={"availableNow": True}
        )
        streaming.await_lanes({lane.name: query})
        return query


@pytest.fixture
def topic(tmp_path):
    return Topic(tmp_path)


def rows(df, *columns):
    columns = columns or sorted(df.columns)
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


CLOSER = tickets_at(600) + tickets_at(600, event_type="login", category="N/A", csat_score=3)


@pytest.mark.parametrize("files", [1, 2, 5])
def test_append_equals_batch_for_closed_windows(spark, topic, files):
    burst = tickets_at(5, 6, 7, 8, 58, 59, 60, 61) + logins_at(*range(10, 40, 5), account_id="Quiet")
    burst.sort(key=lambda r: r["timestamp"])
    size = -(-len(burst) // files)
    for start in range(0, len(burst), size):
        topic.send(burst[start : start + size])
    topic.send(CLOSER)
    closed = f"window_end <= timestamp_seconds({T0 + 600 - 60})"
    for lane, detector in ((LOOPS, detect.friction_loops), (CHURN, detect.silent_churners)):
        topic.run(spark, lane)
        got = rows(store.read_lane(spark, topic.lanes, lane))
        assert got == rows(detector(topic.batch(spark)).filter(closed)) and got
    topic.run(spark, TICKETS)
    want = detect.ticket_alerts(topic.batch(spark)).drop("event_timestamp")
    assert rows(store.read_lane(spark, topic.lanes, TICKETS)) == rows(want)


def test_restart_goes_on_where_it_stopped(spark, topic):
    topic.send(tickets_at(5, 6))
    topic.run(spark, LOOPS)
    topic.send(tickets_at(7, 8))
    topic.run(spark, LOOPS)
    topic.send(CLOSER)
    topic.run(spark, LOOPS)
    assert rows(store.read_lane(spark, topic.lanes, LOOPS), "incident_count") == [("4",), ("4",)]


def test_late_rows_are_dropped(spark, topic):
    topic.send(logins_at(5, 6, 7, 8, 9))
    topic.send(logins_at(600))
    topic.send(logins_at(601))  # a new watermark rejects rows one batch later
    topic.send(tickets_at(10, event_type="feature_access"))
    query = topic.run(spark, CHURN)
    dropped = sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])
    assert dropped > 0
    assert rows(store.read_lane(spark, topic.lanes, CHURN), "login_count") == [("5",), ("5",)]


def test_events_below_the_revenue_bound_do_not_move_the_watermark(spark, topic):
    topic.send(logins_at(5, 6, 7, 8, 9))
    topic.send(logins_at(600, mrr=500.0))
    topic.send(logins_at(601, mrr=500.0))
    topic.send(tickets_at(10, event_type="feature_access"))
    topic.send(logins_at(1200))
    topic.run(spark, CHURN)
    assert store.read_lane(spark, topic.lanes, CHURN).count() == 0


def test_other_event_types_move_the_watermark(spark, topic):
    topic.send(logins_at(5, 6, 7, 8, 9))
    topic.send(tickets_at(600, event_type="dashboard_view"))
    topic.run(spark, CHURN)
    assert store.read_lane(spark, topic.lanes, CHURN).count() == 2


def test_update_mode_takes_an_early_alert_back(spark, topic):
    topic.send(logins_at(5, 6, 7, 8, 9) + logins_at(5, 6, 7, 8, 9, account_id="Quiet"))
    topic.run(spark, CHURN, "update")
    assert streaming.read_early_lane(spark, topic.lanes, CHURN).count() == 4
    topic.send(tickets_at(30, event_type="feature_access"))
    topic.run(spark, CHURN, "update")
    early = streaming.read_early_lane(spark, topic.lanes, CHURN)
    assert {r["account_id"] for r in early.collect()} == {"Quiet"}
    assert rows(early) == rows(detect.silent_churners(topic.batch(spark)))


def test_update_mode_keeps_the_newest_count(spark, topic):
    for s in (5, 6, 7, 8):
        topic.send(tickets_at(s))
    topic.run(spark, LOOPS, "update")
    assert rows(streaming.read_early_lane(spark, topic.lanes, LOOPS)) == rows(detect.friction_loops(topic.batch(spark)))


def test_lost_checkpoint_starts_a_new_run(spark, topic):
    topic.send(tickets_at(5, 6, 7, 8))
    topic.run(spark, LOOPS, "update")
    before = rows(streaming.read_early_lane(spark, topic.lanes, LOOPS))
    topic.checkpoints += "-new"
    topic.run(spark, LOOPS, "update", run_id="run-2")
    assert rows(streaming.read_early_lane(spark, topic.lanes, LOOPS)) == before


def test_three_lanes_together(spark, topic):
    topic.send(tickets_at(5, 6, 7, 8) + logins_at(*range(10, 16), account_id="Quiet"))
    topic.send(CLOSER)
    sink = store.parquet_sink(topic.lanes, "run-1", files_per_batch=1)
    started = streaming.start_lanes(topic.stream(spark), sink, topic.checkpoints, trigger={"availableNow": True})
    streaming.await_lanes(started)
    counts = {lane.name: store.read_lane(spark, topic.lanes, lane).count() for lane in (TICKETS, LOOPS, CHURN)}
    assert counts == {"tickets": 5, "loops": 2, "churn": 2}


def test_one_failure_stops_all(spark, topic):
    topic.send(tickets_at(5, 6, 7, 8))

    def sink(lane):
        def write(batch, batch_id):
            if lane is LOOPS:
                raise RuntimeError("disk full")

        return write

    started = streaming.start_lanes(topic.stream(spark), sink, topic.checkpoints)
    with pytest.raises(StreamingQueryException, match="disk full"):
        streaming.await_lanes(started)
    assert not any(query.isActive for query in started.values())


def test_command_line(spark, topic):
    topic.send(tickets_at(5, 6, 7, 8))
    topic.send(CLOSER)
    main(["--files", str(topic.root), "--lanes", topic.lanes, "--checkpoints", topic.checkpoints, "--once"])
    assert store.read_lane(spark, topic.lanes, LOOPS).count() == 2
    with pytest.raises(SystemExit):
        arguments(["--topic", "events", "--console", "--checkpoints", "x"])


def watched(spark, topic, lane, mode="append"):
    topic.run(spark, lane, mode)
    query = late.start_late_watch(topic.stream(spark), lane, topic.lanes, f"{topic.checkpoints}/late", trigger={"availableNow": True})
    streaming.await_lanes({"late": query})


def test_late_rows_are_kept_and_corrected(spark, topic):
    """Late logins complete a window, a late feature use takes another one's alert back, the rest stays."""
    topic.send(logins_at(5, 6, 7, 8, 9) + logins_at(5, 6, 7, account_id="Quiet") + logins_at(5, 6, 7, 8, 9, account_id="Left"))
    topic.send(logins_at(600))
    topic.send(logins_at(601))
    topic.send(tickets_at(10, event_type="feature_access") + logins_at(10, 11, account_id="Quiet"))
    topic.send(logins_at(1200))
    watched(spark, topic, CHURN)
    found = late.read_late(spark, topic.lanes, CHURN)
    assert sorted(r.account_id for r in found.where("certain").collect()) == ["Acme"] * 2 + ["Quiet"] * 4
    stream = {r.account_id for r in streaming.read_early_lane(spark, topic.lanes, CHURN).collect()}
    assert stream == {"Acme", "Left"}
    late.correct_lane(spark, topic.lanes, CHURN, topic.batch(spark))
    closed = f"window_end <= timestamp_seconds({T0 + 1200 - 60})"
    want = rows(detect.silent_churners(topic.batch(spark)).filter(closed))
    assert rows(streaming.read_early_lane(spark, topic.lanes, CHURN)) == want
    assert {row[0] for row in want} == {"Left", "Quiet"}


def test_a_watch_goes_on_over_restarts(spark, topic):
    """The clock is stored: after a restart, earlier events are late at once, also without a checkpoint."""
    topic.send(tickets_at(600))
    watched(spark, topic, LOOPS)
    assert late.read_late(spark, topic.lanes, LOOPS).count() == 0
    topic.checkpoints += "-new"
    topic.send(tickets_at(5, 6, 7, category=None) + tickets_at(599))
    watched(spark, topic, LOOPS)
    found = late.read_late(spark, topic.lanes, LOOPS)
    assert found.where("certain").count() == 6 and found.where("category is null").count() == 6
    late.correct_lane(spark, topic.lanes, LOOPS, topic.batch(spark))
    early = streaming.read_early_lane(spark, topic.lanes, LOOPS)
    assert rows(early) == rows(detect.friction_loops(topic.batch(spark))) and early.count() == 2


def test_nothing_late_corrects_nothing(spark, topic):
    topic.send(tickets_at(5, 6, 7))
    topic.send(CLOSER)
    watched(spark, topic, LOOPS)
    before = rows(streaming.read_early_lane(spark, topic.lanes, LOOPS))
    late.correct_lane(spark, topic.lanes, LOOPS, topic.batch(spark))
    assert rows(streaming.read_early_lane(spark, topic.lanes, LOOPS)) == before

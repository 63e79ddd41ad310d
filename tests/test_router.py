"""One parse for all outputs: equal to the single readers, delivered again, restarted and without its checkpoint."""

import json

import pytest
from helpers import DEFAULTS, logins_at, tickets_at

from accountwatch import CHURN, LOOPS, TICKETS
from accountwatch.operators import detect
from accountwatch.sources import ledger
from accountwatch.sources.events import parse_events, read_event_files, rejected_events
from accountwatch.streaming import router
from accountwatch.streaming.lanes import await_lanes


def rows(df):
    return sorted(tuple(map(str, r)) for r in df.select(*sorted(df.columns)).collect())


class Topic:
    """Messages of one partition with offsets; ``deliver`` hands a range to a router as a micro-batch."""

    def __init__(self, spark, root):
        self.spark, self.root, self.texts = spark, str(root), []

    def send(self, events):
        self.texts += [e if isinstance(e, str) else json.dumps({"event_id": f"e-{len(self.texts) + i:03d}", **DEFAULTS, **e}) for i, e in enumerate(events)]

    def messages(self, begin=0, end=None):
        part = [(t.encode(), "events", 0, begin + i) for i, t in enumerate(self.texts[begin:end])]
        return ledger.positioned(self.spark.createDataFrame(part, "value binary, topic string, partition int, offset long"))

    def start(self, run_id):
        return router.batch_router(self.root, run_id, ledger.store_ranges(self.spark, self.root, run_id))

    def check(self, end=None):
        raw = self.messages(end=end)
        assert rows(router.read_log(self.spark, self.root)) == rows(parse_events(raw))
        assert rows(router.read_rejects(self.spark, self.root)) == rows(rejected_events(raw))
        events = detect.with_event_time(parse_events(raw))
        alerts = {TICKETS: detect.ticket_alerts(events).drop("event_timestamp"), LOOPS: detect.friction_loops(events), CHURN: detect.silent_churners(events)}
        for lane, want in alerts.items():
            assert rows(router.read_alerts(self.spark, self.root, lane)) == rows(want), lane.name
        return {lane.name: want.count() for lane, want in alerts.items()}


@pytest.fixture
def topic(spark, tmp_path):
    topic = Topic(spark, tmp_path)
    topic.send(tickets_at(5, 6, 61) + ["{broken", '{"mrr": "dear", "event_id": "x"}'])
    topic.send(logins_at(10, 11, 12, 13, 14, 15, account_id="Quiet") + tickets_at(7, 62, category=None))
    topic.send(tickets_at(8, 4, 63) + logins_at(3) + tickets_at(20, account_id="Quiet", event_type="feature_access", mrr=25000.0))
    return topic


def test_batches_add_up(spark, topic):
    write = topic.start("run-1")
    for batch, begin in enumerate(range(0, len(topic.texts), 4)):
        write(topic.messages(begin, begin + 4), batch)
    found = topic.check()
    assert found["tickets"] and found["loops"] and not found["churn"], "the feature use takes the churn alerts back"


def test_a_batch_delivered_again_replaces_itself(spark, topic):
    write = topic.start("run-1")
    for batch, begin, end in [(0, 0, 6), (0, 0, 6), (1, 6, 9), (1, 6, 9)]:
        write(topic.messages(begin, end), batch)
    assert topic.check(end=9)["loops"]


def test_a_batch_without_an_entry_does_not_count(spark, topic, tmp_path):
    write = topic.start("run-1")
    write(topic.messages(0, 5), 0)
    write(topic.messages(5, 9), 1)
    entry = tmp_path / "ledger/run_id=run-1/batch_id=1"
    entry.rename(tmp_path / "left-over")
    topic.check(end=5)
    topic.start("run-2")(topic.messages(5, 9), 0)
    topic.check(end=9)


@pytest.mark.parametrize("begin", [0, 3, 5, 6])
def test_a_new_run_reads_nothing_twice(spark, topic, begin):
    """After a lost checkpoint, from the start, within what is stored, and from where the last run stopped."""
    first = topic.start("run-1")
    first(topic.messages(0, 4), 0)
    first(topic.messages(4, 6), 1)
    second = topic.start("run-2")
    second(topic.messages(begin, 8), 0)
    second(topic.messages(8, None), 1)
    topic.check()
    third = topic.start("run-3")
    third(topic.messages(), 0)
    topic.check()


def test_ranges_join_up(spark):
    entries = [("a", 0, 3), ("a", 4, 6), ("a", 1, 2), ("a", 9, 9), ("b", 5, 5), ("a", 6, 6)]
    frame = spark.createDataFrame(entries, "source string, low long, high long")
    assert sorted(map(tuple, ledger.covered(frame).collect())) == [("a", 0, 6), ("a", 9, 9), ("b", 5, 5)]


def test_files_are_read_once(spark, tmp_path):
    """A stream over files, its checkpoint lost between two runs."""
    folder, root = tmp_path / "topic", str(tmp_path / "out")
    folder.mkdir()

    def message(i, e):
        return json.dumps({"event_id": f"e-{i}", **DEFAULTS, **e}) + "\n"

    for run in range(2):
        lines = [message(f"{run}{i}", e) for i, e in enumerate(tickets_at(5, 6, 7))] + ["{broken\n"]
        (folder / f"{run}.txt").write_text("".join(lines))
        raw = read_event_files(spark, str(folder))
        await_lanes({"router": router.start_router(raw, root, f"{root}-checkpoint-{run}", trigger={"availableNow": True})})
    loops = router.read_alerts(spark, root, LOOPS)
    assert {r.incident_count for r in loops.collect()} == {6} and router.read_rejects(spark, root).count() == 2
    assert router.read_log(spark, root).count() == 8


def test_nothing_stored_reads_as_empty(spark, tmp_path):
    for lane in (TICKETS, LOOPS, CHURN):
        assert router.read_alerts(spark, str(tmp_path), lane).count() == 0
    assert router.read_log(spark, str(tmp_path)).count() == 0


def test_late_events_are_added(spark, topic):
    """The later part of the time span comes first."""
    topic.texts = topic.texts[11:] + topic.texts[:11]
    write = topic.start("run-1")
    write(topic.messages(0, 5), 0)
    write(topic.messages(5, None), 1)
    assert topic.check()["loops"]


def test_one_parse_feeds_all_outputs(spark, topic):
    """The batch is parsed in one place and the outputs read that."""
    parsed = router.parsed_once(topic.messages()).persist()
    for name, part in router.outputs(parsed).items():
        plan = part._jdf.queryExecution().executedPlan().toString()
        above = plan.split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in plan and "from_json" not in above, name
    parsed.unpersist()

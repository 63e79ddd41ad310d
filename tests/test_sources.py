import json
import re

import pytest
from helpers import T0, raw, tickets_at
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from accountwatch import CHURN, LOOPS, TICKETS
from accountwatch.operators.detect import ticket_alerts
from accountwatch.schemas import RAW_EVENT, SHORT_EVENT
from accountwatch.session import shared_folder
from accountwatch.sources import events as source
from accountwatch.sources import lanes as store
from accountwatch.sources import tables
from accountwatch.streaming.lanes import current_alerts

GOOD = {"event_id": "e1", "mrr": 1.5, "csat_score": 2, "timestamp": 7, "alert_trigger": "FRICTION_LOOP"}


def messages(spark, *texts):
    return spark.createDataFrame([(t.encode(),) for t in texts], "value binary")


def test_parse(spark):
    parsed = source.parse_events(messages(spark, json.dumps(GOOD), "{bad", "[]", '{"mrr": "dear", "event_id": "e2"}'))
    assert parsed.schema == RAW_EVENT
    good, *bad, partial = parsed.collect()
    assert (good["event_id"], good["mrr"], good["csat_score"], good["timestamp"]) == ("e1", 1.5, 2, 7)
    assert all(v is None for row in bad for v in row)
    assert (partial["event_id"], partial["mrr"]) == ("e2", None)


def test_rejects(spark):
    texts = [json.dumps(GOOD), "{bad", '{"mrr": "dear"}']
    assert [r["message"] for r in source.rejected_events(messages(spark, *texts)).collect()] == texts[1:]


def test_short_schema(spark):
    assert source.parse_events(messages(spark, json.dumps(GOOD)), SHORT_EVENT).columns == SHORT_EVENT.names


class Reader:
    """Stands in for readStream: the broker package is not installed here."""

    def __init__(self):
        self.seen = {}
        self.readStream = self

    def format(self, name):
        self.seen["format"] = name
        return self

    def option(self, key, value):
        self.seen[key] = value
        return self

    def options(self, **more):
        self.seen.update(more)
        return self

    def load(self):
        return self.seen


def test_topic_options():
    plain = source.read_events_stream(Reader(), "host:9092", "events")
    assert plain == {"format": "kafka", "kafka.bootstrap.servers": "host:9092", "subscribe": "events"}
    late = source.read_events_stream(Reader(), "host:9092", "events", "latest", maxOffsetsPerTrigger="10")
    assert late["startingOffsets"] == "latest" and late["maxOffsetsPerTrigger"] == "10"


def test_ticket_library(spark, tmp_path):
    entries = [{"category": "UI Bug", "support_text": "It froze.", "suggested_csat": 1}, {"category": "Search"}]
    path = tmp_path / "library.json"
    path.write_text(json.dumps(entries, indent=2))
    library = tables.read_ticket_library(spark, str(path))
    assert [tuple(r) for r in library.collect()] == [("UI Bug", "It froze.", 1), ("Search", None, None)]


def test_knowledge_base_appends(spark, tmp_path):
    entry = spark.createDataFrame([(1, "c", "text", [0.5])], "sop_id long, category string, content string, embedding array<float>")
    for _ in range(2):
        tables.load_knowledge_base(entry, str(tmp_path / "kb"))
    assert tables.read_knowledge_base(spark, str(tmp_path / "kb")).count() == 2


def test_export(spark, tmp_path):
    rows = spark.createDataFrame([("a", 1.5, 'say "hi",\nnow')], "account_id string, mrr double, ai_draft string")
    tables.export_actioned(rows, str(tmp_path / "report"))
    back = spark.read.option("multiLine", True).option("escape", '"').csv(str(tmp_path / "report"), header=True)
    assert [tuple(r) for r in back.collect()] == [("a", "1.5", 'say "hi",\nnow')]


def lane_rows(spark, n):
    return ticket_alerts(raw(spark, tickets_at(*range(n))))


def test_replayed_batch_changes_nothing(spark, tmp_path):
    write = store.parquet_sink(str(tmp_path), "run-1")(TICKETS)
    write(lane_rows(spark, 3), 0)
    write(lane_rows(spark, 5).filter("event_id > 'e-002'"), 1)
    write(lane_rows(spark, 3), 0)
    got = store.read_lane(spark, str(tmp_path), TICKETS)
    assert got.count() == 5 and "batch_id" not in got.columns


def test_a_new_run_outranks_old_batches(spark, tmp_path):
    rows = lane_rows(spark, 1)
    store.parquet_sink(str(tmp_path), "run-1")(TICKETS)(rows.withColumn("mrr", F.lit(1.0)), 10)
    store.parquet_sink(str(tmp_path), "run-2", files_per_batch=1)(TICKETS)(rows.withColumn("mrr", F.lit(2.0)), 2)
    assert [r["mrr"] for r in store.read_lane(spark, str(tmp_path), TICKETS).collect()] == [2.0]
    assert store.new_run_id() < store.new_run_id()


def test_unwritten_lane(spark, tmp_path):
    assert store.read_lane(spark, str(tmp_path), LOOPS, "account_id string, mrr double").count() == 0
    with pytest.raises(AnalysisException):
        store.read_lane(spark, str(tmp_path), LOOPS)


def test_compaction_by_day(spark, tmp_path):
    write = store.parquet_sink(str(tmp_path), "run-1")(TICKETS)
    write(ticket_alerts(raw(spark, tickets_at(0, 86_400, 86_401))), 0)
    store.compact_lane(spark, str(tmp_path), TICKETS, str(tmp_path / "current"))
    days = spark.read.parquet(str(tmp_path / "current")).groupBy("day").count().orderBy("day").collect()
    assert [r["count"] for r in days] == [1, 2]


def written(spark, root, run, batch, counts):
    """Loop counts of accounts, all of one window, as one batch."""
    rows = [(account, "x", 9.0, n, f"text {n}", start) for account, n, start in counts]
    schema = "account_id string, category string, mrr double, incident_count long, event_summary string, start string"
    rows = spark.createDataFrame(rows, schema).selectExpr("* except (start)", "cast(start as timestamp) as window_start")
    store.parquet_sink(root, run)(LOOPS)(rows, batch)


def counts_in(spark, root, **options):
    rows = store.read_lane(spark, root, LOOPS, **options).collect()
    return sorted((r["account_id"], r["incident_count"]) for r in rows)


def test_folded_batches(spark, tmp_path):
    root, day = str(tmp_path), "2024-01-01"
    written(spark, root, "run-1", 0, [("a", 1, day), ("b", 1, "2024-01-05")])
    store.fold_batches(spark, root, LOOPS)
    assert not (tmp_path / "loops-folds").exists(), "the only batch may still be delivered again"
    written(spark, root, "run-1", 1, [("a", 2, day)])
    written(spark, root, "run-1", 10, [("a", 3, day)])
    store.fold_batches(spark, root, LOOPS)
    assert counts_in(spark, root) == [("a", 3), ("b", 1)]
    written(spark, root, "run-1", 10, [("a", 4, day)])
    assert counts_in(spark, root) == [("a", 4), ("b", 1)], "the newest batch, delivered again, counts"
    written(spark, root, "run-2", 0, [("b", 7, "2024-01-05"), ("c", None, None)])
    store.fold_batches(spark, root, LOOPS)
    store.fold_batches(spark, root, LOOPS)
    assert counts_in(spark, root) == [("a", 4), ("b", 7), ("c", None)]
    assert counts_in(spark, root, since="2024-01-02") == [("b", 7)]
    assert store.read_lane(spark, root, LOOPS).columns == ["account_id", "category", "mrr", "incident_count", "event_summary", "window_start"]


def test_folds_of_two_runs_at_a_time(spark, tmp_path):
    """An older run that goes on writing after a newer one has started is read and folded too."""
    root, day = str(tmp_path), "2024-01-01"
    for batch in range(2):
        written(spark, root, "run-1", batch, [(f"old{batch}", 1, day)])
        written(spark, root, "run-2", batch, [(f"new{batch}", 1, day)])
    store.fold_batches(spark, root, LOOPS)
    written(spark, root, "run-1", 1, [("again", 1, day)])
    written(spark, root, "run-1", 2, [("late", 1, day)])
    want = [("again", 1), ("late", 1), ("new0", 1), ("new1", 1), ("old0", 1)]
    assert counts_in(spark, root) == want, "each run's newest batch may be delivered again, and others follow"
    written(spark, root, "run-1", 3, [("later", 1, day)])
    store.fold_batches(spark, root, LOOPS)
    written(spark, root, "run-0", 0, [("backfill", 1, day)])
    assert counts_in(spark, root) == sorted([*want, ("later", 1), ("backfill", 1)])


def test_a_fold_rewrites_one_day_and_a_read_lists_no_folded_folder(spark, tmp_path):
    root = str(tmp_path)
    for batch in range(4):
        written(spark, root, "run-1", batch, [("a", batch, f"2024-01-0{1 + batch}"), (f"b{batch}", 1, "2024-01-09")])
    store.fold_batches(spark, root, LOOPS)
    (first,) = (tmp_path / "loops-bases").iterdir()
    assert sorted(p.name for p in first.glob("day=*")) == ["day=2024-01-01", "day=2024-01-02", "day=2024-01-03", "day=2024-01-09"]
    written(spark, root, "run-1", 4, [("c", 1, "2024-01-05")])
    store.fold_batches(spark, root, LOOPS)
    (second,) = set((tmp_path / "loops-bases").iterdir()) - {first}
    assert sorted(p.name for p in second.glob("day=*")) == ["day=2024-01-04", "day=2024-01-09"], "the days of batch 3"
    want = [("a", 0), ("a", 1), ("a", 2), ("a", 3), *[(f"b{i}", 1) for i in range(4)], ("c", 1)]
    assert counts_in(spark, root) == want
    # Whoever looks into a folded batch, or a day that a later fold has written, fails on these.
    for folder in [*(tmp_path / f"loops/run_id=run-1/batch_id={i}" for i in range(4)), first / "day=2024-01-09"]:
        for file in folder.glob("*.parquet"):
            file.write_bytes(b"not parquet")
    assert counts_in(spark, root) == want
    read = store.read_lane(spark, root, LOOPS, since="2024-01-04").inputFiles()
    assert {re.search(r"(?:day|batch_id)=([^/]+)", f)[1] for f in read} == {"2024-01-04", "2024-01-09", "4"}
    store.fold_batches(spark, root, LOOPS)
    assert counts_in(spark, root) == want, "nothing new to fold"


def test_a_row_that_moves_to_another_day(spark, tmp_path):
    """An alert delivered again with another time counts once, by its last delivery."""
    write = store.parquet_sink(str(tmp_path), "run-1")(TICKETS)
    for batch, second in enumerate((0, 86_400, 86_401)):
        write(ticket_alerts(raw(spark, tickets_at(second))), batch)
    store.fold_batches(spark, str(tmp_path), TICKETS)
    write(ticket_alerts(raw(spark, tickets_at(172_800))), 3)
    store.fold_batches(spark, str(tmp_path), TICKETS)
    rows = store.read_lane(spark, str(tmp_path), TICKETS).collect()
    assert [r.timestamp for r in rows] == [T0 + 172_800]


class Frame:
    """Records a JDBC write; no database is started for a test."""

    def __init__(self):
        self.columns, self.calls = [], []
        self.write = self

    def withColumn(self, name, _):
        self.columns.append(name)
        return self

    def jdbc(self, **call):
        self.calls.append(call)


def test_jdbc_appends_tagged_batches(spark):
    frame = Frame()
    store.jdbc_sink("jdbc:x", {"user": "u"}, "run-1")(TICKETS)(frame, 4)
    assert frame.columns == ["run_id", "batch_id"]
    assert frame.calls == [dict(url="jdbc:x", table="high_priority_alerts", mode="append", properties={"user": "u"})]
    plain = Frame()
    store.jdbc_sink("jdbc:x", {}, tables={"loops": "mine"})(LOOPS)(plain, 4)
    assert plain.columns == [] and plain.calls[0]["table"] == "mine"


def test_untagged_rows_keep_the_highest_count(spark):
    rows = [("a", "c", 1.0, n, 0) for n in (3, 5, 4)]
    stored = spark.createDataFrame(rows, "account_id string, category string, mrr double, incident_count long, window_start int")
    assert [r["incident_count"] for r in store.newest_rows(stored, LOOPS).collect()] == [5]


def test_untagged_churn_rows_keep_the_latest_feature_use(spark):
    rows = [("a", 1.0, 5, n, 0) for n in (0, 1, 0)]
    stored = spark.createDataFrame(rows, "account_id string, mrr double, login_count long, feature_count long, window_start int")
    assert [r["feature_count"] for r in store.newest_rows(stored, CHURN).collect()] == [1]
    assert current_alerts(store.newest_rows(stored, CHURN), CHURN).count() == 0


def test_alerts_without_an_id_are_kept(spark):
    rows = [(None, "a", 1, "r", 0), (None, "b", 1, "r", 0), (None, "a", 1, "r", 1), ("e", "a", 1, "r", 0), ("e", "a", 1, "r", 1)]
    stored = spark.createDataFrame(rows, "event_id string, account_id string, timestamp long, run_id string, batch_id long")
    got = sorted((r["event_id"] or "", r["account_id"]) for r in store.newest_rows(stored, TICKETS).collect())
    assert got == [("", "a"), ("", "b"), ("e", "a")]


def test_console(spark, capsys):
    store.console_sink(5)(TICKETS)(lane_rows(spark, 1), 3)
    assert "tickets, batch 3" in capsys.readouterr().out
    store.console_sink(5)(TICKETS)(spark.range(7), 4)
    assert "2 more rows not shown" in capsys.readouterr().out


def session(settings):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: settings.get(key, default))

    return Session


def test_shared_folder_follows_the_session(spark):
    named = session({"spark.checkpoint.dir": "hdfs://shared/work/", "spark.master": "yarn"})
    first, second = shared_folder(named, "x"), shared_folder(named, "x")
    assert first.startswith("hdfs://shared/work/accountwatch/x-") and first != second
    assert shared_folder(spark, "x").startswith("/")


def test_a_cluster_must_name_its_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(session({"spark.master": "yarn"}), "x")

from datetime import datetime

from accountwatch import CHURN, LOOPS, TICKETS
from accountwatch.operators import keep, state

T = [datetime(2024, 1, 1, 0, m) for m in range(10)]
TICKET = (
    "event_id string, account_id string, category string, mrr double, timestamp long, ai_draft string, is_approved boolean"
)
LOOP = "account_id string, category string, mrr double, incident_count long, window_start timestamp, ai_draft string, is_approved boolean"
CHURN_ROW = "account_id string, mrr double, login_count long, window_start timestamp, ai_draft string, is_approved boolean"


def ids(df, column="event_id"):
    return sorted(r[column] for r in df.select(column).collect())


def drafted(spark):
    rows = [
        (f"{draft!r}-{approved}", f"a{i}", "c", 1.0, i, draft, approved)
        for i, (draft, approved) in enumerate((d, a) for d in (None, "", "text") for a in (True, False))
    ]
    return spark.createDataFrame(rows, TICKET)


def test_the_four_readings_of_has_a_draft(spark):
    rows = drafted(spark)
    assert ids(keep.needs_draft(rows, TICKETS)) == ["''-False", "None-False"]
    assert ids(keep.needs_draft(rows, LOOPS)) == ["''-False", "''-True", "None-False", "None-True"]
    assert ids(keep.ready_for_review(rows)) == ["'text'-False"]
    assert ids(keep.ready_for_review(rows, allow_empty=True)) == ["''-False", "'text'-False"]
    assert ids(keep.pending(rows)) == ["''-False", "'text'-False", "None-False"]


def test_latest_ticket_prefers_any_draft_then_time(spark):
    rows = [
        ("e1", "a", "c", 1.0, 9, None, False),
        ("e2", "a", "c", 1.0, 5, "", False),
        ("e3", "a", "c", 1.0, 4, "text", False),
        ("e4", "a", None, 1.0, None, None, False),
        ("e5", "a", None, 1.0, 1, None, False),
        ("e6", None, "c", 1.0, 1, None, False),
        ("e7", None, "c", 1.0, 2, None, False),
    ]
    assert ids(keep.latest(spark.createDataFrame(rows, TICKET), TICKETS)) == ["e2", "e5", "e7"]


def test_ticket_queue_takes_the_oldest_and_nulls_last(spark):
    rows = [
        ("e1", "b", "c", 1.0, None, None, False),
        ("e2", "b", "d", 1.0, 7, "", False),
        ("e3", "b", "d", 1.0, 1, "text", False),
        ("e4", "a", "c", 1.0, 3, None, False),
        ("e5", "a", "c", 1.0, 3, None, False),
        ("e6", "c", "c", 1.0, 3, None, True),
    ]
    tickets = spark.createDataFrame(rows, TICKET)
    assert ids(keep.draft_queue(tickets, TICKETS)) == ["e2", "e4"]
    assert ids(keep.draft_queue(tickets, TICKETS, limit=1)) == ["e4"]


def test_loops_queue_oldest_show_newest(spark):
    rows = [
        ("a", "c", 1.0, 3, T[0], None, False),
        ("a", "c", 1.0, 4, T[0], None, False),
        ("a", "c", 1.0, 5, T[1], None, False),
        ("a", "d", 1.0, 6, T[1], "text", False),
    ]
    loops = spark.createDataFrame(rows, LOOP)
    assert ids(keep.draft_queue(loops, LOOPS), "incident_count") == [4]
    assert ids(keep.latest(loops, LOOPS), "incident_count") == [5, 6]


def test_churn_keeps_one_per_account(spark):
    rows = [("a", 1.0, 5, T[0], None, False), ("a", 2.0, 7, T[1], None, False), ("a", 1.0, 6, T[1], None, False)]
    churn = spark.createDataFrame(rows, CHURN_ROW)
    assert ids(keep.latest(churn, CHURN), "login_count") == [7]
    assert ids(keep.draft_queue(churn, CHURN), "login_count") == [5]


def test_keep_first_ranks(spark):
    rows = spark.createDataFrame([("a", i) for i in range(5)], "k string, v int")
    best = keep.keep_first(rows, ["k"], [rows.v.desc()], 2, rank="place")
    assert sorted(map(tuple, best.collect())) == [("a", 3, 2), ("a", 4, 1)]


def test_a_draft_reaches_every_row_of_its_window(spark):
    rows = spark.createDataFrame([("a", "c", m, 3, T[0], None, False) for m in (1.0, 2.0)], LOOP)
    drafts = spark.createDataFrame(
        [("a", "c", T[0], "old", T[1]), ("a", "c", T[0], "new", T[2]), ("a", "c", T[0], "", T[3]), ("a", None, T[0], "x", T[1])],
        "account_id string, category string, window_start timestamp, draft string, drafted_at timestamp",
    )
    got = state.apply_drafts(rows, drafts, LOOPS)
    assert [(r["ai_draft"], r["drafted_at"]) for r in got.collect()] == [("new", T[2])] * 2


def test_tickets_store_an_empty_draft(spark):
    rows = spark.createDataFrame([("e1", "a", "c", 1.0, 1, "text", False)], TICKET)
    drafts = spark.createDataFrame([("e1", "", T[1])], "event_id string, draft string, drafted_at timestamp")
    assert state.apply_drafts(rows, drafts, TICKETS).first()["ai_draft"] == ""


def test_state_defaults_and_approval(spark):
    rows = spark.createDataFrame([(f"e{i}", "a") for i in range(4)], "event_id string, account_id string")
    drafts = spark.createDataFrame(
        [("e1", "d1", T[1]), ("e2", "d2", T[1])], "event_id string, draft string, drafted_at timestamp"
    )
    approvals = spark.createDataFrame(
        [("e2", "edited", T[2]), ("e2", "first edit", T[1]), ("e3", None, T[2])],
        "event_id string, final_draft string, approved_at timestamp",
    )
    got = state.lane_state(rows, drafts, approvals, TICKETS).orderBy("event_id")
    assert [(r["ai_draft"], r["is_approved"]) for r in got.collect()] == [
        (None, False), ("d1", False), ("edited", True), (None, True),
    ]


def test_the_last_change_wins(spark):
    rows = spark.createDataFrame([("a", "c", 1.0, 3, T[0], None, False), ("b", "c", 1.0, 3, T[0], None, False)], LOOP)
    key = "account_id string, category string, window_start timestamp"
    drafts = spark.createDataFrame([("a", "c", T[0], "draft", T[3]), ("b", "c", T[0], "draft", T[1])], f"{key}, draft string, drafted_at timestamp")
    edits = spark.createDataFrame([("a", "c", T[0], "", T[2]), ("b", "c", T[0], "edit", T[2])], f"{key}, final_draft string, approved_at timestamp")
    got = state.lane_state(rows, drafts, edits, LOOPS).orderBy("account_id")
    assert [(r["ai_draft"], r["drafted_at"], r["is_approved"]) for r in got.collect()] == [("draft", T[3], True), ("edit", T[1], True)]
    assert ids(keep.needs_draft(got, LOOPS), "account_id") == []


def test_status_words(spark):
    rows = spark.createDataFrame([(True,), (False,), (None,)], "is_approved boolean")
    assert [r[0] for r in rows.select(state.alert_status()).collect()] == ["Actioned", "At Risk", None]


def test_older_shape(spark):
    alerts = spark.createDataFrame(
        [("e1", "a", 1.0, "completed", "d"), ("e2", "a", 2.0, "pending", None)],
        "event_id string, account_id string, mrr double, status string, recovery_draft string",
    )
    approvals = spark.createDataFrame([("e1", "edited", T[1])], "event_id string, final_draft string, approved_at timestamp")
    assert [tuple(r) for r in state.drafted_rows(alerts).collect()] == [("a", 1.0, "d")]
    sent = {r["event_id"]: (r["status"], r["recovery_draft"]) for r in state.mark_sent(alerts, approvals).collect()}
    assert sent == {"e1": ("sent", "edited"), "e2": ("pending", None)}
